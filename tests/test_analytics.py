import pytest
from pyspark.sql import functions as F

from fleetwright.operators import analytics
from fleetwright.schemas import FLEET


def fleet_of(spark, groups):
    rows, n = [], 0
    for region, status, count in groups:
        for _ in range(count):
            rows.append((f"DEV-{n:08x}", region, 12.5, 50, status))
            n += 1
    return spark.createDataFrame(rows, FLEET)


@pytest.fixture(scope="module")
def fleet(spark):
    """Region A: Partial 2, Success 2; B: Partial 2, Success 1; C: Success 1."""
    return fleet_of(spark, [
        ("A", "Partial", 2), ("A", "Success", 2), ("B", "Partial", 2), ("B", "Success", 1), ("C", "Success", 1)])


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_failure_rank_shares_of_the_region_and_ties(fleet):
    assert sorted(rows(analytics.failure_rank(fleet))) == [
        ("A", "Partial", 2, 50.0, 1), ("B", "Partial", 2, 66.67, 1)]


def test_rank_leaves_a_gap_after_ties(spark):
    fleet = fleet_of(spark, [("A", "Partial", 3), ("B", "Partial", 3), ("C", "Partial", 1)])
    ranks = {r["region"]: r["failure_rank"] for r in analytics.failure_rank(fleet).collect()}
    assert ranks == {"A": 1, "B": 1, "C": 3}


def test_failure_rate_keeps_regions_without_failures(fleet):
    assert rows(analytics.regional_failure_rate(fleet)) == [
        ("B", 3, 2, 66.67), ("A", 4, 2, 50.0), ("C", 1, 0, 0.0)]


def test_breakdown_is_ordered_by_size(fleet):
    assert rows(analytics.regional_breakdown(fleet)) == [
        ("A", 4, 2, 0, 2), ("B", 3, 2, 0, 1), ("C", 1, 0, 0, 1)]


def test_status_reports(fleet):
    assert sorted(rows(analytics.status_counts(fleet))) == [("Partial", 4), ("Success", 4)]
    assert rows(analytics.status_distribution(fleet)) == [("Partial", 4), ("Success", 4)]
    assert rows(analytics.status_summary(fleet)) == [("Partial", 4, 50.0), ("Success", 4, 50.0)]


def test_matrix_has_fixed_columns_and_missing_cells(fleet):
    matrix = analytics.regional_status_matrix(fleet)
    assert matrix.columns == ["region", "Partial", "Recovered", "SECURITY_HOLD", "Success"]
    assert sorted(rows(matrix)) == [
        ("A", 50.0, None, None, 50.0), ("B", 66.67, None, None, 33.33), ("C", None, None, None, 100.0)]


def test_null_status_is_a_group_and_counts_in_the_total(spark):
    fleet = fleet_of(spark, [("A", None, 1), ("A", "Partial", 1), ("A", "Success", 2)])
    assert (None, 1) in rows(analytics.status_counts(fleet))
    assert rows(analytics.regional_status_matrix(fleet)) == [("A", 25.0, None, None, 50.0)]
    assert rows(analytics.regional_breakdown(fleet)) == [("A", 4, 1, 0, 2)]


def test_empty_fleet(spark):
    fleet = spark.createDataFrame([], FLEET)
    for report in (analytics.failure_rank, analytics.status_summary, analytics.regional_status_matrix):
        assert rows(report(fleet)) == []


REPORTS = [
    analytics.status_counts, analytics.status_distribution, analytics.status_summary,
    analytics.region_status_counts, analytics.regional_status_pct, analytics.regional_status_matrix,
    analytics.regional_breakdown, analytics.regional_failure_rate, analytics.failure_rank,
]


@pytest.mark.parametrize("report", REPORTS, ids=lambda r: r.__name__)
def test_weighted_rows_give_the_same_report(fleet, report):
    counted = fleet.groupBy("region", "update_status").agg(F.count("*").alias("devices"))
    plain, weighted = report(fleet), report(counted, weight="devices")
    assert plain.dtypes == weighted.dtypes
    assert sorted(map(str, rows(plain))) == sorted(map(str, rows(weighted)))


def test_percentages_add_up(spark, testdata):
    from fleetwright.plans import views
    shares = analytics.regional_status_pct(views.fleet(spark, str(testdata / "sf0.001")))
    for region in shares.groupBy("region").agg(F.sum("percentage").alias("p"), F.count("*").alias("n")).collect():
        assert abs(region["p"] - 100) <= 0.02 * region["n"]


def test_sql_over_a_registered_fleet(spark, fleet):
    """CTEs, ordinals, and windows over aggregates run as an SQL user writes them."""
    fleet.createOrReplaceTempView("fleet_rows")
    largest = spark.sql("""
        WITH by_region AS (SELECT region, count(*) AS devices FROM fleet_rows GROUP BY 1)
        SELECT region, devices - lag(devices) OVER (ORDER BY devices, region) AS ahead_of_next
        FROM by_region ORDER BY 2 DESC NULLS LAST, 1""")
    assert rows(largest) == [("B", 2), ("A", 1), ("C", None)]
    running = spark.sql("""
        SELECT update_status, max(battery_voltage) AS highest, sum(max(signal_strength)) OVER (ORDER BY update_status) AS upto
        FROM fleet_rows GROUP BY 1 ORDER BY 1""")
    assert rows(running) == [("Partial", 12.5, 50), ("Success", 12.5, 100)]
