"""Fleet analytics: status counts, shares, regional breakdowns, rankings.

All take rows with `region` and `update_status`. With `weight`, a row stands
for that many devices, so rows counted earlier (see `plans.views`) can be fed
in. Each report is one aggregation over the fleet; windows and sorts run on
the few aggregated rows only.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwright.functions.columns import percent_of, ratio_percent
from fleetwright.schemas import PARTIAL, RECOVERED, STATUSES, SUCCESS


def _devices(weight: str | None, only: Column | None = None) -> Column:
    """Number of devices in a group, or of those for which `only` is true."""
    if weight is None:
        return F.count("*") if only is None else F.count_if(only)
    counted = F.col(weight) if only is None else F.when(only, F.col(weight))
    return F.coalesce(F.sum(counted), F.lit(0).cast("bigint"))


def _is(status: str) -> Column:
    return F.col("update_status") == status


def status_counts(fleet: DataFrame, weight: str | None = None) -> DataFrame:
    """(update_status, count)."""
    return fleet.groupBy("update_status").agg(_devices(weight).alias("count"))


def status_distribution(fleet: DataFrame, weight: str | None = None) -> DataFrame:
    """`status_counts`, largest first: the rows of the status bar chart."""
    return status_counts(fleet, weight).orderBy(F.desc("count"), "update_status")


def status_summary(fleet: DataFrame, weight: str | None = None) -> DataFrame:
    """(update_status, device_count, percentage of the fleet), largest first."""
    counts = fleet.groupBy("update_status").agg(_devices(weight).alias("device_count"))
    total = F.sum("device_count").over(Window.partitionBy())
    return (
        counts.withColumn("percentage", percent_of(F.col("device_count"), total))
        .orderBy(F.desc("device_count"), "update_status")
    )


def region_status_counts(fleet: DataFrame, weight: str | None = None) -> DataFrame:
    """(region, update_status, device_count)."""
    return fleet.groupBy("region", "update_status").agg(_devices(weight).alias("device_count"))


def regional_status_pct(fleet: DataFrame, weight: str | None = None) -> DataFrame:
    """(region, update_status, percentage of the region)."""
    total = F.sum("device_count").over(Window.partitionBy("region"))
    counts = region_status_counts(fleet, weight).withColumn("total", total)
    return counts.select(
        "region", "update_status", percent_of(F.col("device_count"), F.col("total")).alias("percentage"))


def regional_status_matrix(
    fleet: DataFrame, statuses: list[str] = STATUSES, weight: str | None = None,
) -> DataFrame:
    """One row per region, one percentage column per status, NULL where none.

    The statuses are stated, so the schema is stable and no job has to look
    them up; the total counts every status, listed or not.
    """
    cells = [F.nullif(_devices(weight, _is(s)), F.lit(0)).alias(s) for s in statuses]
    tallies = fleet.groupBy("region").agg(_devices(weight).alias("_total"), *cells)
    return tallies.select("region", *[percent_of(F.col(s), F.col("_total")).alias(s) for s in statuses])


def regional_breakdown(fleet: DataFrame, weight: str | None = None) -> DataFrame:
    """Per region: all devices and those partial, recovered, successful; largest first."""
    return (
        fleet.groupBy("region").agg(
            _devices(weight).alias("total_devices"),
            _devices(weight, _is(PARTIAL)).alias("partial_count"),
            _devices(weight, _is(RECOVERED)).alias("recovered_count"),
            _devices(weight, _is(SUCCESS)).alias("success_count"),
        )
        .orderBy(F.desc("total_devices"), "region")
    )


def regional_failure_rate(fleet: DataFrame, weight: str | None = None) -> DataFrame:
    """Per region: devices, failed devices, failure percentage; worst first."""
    return (
        fleet.groupBy("region").agg(
            _devices(weight).alias("total_devices"),
            _devices(weight, _is(PARTIAL)).alias("failed_count"),
        )
        .withColumn("failure_rate_percentage", percent_of(F.col("failed_count"), F.col("total_devices")))
        .orderBy(F.desc("failure_rate_percentage"), "region")
    )


def failure_rank(fleet: DataFrame, status: str = PARTIAL, weight: str | None = None) -> DataFrame:
    """Regions with devices in `status`, their share there, and their rank by count.

    The share is of all devices of the region, so the total is taken before
    other statuses are dropped. Ties share a rank and leave a gap.
    """
    tallies = fleet.groupBy("region").agg(
        _devices(weight).alias("_total"), _devices(weight, _is(status)).alias("device_count"))
    by_count = Window.partitionBy("update_status").orderBy(F.desc("device_count"))
    return (
        tallies.filter(F.col("device_count") > 0)
        .withColumn("update_status", F.lit(status))
        .select(
            "region", "update_status", "device_count",
            ratio_percent(F.col("device_count"), F.col("_total")).alias("failure_rate_percentage"),
            F.rank().over(by_count).cast("bigint").alias("failure_rank"),
        )
    )


def updated_counts(counts: DataFrame, log: DataFrame) -> DataFrame:
    """(region, update_status, device_count) after a merge: `region_status_counts` from before it and its
    log (region, before, update_status), without the fleet.

    Every changed device leaves one group and enters another.
    """
    one = F.lit(1).cast("bigint")
    moved = log.select("region", F.explode(F.array(
        F.struct(F.col("before").alias("update_status"), (-one).alias("device_count")),
        F.struct(F.col("update_status").alias("update_status"), one.alias("device_count")))).alias("_m")).select("region", "_m.*")
    return (
        counts.select("region", "update_status", "device_count").union(moved).groupBy("region", "update_status")
        .agg(F.sum("device_count").alias("device_count")).filter(F.col("device_count") != 0)
    )
