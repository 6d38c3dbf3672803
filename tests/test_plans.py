"""Properties of the plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from fleetwright.operators import analytics, firmware, state, updates
from fleetwright.plans import views
from fleetwright.plans.catalog import QUERIES
from fleetwright.plans.oracle import ORACLE as SQL
from tests.oracle import assert_same, connect
from tests.plan import plan_of, run_plan
from tests.test_firmware import huge_image

# Verifying signatures is the only Python in a plan; signing, and verifying for
# verdicts, run before and are checkpointed.
WITH_PYTHON = {"signature_audit"}
# Built on a written result, so the plan read back is a bare scan.
WRITTEN = {"recovery_actions_csv", "chunk_stream_verify", "image_stream_verdict", "fleet_replaced", "security_events_stored", "fleet_merged",
           "load_resumed", "quarantine_lines"}


@pytest.fixture(scope="module")
def folder(testdata):
    return str(testdata / "sf0.001")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITTEN))
def test_no_cross_join_and_python_only_for_signatures(spark, folder, settings, name):
    with settings(spark__sql__autoBroadcastJoinThreshold=-1):
        plan = plan_of(QUERIES[name](spark, folder))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    python = re.search(r"Python|Pandas", plan) is not None
    assert python == (name in WITH_PYTHON)


@pytest.mark.parametrize("name", sorted(
    set(QUERIES) - {"batch_ledger", "batch_assignment", "load_resumed", "chunk_renumber", "firmware_verdict_landed"}))
def test_only_size_checked_broadcasts(spark, folder, settings, name):
    """With automatic broadcasts off nothing is broadcast; those left out
    broadcast one row per partition, see `with_row_index`."""
    with settings(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1):
        assert "BroadcastExchange" not in run_plan(QUERIES[name](spark, folder))


@pytest.mark.parametrize("name", [
    "failure_rank", "region_status_counts", "regional_status_matrix", "regional_breakdown",
    "fleet_projection", "status_update_by_key", "firmware_verdict", "firmware_errors", "update_errors",
    "security_events", "fleet_after_update"])
def test_same_result_without_broadcasts(spark, testdata, settings, name):
    con = connect(testdata / "sf0.001")
    with settings(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1):
        assert assert_same(QUERIES[name](spark, str(testdata / "sf0.001")), con, SQL[name]) > 0


def test_scans_read_only_needed_columns(spark, folder):
    def columns(name):
        return re.findall(r"ReadSchema: struct<([^>]*)>", QUERIES[name](spark, folder)
                          ._jdf.queryExecution().toString())
    assert columns("status_counts") == ["o_orderstatus:string"]
    assert "o_custkey:bigint,o_orderstatus:string" in columns("failure_rank")
    assert columns("recovery_shard_report") == ["o_orderkey:bigint,o_orderstatus:string"]


def test_filter_on_status_reaches_the_scan(spark, folder, tmp_path):
    path = str(tmp_path / "ota_logs")
    views.fleet(spark, folder).write.parquet(path)
    plan = plan_of(state.recovery_shard_report(spark.read.parquet(path), 4))
    assert "EqualTo(update_status,Partial)" in plan
    assert "ReadSchema: struct<device_id:string,update_status:string>" in plan


def test_counting_shuffles_aggregates_only(spark, folder, settings):
    """Orders are counted before their first shuffle, whether or not the lookup is broadcast."""
    for limit in (-1, 10 << 20):
        with settings(spark__sql__autoBroadcastJoinThreshold=limit):
            plan = plan_of(analytics.region_status_counts(views.regional_status(spark, folder), weight="devices"))
        lines = [line for line in plan.splitlines() if "o_custkey" in line or "partial_count" in line or "Exchange" in line]
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "o_custkey" in line)
        assert "partial_count" in "".join(lines[:scan]).rsplit("Exchange", 1)[1]


def shuffles_of(plan, column):
    return len(re.findall(rf"Exchange \w*partitioning\([^\n]*{column}", plan))


def test_orders_are_shuffled_once_for_their_region(spark, folder, settings):
    """The lookups meet first, so the fleet is dealt by customer and by nothing else."""
    with settings(spark__sql__autoBroadcastJoinThreshold=-1):
        plan = plan_of(views.fleet(spark, folder))
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "o_custkey" in join and shuffles_of(plan, "o_custkey") == 2


def test_samples_draw_keys_without_the_lookups(spark, folder):
    few = state.sample_candidates(views.devices(spark, folder), 50, 7, "device_id", 1_500)
    plan = plan_of(few)
    assert "c_custkey" not in plan and "o_orderkey" in plan and "Exchange" not in plan


def test_a_page_sorts_only_the_ranges_it_lies_in(spark, settings):
    ids = spark.range(40_000).select(
        F.format_string("DEV-%08x", "id").alias("device_id"), F.lit("Partial").alias("update_status"))
    with settings(spark__sql__adaptive__coalescePartitions__enabled=False):
        page = state.recovery_page(ids, 100, 20_000)
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert [r[0] for r in page.collect()] == [f"DEV-{i:08x}" for i in range(20_000, 20_100)]
    wanted = re.search(r"SPARK_PARTITION_ID\(\) (=|IN) ([^\n]*)", plan)
    assert wanted and len(re.findall(r"\d+", wanted[2])) <= 2


def test_latest_status_combines_without_a_sort(spark, folder):
    plan = plan_of(QUERIES["status_update_by_key"](spark, folder))
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "partial_max_by" in plan and "HashAggregate" in plan


SKEW = dict(
    spark__sql__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
    spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
    spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    spark__sql__adaptive__coalescePartitions__enabled=False,
    spark__sql__shuffle__partitions=16,
)


def skewed_folder(spark, path):
    """300,000 orders, a third of them by one customer."""
    n = 300_000
    orders = spark.range(0, n, 1, 8).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).cast("bigint").alias("o_custkey"),
        F.element_at(F.array(F.lit("P"), F.lit("F")), (F.col("id") % 2 + 1).cast("int")).alias("o_orderstatus"))
    customer = spark.range(20_000).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).alias("c_nationkey"))
    nation = spark.range(25).select(F.col("id").alias("n_nationkey"), (F.col("id") % 5).alias("n_regionkey"))
    region = spark.range(5).select(F.col("id").alias("r_regionkey"), F.format_string("R%d", "id").alias("r_name"))
    for name, df in [("orders", orders), ("customer", customer), ("nation", nation), ("region", region)]:
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_hot_customer_is_split(spark, tmp_path, settings):
    folder = skewed_folder(spark, tmp_path)
    with settings(**SKEW):
        fleet = views.fleet(spark, folder)
        plan = run_plan(fleet)
        assert re.search(r"SortMergeJoin\(skew=true\) \[o_custkey#", plan)
        skewed = sorted(map(tuple, analytics.region_status_counts(fleet).collect()))
        counted = analytics.region_status_counts(views.regional_status(spark, folder), weight="devices")
        assert sorted(map(tuple, counted.collect())) == skewed


def test_hot_image_is_split_on_the_device_side(spark, settings):
    targets = spark.range(0, 300_000, 1, 8).select(
        F.format_string("DEV-%08x", "id").alias("device_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).cast("bigint").alias("firmware_id"))
    verdicts = spark.range(20_000).select(
        F.col("id").alias("firmware_id"), F.lit("v").alias("firmware_version"), F.lit("OK").alias("verdict"),
        F.lit(0).cast("bigint").alias("error_count"))
    with settings(**SKEW):
        outcomes = updates.update_outcomes(targets, verdicts)
        assert outcomes.collect()[0]["status"] == "installed"
        assert re.search(r"SortMergeJoin\(skew=true\) \[firmware_id#", plan_of(outcomes))


def test_errors_are_limited_before_they_meet(spark, settings):
    with settings(spark__sql__autoBroadcastJoinThreshold=-1):
        plan = plan_of(firmware.first_errors(firmware.firmware_errors(*huge_image(spark, 100), first=3)))
    assert re.search(r"row_number\(\), 3, Final.*Exchange.*row_number\(\), 3, Partial", plan, re.S)


@pytest.mark.parametrize("name", [
    "firmware_verdict", "verdict_counts", "firmware_errors", "chunk_errors", "event_details", "chunk_hash_check", "update_errors"])
def test_manifests_and_deliveries_are_read_once(spark, folder, settings, name):
    """And what is judged is combined by hash: no sort before or behind the shuffle of chunks."""
    with settings(spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__adaptive__autoBroadcastJoinThreshold=-1):
        plan = run_plan(QUERIES[name](spark, folder))
    assert len(re.findall(r"FileScan parquet [^\n]*documents", plan)) <= 2
    assert "Generate explode(sequence" not in plan and "SortAggregate" not in plan


def test_manifests_that_came_as_documents_are_made_once(spark, folder):
    """The images are read for their chunks only: manifests are read as they were found, with their text."""
    plan = run_plan(QUERIES["firmware_verdict_documents"](spark, folder))
    assert len(re.findall(r"FileScan parquet [^\n]*documents\.parquet", plan)) == 1
    assert len(re.findall(r"FileScan parquet [^\n]*/found-", plan)) == 1 and "parse_json" not in plan


def test_errors_of_a_hot_image_are_split(spark, settings):
    """200,000 bad chunks of one image find its verdict by an adaptive skew join."""
    records, received = huge_image(spark, 200_000)
    verdicts = spark.createDataFrame(
        [(n, "CHUNK_ERROR" if n == 1000 else "OK", 0, 0, 0, None, None, None) for n in [*range(100), 1000]],
        "firmware_id long, verdict string, total_chunks int, delivered long, without_hash long, structure_error string, "
        "bad_key string, found_keys array<bigint>").repartition(8)
    with settings(**SKEW):
        errors = firmware.chunk_errors(records, received, verdicts)
        plan = run_plan(errors)
    assert re.search(r"SortMergeJoin\(skew=true\) \[firmware_id#", plan)
    assert errors.count() == 200_000


def test_no_manifest_is_shuffled_for_its_signature(spark, folder, settings):
    with settings(spark__sql__autoBroadcastJoinThreshold=-1):
        text = QUERIES["firmware_verdict_signed"](spark, folder)._jdf.queryExecution().executedPlan().treeString()
    dealt = [line for line in text.splitlines() if "Exchange" in line]
    assert dealt and not any("chunks" in line for line in dealt)


def test_payload_does_not_leave_its_task(spark, folder, settings):
    with settings(spark__sql__autoBroadcastJoinThreshold=-1):
        text = QUERIES["firmware_verdict"](spark, folder)._jdf.queryExecution().executedPlan().treeString()
    for line in text.splitlines():
        assert not ("Exchange" in line and "payload" in line)


def test_reports_of_a_hot_device_combine_before_the_shuffle(spark, settings):
    """A third of 200,000 reports come from one device."""
    feed = spark.range(0, 200_000, 1, 8).select(
        F.format_string("DEV-%08x", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("device_id"),
        F.when(F.col("id") % 2 == 0, "Partial").otherwise("Success").alias("status"), F.col("id").alias("at"))
    latest = state.last_status(feed, "at")
    plan = plan_of(latest)
    assert re.search(r"functions=\[max_by.*Exchange hashpartitioning\(device_id.*partial_max_by", plan, re.S)
    found = {r[0]: r[1] for r in latest.filter("device_id = 'DEV-00000007'").collect()}
    assert found == {"DEV-00000007": "Partial"}
    assert latest.count() == feed.select("device_id").distinct().count()
