import pytest
from pyspark.sql import functions as F

from fleetwright.operators import quality, state
from fleetwright.plans import views
from fleetwright.schemas import RAW_FLEET, RECOVERY_ACTIONS
from fleetwright.sources import sinks, tables


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([
        ("clean", "A", "12.5", 50, "Success"),
        ("null", "A", None, 50, "Partial"),
        ("text", "A", "UNKNOWN", 50, "Success"),
        ("signal", "A", "12.5", -999, "Success"),
        ("two", "A", None, -999, "Success"),
    ], RAW_FLEET)


def test_classify(raw):
    found = {r["device_id"]: r["defects"] for r in quality.classify(raw).collect()}
    assert found == {
        "clean": [], "null": ["MISSING"], "text": ["CORRUPT_TYPE"], "signal": ["OUT_OF_RANGE"],
        "two": ["MISSING", "OUT_OF_RANGE"]}


def test_bounds_are_inclusive(spark):
    rows = spark.createDataFrame(
        [(str(s), "A", "12.5", s, "Success") for s in (9, 10, 100, 101)] + [("none", "A", "12.5", None, "x")],
        RAW_FLEET)
    bad = {r["device_id"]: r["defects"] for r in quality.quarantine(rows)[1].collect()}
    assert bad == {"9": ["OUT_OF_RANGE"], "101": ["OUT_OF_RANGE"], "none": ["MISSING"]}


def test_voltage_must_be_finite(spark):
    texts = ["NaN", "Infinity", "-Infinity", "1e999", "12.5", " 12 ", ""]
    rows = spark.createDataFrame([(t, "A", t, 50, "Success") for t in texts], RAW_FLEET)
    clean, bad = quality.quarantine(rows)
    assert sorted(r["battery_voltage"] for r in clean.collect()) == [12.0, 12.5]
    assert {r["device_id"]: r["defects"] for r in bad.collect()} == {
        t: ["CORRUPT_TYPE"] for t in ("NaN", "Infinity", "-Infinity", "1e999", "")}


def test_counts(raw):
    assert {r[0]: r[1] for r in quality.corruption_counts(raw).collect()} == {
        "MISSING": 2, "CORRUPT_TYPE": 1, "OUT_OF_RANGE": 2}


def test_quarantine_splits_all_rows(raw):
    clean, bad = quality.quarantine(raw)
    assert clean.count() + bad.count() == raw.count()
    assert dict(clean.dtypes)["battery_voltage"] == "double"
    assert [r["device_id"] for r in clean.collect()] == ["clean"]


def test_quarantine_sink_writes_both_sides(raw, spark, tmp_path):
    path = str(tmp_path / "split")
    sinks.write_quarantine(quality.classify(raw), path)
    assert {r[0]: r[1] for r in spark.read.parquet(path).groupBy("quarantined").count().collect()} == {
        "false": 1, "true": 4}


def test_triage_and_actions(raw, spark):
    held = spark.createDataFrame(
        [("held", "A", "12.5", 50, "SECURITY_HOLD"), ("part", "A", "12.5", 50, "Partial"),
         ("nothing", "A", "12.5", 50, None)], RAW_FLEET)
    actions = quality.recovery_actions(raw.unionByName(held))
    assert quality.triage_count(actions).first()[0] == 5
    assert {r[0]: r[1] for r in quality.recovery_action_distribution(actions).collect()} == {
        "MANUAL_TRIAGE": 5, "RECOVER": 1, "NONE": 2}


def test_actions_survive_csv(raw, spark, tmp_path):
    actions = quality.recovery_actions(raw)
    path = str(tmp_path / "actions")
    sinks.write_csv(actions, path)
    back = tables.csv_table(spark, path, RECOVERY_ACTIONS)
    assert sorted(map(str, back.collect())) == sorted(map(str, actions.collect()))
    assert not back.isEmpty()


def test_integrity(raw):
    assert quality.integrity_check(raw, 5, 6).first().asDict() == {
        "row_count": 5, "not_empty": True, "meets_minimum": True, "matches_expected": False}
    assert quality.integrity_check(raw.limit(0), 1).first().asDict() == {
        "row_count": 0, "not_empty": False, "meets_minimum": False, "matches_expected": None}


def test_defects_after_three_random_injections(spark, testdata):
    """50 NULL voltages, 50 bad signals, 50 garbage voltages, drawn independently."""
    rows = views.fleet(spark, str(testdata / "sf0.001")).withColumn(
        "battery_voltage", F.col("battery_voltage").cast("string"))
    for seed, (column, value) in enumerate(
            [("battery_voltage", None), ("signal_strength", -999), ("battery_voltage", "UNKNOWN")]):
        rows = state.sample_update(rows, 50, column, value, seed)
    counts = {r[0]: r[1] for r in quality.corruption_counts(rows).collect()}
    assert counts["OUT_OF_RANGE"] == 50 and counts["CORRUPT_TYPE"] == 50
    assert 0 <= counts.get("MISSING", 0) <= 50
    assert 50 <= quality.quarantine(rows)[1].count() <= 150
