"""Data quality: defect classification, quarantine, triage, integrity."""

from pyspark.sql import Column, DataFrame, functions as F

from fleetwright.schemas import (
    CORRUPT_TYPE, MANUAL_TRIAGE, MISSING, NO_ACTION, OUT_OF_RANGE, PARTIAL, RECOVER, SECURITY_HOLD,
    SIGNAL_MAX, SIGNAL_MIN, UNREADABLE_LINE,
)
from fleetwright.sources.tables import UNREADABLE


def _defects(signal_min: int, signal_max: int) -> Column:
    voltage, signal = F.col("battery_voltage"), F.col("signal_strength")
    number = voltage.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    unreadable = voltage.isNotNull() & ~finite
    return F.array_compact(F.array(
        F.when(voltage.isNull() | signal.isNull(), MISSING),
        F.when(unreadable, CORRUPT_TYPE),
        F.when(~signal.between(signal_min, signal_max), OUT_OF_RANGE),
    ))


def classify(raw: DataFrame, signal_min: int = SIGNAL_MIN, signal_max: int = SIGNAL_MAX) -> DataFrame:
    """Add `defects`: the kinds of corruption of a row, empty when it is clean.

    The voltage is text here; text that is no finite number is a defect, not a
    failure. A reading that is missing, voltage or signal, is one as well. A row of a line
    that could not be read (see `tables.csv_lines`) has that one defect, as its readings tell
    nothing.
    """
    defects = _defects(signal_min, signal_max)
    if UNREADABLE in raw.columns:
        defects = F.when(F.col(UNREADABLE).isNotNull(), F.array(F.lit(UNREADABLE_LINE))).otherwise(defects)
    return raw.withColumn("defects", defects)


def corruption_counts(raw: DataFrame) -> DataFrame:
    """(defect, row_count). A row with two defects counts for both."""
    return (
        classify(raw).select(F.explode("defects").alias("defect"))
        .groupBy("defect").agg(F.count("*").alias("row_count"))
    )


def quarantine(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows with a numeric voltage, quarantined rows with their defects).

    To store both, `sinks.write_quarantine` writes them in one pass.
    """
    rows = classify(raw)
    clean = rows.filter(F.size("defects") == 0).drop("defects", UNREADABLE)
    clean = clean.withColumn("battery_voltage", F.col("battery_voltage").try_cast("double"))
    return clean, rows.filter(F.size("defects") > 0)


def recovery_actions(raw: DataFrame) -> DataFrame:
    """Add `recovery_action`: triage for defects and holds, recovery for partial updates."""
    status = F.col("update_status")
    triage = (F.size("defects") > 0) | F.coalesce(status == SECURITY_HOLD, F.lit(False))
    action = F.when(triage, MANUAL_TRIAGE).when(status == PARTIAL, RECOVER).otherwise(NO_ACTION)
    return classify(raw).withColumn("recovery_action", action).drop("defects")


def recovery_action_distribution(actions: DataFrame) -> DataFrame:
    """(recovery_action, count)."""
    return actions.groupBy("recovery_action").agg(F.count("*").alias("count"))


def triage_count(actions: DataFrame) -> DataFrame:
    """One row: how many devices need manual triage."""
    needs_triage = F.col("recovery_action") == MANUAL_TRIAGE
    return actions.agg(F.count_if(needs_triage).alias("triage_count"))


def integrity_check(fleet: DataFrame, min_rows: int, expected_rows: int | None = None) -> DataFrame:
    """One row: the row count and how it compares with what was expected."""
    count = F.col("row_count")
    return fleet.agg(F.count("*").alias("row_count")).select(
        "row_count",
        (count > 0).alias("not_empty"),
        (count >= min_rows).alias("meets_minimum"),
        (F.lit(None).cast("boolean") if expected_rows is None else count == expected_rows)
        .alias("matches_expected"),
    )
