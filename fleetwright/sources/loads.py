"""Loads that go on where an earlier one was cut off."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetwright.operators.state import assign_batches
from fleetwright.schemas import LOAD_BATCH_ROWS
from fleetwright.sources.ranged import written


def landed_batches(spark: SparkSession, path: str, part: int) -> DataFrame | None:
    """(batch_id) of one part's ledger; None while the part is not complete."""
    ledger = f"{path}/ledger/part={part}"
    return spark.read.schema("batch_id bigint").parquet(ledger) if written(spark, ledger) else None


def load(rows: DataFrame, path: str, *keys: str, batch_rows: int = LOAD_BATCH_ROWS, until: int | None = None) -> None:
    """Load `rows` in batches of `batch_rows` in the order of `keys`, those that have not landed yet.

    A call lands one part: the rows first, then the ledger of its batches, which makes them
    count. A call that was cut off left no ledger, so the next one writes its part again. Batches
    that a ledger lists are left out by an anti-join; `keys` identify a row, so a batch has the
    same rows in every call. With `until` only batches up to that number are loaded.
    """
    spark = rows.sparkSession
    missing, part = assign_batches(rows, *keys, batch_rows=batch_rows).drop("row_index"), 0
    while (landed := landed_batches(spark, path, part)) is not None:
        missing, part = missing.join(landed, "batch_id", "left_anti"), part + 1
    if until is not None:
        missing = missing.filter(F.col("batch_id") <= until)
    data = f"{path}/rows/part={part}"
    missing.write.mode("overwrite").parquet(data)
    stored = spark.read.schema(missing.schema).parquet(data)
    stored.select("batch_id").distinct().write.mode("overwrite").parquet(f"{path}/ledger/part={part}")


def read_load(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all complete parts, with their batch."""
    parts = 0
    while landed_batches(spark, path, parts) is not None:
        parts += 1
    # What a call that was cut off left behind does not count.
    folders = [f"{path}/rows/part={part}" for part in range(parts)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
