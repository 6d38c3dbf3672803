"""Writers: append, table replacement, bucketed tables, CSV and JDBC batches."""

from pyspark.sql import DataFrame, functions as F

from fleetwright.schemas import LOAD_BATCH_ROWS


def append(df: DataFrame, path: str) -> None:
    """Append rows to a parquet table."""
    df.write.mode("append").parquet(path)


def replace_table(df: DataFrame, name: str, version: int) -> None:
    """Publish `df` as the new content of `name`.

    Written as a table of its own, then the view `name` is pointed at it: the
    old version may be an input of `df`, and readers never see half a table.
    """
    target = f"{name}_v{version}"
    df.write.mode("errorifexists").saveAsTable(target)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {target}")


def save_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> None:
    """Save a table bucketed and sorted by `keys`.

    Two tables saved with the same keys and bucket count join on them without
    a shuffle: manifest entries and landed chunks, or a fleet and its changes.
    """
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys).sortBy(*keys)
        .mode("errorifexists").saveAsTable(name)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line, one file per task."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_quarantine(classified: DataFrame, path: str) -> None:
    """Write clean and quarantined rows in one pass, below `quarantined=false|true`."""
    (
        classified.withColumn("quarantined", F.size("defects") > 0)
        .write.mode("errorifexists").partitionBy("quarantined").parquet(path)
    )


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict | None = None,
    batch_rows: int = LOAD_BATCH_ROWS,
) -> None:
    """Append to a database table, `batch_rows` rows per round trip.

    Spark commits once per partition, so a failed task leaves no half batch
    behind; a retried task repeats its whole partition.
    """
    (
        df.write.mode("append")
        .option("batchsize", batch_rows)
        .jdbc(url, table, properties=properties or {})
    )
