"""A table kept in folders by ranges of its key.

An index beside the folders holds the bounds and the number of rows of each, one row per
folder. A page of the table in key order is found in the index, and a change set falls into
the folders of its keys: both read those folders and no others, and a merge writes those
only. What a merge changed is kept as a log, from which reports follow without the table.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fleetwright.operators.state import last_status
from fleetwright.session import scratch_path

# Bounds compared at once while the folder of a key is looked for.
_STEP = 32
# Rows of a folder that a merge writes into one file, about.
_FILE_ROWS = 1_000_000


def save_ranged(df: DataFrame, path: str, key: str, folders: int) -> None:
    """Store `df` in up to `folders` ranges of `key`, each sorted, with their index."""
    placed = df.repartitionByRange(folders, key).sortWithinPartitions(key).withColumn("folder", F.spark_partition_id())
    placed.write.mode("errorifexists").partitionBy("folder").parquet(f"{path}/rows")
    stored = df.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    stored.groupBy("folder").agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("rows")).coalesce(
        1).write.mode("errorifexists").parquet(f"{path}/index")


def read_ranged(spark: SparkSession, path: str) -> DataFrame:
    return _rows(spark, path).drop("folder")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows with their folder. The columns are those of the files; one footer tells them."""
    return spark.read.parquet(f"{path}/rows")


def _index(spark: SparkSession, path: str) -> list:
    """One row per folder, in key order."""
    rows = spark.read.schema("folder int, low string, high string, rows bigint").parquet(f"{path}/index").collect()
    return sorted(rows, key=lambda r: r["folder"])


def _in_folders(rows: DataFrame, folders: list[int]) -> DataFrame:
    return rows.filter(F.expr(f"folder IN ({', '.join(map(str, folders))})") if folders else F.lit(False))


def read_page(spark: SparkSession, path: str, key: str, limit: int, offset: int) -> DataFrame:
    """Rows `offset .. offset + limit - 1` in the order of `key`, from the folders they lie in.

    Rows with equal keys are in no order among themselves.
    """
    first, before = {}, 0
    for row in _index(spark, path):
        if before < offset + limit and before + row["rows"] > offset:
            first[row["folder"]] = before
        before += row["rows"]
    held = _in_folders(_rows(spark, path), list(first))
    begins = F.create_map(*[F.lit(v) for pair in first.items() for v in pair]) if first else F.expr("map(0, 0)")
    place = F.row_number().over(Window.partitionBy("folder").orderBy(F.asc_nulls_first(key))) - 1
    numbered = held.withColumn("_row", F.element_at(begins, F.col("folder").cast("int")).cast("bigint") + place)
    return numbered.filter((F.col("_row") >= offset) & (F.col("_row") < offset + limit)).drop("_row", "folder")


def folder_of(key: Column, lows: list[str], folders: list[int]) -> Column:
    """The folder in whose range a key lies or would lie: among every `_STEP`-th bound first, then between two."""
    coarse = F.lit(lows[::_STEP])
    part = F.greatest(F.size(F.filter(coarse, lambda low: low <= key)) - 1, F.lit(0))
    fine = F.slice(F.lit(lows), part * _STEP + 1, F.lit(_STEP))
    place = part * _STEP + F.greatest(F.size(F.filter(fine, lambda low: low <= key)) - 1, F.lit(0))
    return F.get(F.lit(folders), place)


def merge_status(
    spark: SparkSession, path: str, changes: DataFrame, merge: int, order: str | None = None,
    key: str = "device_id", column: str = "update_status",
) -> DataFrame:
    """Set `column` for the keys that `changes` (device_id, status) lists; returns the log of the merge.

    Only folders a change falls into are read and written again. The log has the rows that
    changed, with `before`; it is written first and once for each number `merge`, so a merge that
    was cut off is repeated under its number. Unknown keys change nothing.
    """
    index = [row for row in _index(spark, path) if row["low"] is not None]
    log_path = f"{path}/log/merge={merge}"
    latest = last_status(changes.filter(F.col("device_id").isNotNull()), order)
    rows = _rows(spark, path)
    schema = rows.drop("folder").schema.add("before", "string")
    hit = []
    # The changes are read and reduced once: both the folders and the join need the last ones.
    named = latest.select(F.col("device_id").alias(key), F.col("status").alias("_status"))
    if index:
        placed = latest.withColumn("folder", folder_of(F.col("device_id"), [r["low"] for r in index], [r["folder"] for r in index]))
        last = scratch_path(spark, "changes")
        placed.write.parquet(last)
        placed = spark.read.schema(placed.schema).parquet(last)
        hit = [row[0] for row in placed.select("folder").distinct().collect()]  # at most one for each folder
        named = placed.select(F.col("device_id").alias(key), F.col("status").alias("_status"))
    merged = _in_folders(rows, hit).join(named, key, "left").withColumn("before", F.col(column)).withColumn(
        column, F.coalesce("_status", column)).drop("_status")
    # Rows are read from the folders that are written, so they are put down in between.
    between = scratch_path(spark, "merge")
    merged.write.parquet(between)
    merged = spark.read.schema(merged.schema).parquet(between)
    if not written(spark, log_path):
        changed = merged.filter(~F.col("before").eqNullSafe(F.col(column))).select(*schema.names)
        changed.write.mode("overwrite").parquet(log_path)
    if hit:
        # A folder is written by as many tasks as its rows ask for, not by one.
        parts = 1 + max(row["rows"] for row in index) // _FILE_ROWS
        (
            merged.drop("before").repartition("folder", F.pmod(F.xxhash64(key), F.lit(parts))).sortWithinPartitions("folder", key)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder").parquet(f"{path}/rows")
        )
    return spark.read.schema(schema).parquet(log_path)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to the end."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
