"""Verify firmware chunks as they arrive.

A micro-batch is small beside the manifest entries of all images, so it must not
read them all: entries are stored in folders of consecutive images, sorted by image,
and a batch reads the folders its chunks fall into, there only the range of its images.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from fleetwright.operators.firmware import HEADS, delivered_hashes, match_chunks
from fleetwright.sources.ranged import written

IMAGES_PER_FOLDER = 10_000
# A landed file is read however much older than the newest one it is.
OLDEST_FILE = "36500d"


def image_folder(images: int) -> Column:
    return F.floor(F.col("firmware_id") / images)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Sorted ranges of `keys`, to be written in folders. Their number is stated: the files take the
    time, and the adaptive planner would merge small rows into few tasks whatever the number of folders."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartitionByRange(parts, *keys).sortWithinPartitions("folder", *keys)


def save_entries(entries: DataFrame, path: str, images: int = IMAGES_PER_FOLDER) -> None:
    """Store manifest entries that name a chunk, a folder for every `images` image numbers.

    Dealt by ranges of image and chunk: a huge image is written by several tasks,
    and every file holds a narrow range of images.
    """
    named = entries.filter(F.col("chunk_index").isNotNull()).drop("chunk_key").withColumn("folder", image_folder(images))
    _dealt(named, "firmware_id", "chunk_index").write.mode("errorifexists").partitionBy("folder").parquet(path)


def _pruned(stored: DataFrame, batch: DataFrame, images: int) -> DataFrame:
    """The rows of a table stored in folders of images among which those of the batch's images are.

    The numbers of the folders the batch falls into, and the range of its images, come to
    the driver and prune folders and files before anything is read.
    """
    hit = batch.groupBy(image_folder(images).alias("folder")).agg(
        F.min("firmware_id").alias("low"), F.max("firmware_id").alias("high")).filter("folder IS NOT NULL").collect()
    if not hit:
        return stored.filter("false").drop("folder")
    # One list, read as SQL: a condition for each folder would nest without end.
    listed = F.expr(f"folder IN ({', '.join(str(row['folder']) for row in hit)})")
    within = F.col("firmware_id").between(min(row["low"] for row in hit), max(row["high"] for row in hit))
    return stored.filter(listed & within).drop("folder")


def entries_of(batch: DataFrame, path: str, images: int = IMAGES_PER_FOLDER) -> DataFrame:
    """The stored entries among which those of the batch's images are."""
    stored = batch.sparkSession.read.schema(
        "firmware_id bigint, chunk_index int, expected_hash string, folder bigint").parquet(path)
    return _pruned(stored, batch, images)


def save_heads(heads: DataFrame, path: str, images: int = IMAGES_PER_FOLDER) -> None:
    """Store `firmware.manifest_heads`, a folder for every `images` image numbers."""
    placed = heads.withColumn("folder", image_folder(images))
    _dealt(placed, "firmware_id").write.mode("errorifexists").partitionBy("folder").parquet(path)


def chunk_stream(
    spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 1_000,
) -> DataFrame:
    """A file stream of a landing folder (or path pattern), with `arrived_at`: when its batch began.

    Not the files' own time, which may lie far back for a copied file: no chunk can
    then be late, and none is left out unverified.
    """
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("maxFileAge", OLDEST_FILE)
        .parquet(path)
        .select("*", F.current_timestamp().alias("arrived_at"))
    )


def new_hashes(chunks: DataFrame, late: str = "1 hour") -> DataFrame:
    """Hashes of streamed chunks (with `arrived_at`), repeats that arrive within `late` left out.

    The hash is part of what makes a repeat, so a second delivery with other
    content is not hidden. The payload is hashed before the shuffle; the state
    holds hashes of the last `late`, spread by image and chunk.
    """
    return (
        delivered_hashes(chunks, "arrived_at")
        .withWatermark("arrived_at", late)
        .dropDuplicatesWithinWatermark(["firmware_id", "chunk_index", "actual_hash"])
    )


def verify_available(
    hashes: DataFrame, entries_path: str, results_path: str, checkpoint: str, images: int = IMAGES_PER_FOLDER,
    heads_path: str | None = None,
) -> None:
    """Check what has arrived since the last call, store the results, and return.

    Runs the stream. Each micro-batch fills a folder of its own; when it is repeated after a
    failure a folder that was filled stays as it is, so every chunk appears once. With
    `heads_path` a row also has `arrived_at` and what `image_verify` needs of its image.
    """
    def check(batch: DataFrame, batch_id: int) -> None:
        path = f"{results_path}/batch={batch_id}"
        if written(batch.sparkSession, path):
            return
        batch = (batch if heads_path else batch.drop("arrived_at")).persist()
        try:
            results = match_chunks(batch, entries_of(batch, entries_path, images))
            if heads_path:
                stored = batch.sparkSession.read.schema(f"{HEADS}, folder bigint").parquet(heads_path)
                results = results.join(_pruned(stored, batch, images), "firmware_id", "left")
            results.write.mode("overwrite").parquet(path)
        finally:
            batch.unpersist()

    query = (
        hashes.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

