"""Global row numbers and ordered slices without a single-task sort."""

from pyspark.sql import DataFrame, Window, functions as F

from fleetwright.session import cut_lineage

# monotonically_increasing_id() is the partition number above bit 33 and the
# row's position within the partition below it.
_POSITION_BITS = 33


def _place() -> tuple:
    """The partition of a row, and its position in it."""
    mark = F.monotonically_increasing_id()
    return F.shiftright(mark, _POSITION_BITS), mark.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def with_row_index(df: DataFrame, *keys: str, name: str = "row_index") -> DataFrame:
    """Number all rows from 0 in the order of `keys`, as a bigint.

    Range partitions are sorted in parallel and numbered by their own position
    plus the size of the partitions before them; only the partition sizes meet
    in one task. `keys` should identify a row (add a tie-break), since equal
    keys cannot be split over partitions. Runs a job: the sorted rows are
    checkpointed, because they are read for the sizes and again for the result.
    """
    ordered = cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    part, position = _place()
    placed = ordered.select("*", part.alias("_part"), position.alias("_position"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part").agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    # One row per partition of the frame above, so the bound of the broadcast
    # is the partition count, not the data.
    return (
        placed.join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + F.col("_position")).alias(name))
    )


def ordered_slice(df: DataFrame, keys: list[str], limit: int, offset: int = 0) -> DataFrame:
    """Rows `offset .. offset + limit - 1` in the order of `keys`.

    The rows are dealt to range partitions, which are counted; only those that
    hold rows of the slice are sorted, so neither a deep page nor a long one
    passes through one task. Runs a job for the counts, one number per partition;
    the dealt rows are checkpointed for the second reading. Where many pages are read of
    one table, `sources.ranged` keeps it dealt.
    """
    ranged = cut_lineage(df.repartitionByRange(*keys))
    part, position = _place()
    counts = sorted(ranged.groupBy(F.spark_partition_id().alias("part")).count().collect())
    first, before = {}, 0
    for number, rows in counts:
        if before < offset + limit and before + rows > offset:
            first[number] = before
        before += rows
    held = ranged.filter(F.spark_partition_id().isin(list(first))).sortWithinPartitions(*keys)
    begins = F.create_map(*[F.lit(v) for pair in first.items() for v in pair]) if first else F.expr("map(0, 0)")
    row = F.element_at(begins, part.cast("int")).cast("bigint") + position
    numbered = held.withColumn("_row", row)
    return numbered.filter((F.col("_row") >= offset) & (F.col("_row") < offset + limit)).drop("_row")
