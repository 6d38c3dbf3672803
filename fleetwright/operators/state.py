"""Fleet state changes. Each returns the new fleet (or a report) as a DataFrame."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwright.functions.columns import shard_of, shuffled_rank
from fleetwright.functions.ordering import ordered_slice, with_row_index
from fleetwright.schemas import LOAD_BATCH_ROWS, PARTIAL, RECOVERED, SECURITY_HOLD, STATUSES

# Our own names for the result of a recovery shard.
SHARD_RECOVERED = "RECOVERED"
SHARD_EMPTY = "EMPTY"


def recover(fleet: DataFrame) -> DataFrame:
    """Every partially updated device becomes recovered; a second run changes nothing.

    The status is tested in the same pass that sets it, so a device put on
    hold meanwhile is left alone.
    """
    status = F.col("update_status")
    return fleet.withColumn("update_status", F.when(status == PARTIAL, RECOVERED).otherwise(status))


def recovery_page(fleet: DataFrame, limit: int, offset: int) -> DataFrame:
    """The ids of one page of partially updated devices, in id order.

    Runs a job, see `ordered_slice`.
    """
    partial = fleet.filter(F.col("update_status") == PARTIAL).select("device_id")
    return ordered_slice(partial, ["device_id"], limit, offset)


def recovery_shard_report(fleet: DataFrame, shards: int) -> DataFrame:
    """(shard_id, found, updated, outcome), a row for empty shards too.

    `found` are the partial devices of a shard, `updated` those that `recover`
    gives another status. Shards are hash buckets of the id: even, and independent
    of row order.
    """
    partial = fleet.filter(F.col("update_status") == PARTIAL).withColumn("_before", F.col("update_status"))
    changed = ~F.col("update_status").eqNullSafe(F.col("_before"))
    counted = (
        recover(partial).groupBy(shard_of(F.col("device_id"), shards).alias("shard_id"))
        .agg(F.count("*").alias("found"), F.count_if(changed).alias("updated"))
    )
    every = fleet.sparkSession.range(shards).withColumnRenamed("id", "shard_id")
    none = F.lit(0).cast("bigint")
    return every.join(counted, "shard_id", "left").select(
        "shard_id", F.coalesce("found", none).alias("found"), F.coalesce("updated", none).alias("updated"),
        F.when(F.col("updated") > 0, SHARD_RECOVERED).otherwise(SHARD_EMPTY).alias("outcome"),
    )


def recovery_tally(report: DataFrame) -> DataFrame:
    """Shards by outcome, and devices recovered, of a shard report."""
    return report.agg(
        F.count_if(F.col("outcome") == SHARD_RECOVERED).alias("shards_recovered"),
        F.count_if(F.col("outcome") == SHARD_EMPTY).alias("shards_empty"),
        F.coalesce(F.sum("updated"), F.lit(0).cast("bigint")).alias("devices_recovered"),
    )


def _last_known(changes: DataFrame, order: str | None) -> DataFrame:
    """(device_id, _known, _known_at): the last of the fleet's own statuses for each device.

    Aggregated as their numbers in `STATUSES`: with an order that is a number, Spark then
    combines by hash, before the shuffle and without a sort, however often a device reports.
    """
    known = F.array(*[F.lit(s) for s in STATUSES])
    numbered = changes.filter(F.col("status").isin(STATUSES)).withColumn(
        "_number", F.array_position(known, F.col("status")).cast("int"))
    pick = F.max("_number") if order is None else F.max_by("_number", order)
    at = F.lit(None).cast("int") if order is None else F.max(order)
    return numbered.groupBy("device_id").agg(pick.alias("_number"), at.alias("_known_at")).select(
        "device_id", F.get(known, F.col("_number") - 1).alias("_known"), "_known_at")


def _last_other(changes: DataFrame, order: str | None) -> DataFrame:
    """(device_id, _other, _other_at): the last status that is none of the fleet's own.

    Reports of one device and text combine by hash first; what is left is ordered.
    """
    others = changes.filter(F.col("status").isNotNull() & ~F.col("status").isin(STATUSES))
    at = F.lit(0) if order is None else F.col(order)
    each = others.groupBy("device_id", F.col("status").alias("_other")).agg(F.max(at).alias("_other_at"))
    last = Window.partitionBy("device_id").orderBy(F.desc("_other_at"), F.desc("_other"))
    return each.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") == 1).drop("_n")


def _newer(order: str | None) -> Column:
    """The later of the two; where both are as late, or nothing tells, the one that is not the fleet's own."""
    if order is None:
        return F.coalesce("_other", "_known")
    return F.when(F.col("_other").isNull() | (F.col("_known_at") > F.col("_other_at")), F.col("_known")).otherwise(F.col("_other"))


def last_status(changes: DataFrame, order: str | None = None) -> DataFrame:
    """(device_id, status): one change per device, the last by `order`.

    Any text may be a status; a NULL one is no change. Without an order the changes of one
    device have no last; they collapse to the greatest status, so that a join on the result never
    multiplies rows.
    """
    met = _last_known(changes, order).join(_last_other(changes, order), "device_id", "full_outer")
    return met.select("device_id", _newer(order).alias("status"))


def apply_status(fleet: DataFrame, changes: DataFrame, order: str | None = None) -> DataFrame:
    """Set the status of the listed devices; ids the fleet does not know change nothing."""
    return (
        fleet.join(_last_known(changes, order), "device_id", "left").join(_last_other(changes, order), "device_id", "left")
        .withColumn("update_status", F.coalesce(_newer(order), "update_status"))
        .select(*fleet.columns)
    )


def security_hold(fleet: DataFrame, violations: DataFrame) -> DataFrame:
    """Put the listed devices on security hold, however often they are listed."""
    return _set_where(fleet, violations.select("device_id").distinct(), "update_status", F.lit(SECURITY_HOLD))


def _set_where(fleet: DataFrame, keys: DataFrame, column: str, value: Column) -> DataFrame:
    """`column` set to `value` for the rows of a frame of distinct keys."""
    key = keys.columns[0]
    listed = keys.withColumn("_listed", F.lit(True))
    new = F.when(F.col("_listed"), value).otherwise(F.col(column))
    return fleet.join(listed, key, "left").withColumn(column, new).select(*fleet.columns)


def assign_batches(rows: DataFrame, *keys: str, batch_rows: int = LOAD_BATCH_ROWS) -> DataFrame:
    """Add `batch_id`: consecutive batches of `batch_rows` rows in the order of `keys`.

    Runs a job, see `with_row_index`; `row_index` stays in the result.
    """
    numbered = with_row_index(rows, *keys)
    return numbered.withColumn("batch_id", F.floor(F.col("row_index") / batch_rows).cast("bigint"))


def batch_ledger(rows: DataFrame, *keys: str, batch_rows: int = LOAD_BATCH_ROWS) -> DataFrame:
    """(batch_id, rows_in_batch, running_total), the last batch possibly short.

    Batches are consecutive, so the running total is the last row number of
    the batch: no window has to walk the ledger in one task.
    """
    assigned = assign_batches(rows.select(*keys), *keys, batch_rows=batch_rows)
    return assigned.groupBy("batch_id").agg(
        F.count("*").alias("rows_in_batch"), (F.max("row_index") + 1).alias("running_total"))


def key_violations(fleet: DataFrame, key: str = "device_id") -> DataFrame:
    """Keys that break uniqueness or are NULL, with the number of their rows."""
    rows = fleet.groupBy(key).agg(F.count("*").alias("row_count"))
    return rows.filter((F.col("row_count") > 1) | F.col(key).isNull())


# Sample ranks are numbers below this.
_RANKS = 1 << 60


def sample_candidates(keys: DataFrame, n: int, seed, key: str, rows: int) -> DataFrame:
    """Keys with a rank below the bound that, of `rows` of them, some more than `n` have; no shuffle.

    A rank is a hash of the key, so a key is in or not wherever it is read.
    """
    wanted = n + 8 * int(n ** 0.5) + 32
    bound = _RANKS if wanted >= rows else _RANKS * wanted // rows
    rank = F.conv(F.substring(shuffled_rank(F.col(key), seed), 1, 15), 16, 10).cast("bigint")
    return keys.select(key, rank.alias("_rank")).filter(F.col("_rank") < F.lit(bound).cast("bigint"))


def _sampled_keys(keys: DataFrame, n: int, seed, key: str) -> DataFrame:
    """The `n` keys of the lowest ranks. Only keys below a bound are moved, a few more than `n`;
    should there be fewer, which is next to impossible, all are."""
    rows = keys.agg(F.count(key)).first()[0]
    few = sample_candidates(keys, n, seed, key, rows)
    if few.count() < min(n, rows):
        few = sample_candidates(keys, rows, seed, key, rows)
    return ordered_slice(few, ["_rank", key], n).select(key)


def sample_exact_n(
    fleet: DataFrame, n: int, seed=0, key: str = "device_id", keys: DataFrame | None = None,
) -> DataFrame:
    """Exactly `n` devices (or all, if fewer), every one equally likely.

    Keys are drawn first, from the key column alone; the rows follow by semi-join.
    `keys` may give the fleet's keys from a cheaper source than the fleet. Runs jobs
    that count, see `ordered_slice`.
    """
    return fleet.join(_sampled_keys(fleet if keys is None else keys, n, seed, key), key, "left_semi")


def sample_update(
    fleet: DataFrame, n: int, column: str, value, seed=0, key: str = "device_id", keys: DataFrame | None = None,
) -> DataFrame:
    """Set `column` to `value` on exactly `n` sampled devices, leave the others; see `sample_exact_n`."""
    new: Column = value if isinstance(value, Column) else F.lit(value)
    new = new.cast(fleet.schema[column].dataType)
    return _set_where(fleet, _sampled_keys(fleet if keys is None else keys, n, seed, key), column, new)
