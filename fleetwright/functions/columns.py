"""Column expressions shared by the operators."""

from pyspark.sql import Column, functions as F


def device_id(number: Column) -> Column:
    """`DEV-` and at least eight lower-case hex digits.

    The width grows with the number: a fixed pad to eight would truncate, and
    so merge, ids above 2^32.
    """
    digits = F.lower(F.hex(number))
    return F.concat(F.lit("DEV-"), F.lpad(digits, F.greatest(F.lit(8), F.length(digits)), F.lit("0")))


def percent_of(part: Column, whole: Column) -> Column:
    """`part * 100 / whole` to two decimals, NULL when `whole` is zero."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 2)


def ratio_percent(part: Column, whole: Column) -> Column:
    """`(part / whole) * 100` to two decimals.

    Differs from `percent_of` in the last digit for some ties; each report
    keeps the formula it was defined with.
    """
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, 2)


def shard_of(key: Column, shards: int) -> Column:
    """A stable, even shard number from the first 32 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(shards)


def shuffled_rank(key: Column, seed) -> Column:
    """A pseudo-random sort key that depends on the row alone.

    Unlike `rand(seed)` it does not change with the partitioning, so a lost
    executor cannot change which rows a sample holds.
    """
    return F.md5(F.concat(key, F.lit(f"#{seed}")))
