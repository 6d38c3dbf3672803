"""Cutting a payload column into consecutive chunks."""

from pyspark.sql import Column, functions as F


def text_chunks(payload: Column, size: int) -> Column:
    """Consecutive pieces of `size` characters, the last one possibly shorter.

    One linear pass: cutting with `substring` would walk the text from its
    start for every chunk, because UTF-8 offsets are not character offsets.
    """
    return F.regexp_extract_all(payload, F.lit("(?s).{1,%d}" % size), F.lit(0))


def binary_chunks(payload: Column, size: int) -> Column:
    """Consecutive pieces of `size` bytes."""
    count = F.ceil(F.octet_length(payload) / F.lit(size)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
        lambda i: F.substring(payload, i * size + 1, F.lit(size)),
    )
    # sequence(0, -1) would count downwards, so an empty payload is its own case.
    return F.when(count > 0, cut).otherwise(F.array().cast("array<binary>"))
