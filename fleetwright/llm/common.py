"""What the corpus operators share: whole-text words, written tables, sorted runs."""

import ctypes
import gc
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetwright.session import scratch_path, ship_package
from fleetwright.sources.tables import parquet_table

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# A word is a run of anything but these characters. `bytes.split()` splits at exactly them.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    ship_package(spark)
    return parquet_table(spark, folder, "documents", DOCUMENTS)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and continue from the files.

    The rows are then fixed: an executor lost later costs no recomputation, and
    ids drawn while writing stay as they are.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_mod(key: str, modulus: int) -> Column:
    """crc32 of a key's text modulo `modulus`; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from learning. A row without a key always is."""
    return F.coalesce(crc32_mod(key, modulus) == remainder, F.lit(True))


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL as empty."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    return [value or b"" for value in column.to_pylist()]


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most `rows` rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


@cache
def _malloc_trim():
    """What the C library has for returning freed memory; None if it has nothing."""
    try:
        return getattr(ctypes.CDLL(None), "malloc_trim", None)
    except (OSError, TypeError):
        return None


_CACHES: list[dict] = []


def worker_cache() -> dict:
    """What an operator keeps in a worker from one partition to the next, until another makes room."""
    _CACHES.append({})
    return _CACHES[-1]


def make_room() -> None:
    """Drop what other operators have left in this worker: it outlives their stages."""
    for kept in _CACHES:
        kept.clear()
    give_back()


def give_back() -> None:
    """Return to the system what a worker has freed, as it goes on to run other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _malloc_trim():
        _malloc_trim()(0)


def sized(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int, most_rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most so many rows and bytes of text; a longer text is a part of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        until, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = until[start - 1] if start else 0
            end = min(max(int(np.searchsorted(until, before + most_bytes, "right")), start + 1), start + most_rows)
            yield batch.slice(start, end - start)
            start = min(end, batch.num_rows)


def sorted_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of equal `key` of a partition sorted by it.

    Yields tables that end where a run ends, with the starts of their runs. A run
    is held in memory, so the caller bounds what has one key.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if held and cut == 0 and held[-1].column(key)[-1].as_py() == keys[0]:
            held.append(batch)
            continue
        if held or cut:
            head = batch.slice(0, cut)
            table = pa.Table.from_batches([*held, head] if cut else held)
            yield table, _starts(table, key)
        held = [batch.slice(cut)]
    if held:
        table = pa.Table.from_batches(held)
        yield table, _starts(table, key)


def _starts(table: pa.Table, key: str) -> np.ndarray:
    keys = table.column(key).to_numpy()
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
