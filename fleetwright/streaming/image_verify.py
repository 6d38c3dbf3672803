"""The verdict of an image while its chunks arrive.

A second stream reads what `chunk_verify` stored of each chunk and keeps one state per
image: how many chunks came, which ones as a bitmap, how many were bad. The verdict is
given once: as soon as it is certain, with the last chunk, or when nothing has come for
`patience`. It is the verdict that the batch verification gives for the same chunks.

What comes for an image after its verdict changes nothing; it is still reported chunk by
chunk. An image without a manifest has none, as in the batch. Time is that of arrival: the
watermark, and with it every timer, moves when something arrives, see `tick`.
"""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from fleetwright.operators.firmware import CHUNK_OK, ENTRY_WITHOUT_HASH, HEADS, MISSING_IN_MANIFEST
from fleetwright.schemas import CHUNK_ERROR, COUNT_MISMATCH, MALFORMED_MANIFEST, OK, SEQUENCE_ERROR

CHECKED = f"chunk_index int, actual_hash string, arrived_at timestamp, expected_hash string, result string, {HEADS}"
VERDICTS = "firmware_id bigint, firmware_version string, verdict string, error_count bigint, delivered bigint"
_STATE = (
    "decided boolean, version string, total bigint, bad_key string, in_sequence boolean, early string, "
    "delivered bigint, bad bigint, bare bigint, seen binary, faulty binary, strange binary"
)
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Progress:
    """What has come of one image. `seen` and `faulty` are bitmaps of the indices below the
    total; the others, no more than the total before the verdict is certain, are listed."""

    def __init__(self, version, total, bad_key, in_sequence, early, delivered=0, bad=0, bare=0, seen=b"", faulty=b"", strange=b""):
        self.version, self.total, self.bad_key, self.in_sequence, self.early = version, total, bad_key, in_sequence, early
        self.delivered, self.bad, self.bare = delivered, bad, bare
        size = -(-max(total or 0, 0) // 8)
        self.seen, self.faulty = (np.frombuffer(b or bytes(size), np.uint8).copy() for b in (seen, faulty))
        # Above the bits of an index: whether it was found bad.
        self.strange = {int(v) >> 1: bool(v & 1) for v in np.frombuffer(strange, np.int64)}

    def packed(self) -> tuple:
        strange = np.array([2 * index + bad for index, bad in self.strange.items()], np.int64)
        return (False, self.version, self.total, self.bad_key, self.in_sequence, self.early, self.delivered, self.bad, self.bare,
                self.seen.tobytes(), self.faulty.tobytes(), strange.tobytes())

    def add(self, indices: list[int], results: list[str]) -> None:
        self.delivered += len(indices)
        if self.early or self.delivered > self.total:
            return  # The verdict is certain, so that the state needs no more.
        for index, result in zip(indices, results):
            before, was_bad = self._look(index)
            bare = result == ENTRY_WITHOUT_HASH
            bad = not bare and (result != CHUNK_OK or before)
            self.bare += bare and not before
            self.bad += bad and not was_bad
            self._mark(index, was_bad or bad)

    def _look(self, index: int) -> tuple[bool, bool]:
        if 0 <= index < self.total:
            at, bit = index >> 3, 1 << (index & 7)
            return bool(self.seen[at] & bit), bool(self.faulty[at] & bit)
        return index in self.strange, self.strange.get(index, False)

    def _mark(self, index: int, bad: bool) -> None:
        if 0 <= index < self.total:
            at, bit = index >> 3, 1 << (index & 7)
            self.seen[at] |= bit
            self.faulty[at] |= bit if bad else 0
        else:
            self.strange[index] = bad

    @property
    def certain(self) -> bool:
        return self.early is not None or self.delivered >= self.total

    def verdict(self) -> tuple[str, int]:
        """(verdict, number of errors) if nothing more comes."""
        if self.early:
            return self.early, 1
        if self.delivered != self.total:
            return COUNT_MISMATCH, 1
        if self.bare:
            return MALFORMED_MANIFEST, 1
        if self.bad:
            return CHUNK_ERROR, self.bad
        if self.bad_key is not None:
            return MALFORMED_MANIFEST, 1
        return (OK, 0) if self.in_sequence else (SEQUENCE_ERROR, 1)


# Chunks of an image that are looked at together.
_AT_ONCE = 10_000
# The index that a chunk without one counts under; no manifest lists it.
_NO_INDEX = -(1 << 40)


class _Images(StatefulProcessor):
    def __init__(self, patience_ms: int):
        self.patience_ms = patience_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("progress", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        stored = self.state.get()
        if stored is not None and stored[0]:
            for _ in rows:
                pass
            return
        progress = Progress(*stored[1:]) if stored is not None else None
        indices, results, last = [], [], None
        for row in rows:
            # A manifest has one of the two, its own fault or a total.
            if row["total_chunks"] is None and row["early"] is None:
                continue
            if progress is None:
                progress = Progress(row["firmware_version"], row["total_chunks"], row["bad_key"], bool(row["in_sequence"]), row["early"])
            index, result, arrived = row["chunk_index"], row["result"], row["arrived_ms"]
            indices.append(_NO_INDEX if index is None else index)
            results.append(MISSING_IN_MANIFEST if result is None else result)
            last = arrived if last is None or arrived > last else last
            if len(indices) == _AT_ONCE:
                progress.add(indices, results)
                indices, results = [], []
        if progress is None:
            return
        progress.add(indices, results)
        if progress.certain:
            yield self._decided(key, progress, stored is not None)
            return
        self.state.update(progress.packed())
        if stored is not None:
            self._without_timers()
        if last is not None:
            self.handle.registerTimer(last + self.patience_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.state.get()
        if stored is not None and not stored[0]:
            yield self._decided(key, Progress(*stored[1:]), True)

    def _decided(self, key, progress: Progress, waited: bool) -> Row:
        """The verdict, which is marked as given. Only an image that has waited has a timer."""
        verdict, errors = progress.verdict()
        self.state.update((True, None, None, None, None, None, None, None, None, None, None, None))
        if waited:
            self._without_timers()
        return Row(firmware_id=key[0], firmware_version=progress.version, verdict=verdict, error_count=errors, delivered=progress.delivered)

    def _without_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def close(self) -> None:
        pass


@contextmanager
def _state_store(spark: SparkSession):
    """The state is kept in RocksDB, on disk: timers need it."""
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_STORE, before)


def decide_available(
    spark: SparkSession, results_path: str, verdicts_path: str, checkpoint: str, patience_ms: int = 3_600_000, late: str = "10 minutes",
) -> None:
    """Give the verdicts that have become certain since the last call, store them, and return.

    Runs the stream over the results of `chunk_verify.verify_available` with heads. `late` is how
    far apart in time results may be stored that arrived together.
    """
    checked = spark.readStream.schema(CHECKED).parquet(f"{results_path}/batch=*").withWatermark("arrived_at", late)
    # The hashes have been compared; they do not move with the results.
    told = checked.withColumn("arrived_ms", F.unix_millis("arrived_at")).drop("actual_hash", "expected_hash")
    verdicts = told.groupBy("firmware_id").transformWithState(_Images(patience_ms), VERDICTS, "Append", "EventTime")
    with _state_store(spark):
        query = (
            verdicts.writeStream.format("parquet").option("path", verdicts_path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()


def tick(spark: SparkSession, results_path: str, at: str) -> None:
    """Tell the stream that it is `at` (a timestamp), where no chunk does."""
    nothing = spark.createDataFrame([(0,)], "batch int").select(
        *[F.lit(None).cast(kind).alias(name) for name, kind in (part.strip().split(" ") for part in CHECKED.split(","))])
    nothing.withColumn("arrived_at", F.lit(at).cast("timestamp")).write.parquet(f"{results_path}/batch=tick-{at.replace(' ', 'T').replace(':', '')}")


def read_verdicts(spark: SparkSession, verdicts_path: str) -> DataFrame:
    return spark.read.schema(VERDICTS).parquet(verdicts_path)
