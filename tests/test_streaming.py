import glob
import os
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st
from pyspark.sql import Row, functions as F

from fleetwright.operators import firmware
from fleetwright.schemas import RECEIVED_CHUNKS
from fleetwright.streaming import chunk_verify, image_verify
from tests.firmware_cases import CASES, tables


IMAGES = 4


@pytest.fixture()
def landing(spark, tmp_path):
    records, received = tables(spark)
    paths = {name: str(tmp_path / name) for name in ("entries", "landing", "verified", "log")}
    chunk_verify.save_entries(firmware.manifest_entries(records), paths["entries"], IMAGES)

    def run():
        chunks = chunk_verify.chunk_stream(spark, paths["landing"], RECEIVED_CHUNKS)
        chunk_verify.verify_available(
            chunk_verify.new_hashes(chunks), paths["entries"], paths["verified"], paths["log"], IMAGES)
        return sorted(map(str, spark.read.parquet(paths["verified"]).drop("batch").collect()))

    return records, received, paths["landing"], run


def test_stream_equals_batch_over_two_arrivals(landing):
    records, received, path, run = landing
    batch = firmware.match_chunks(
        firmware.delivered_hashes(received), firmware.manifest_entries(records).drop("chunk_key")).distinct()
    expected = sorted(map(str, batch.select(
        "firmware_id", "chunk_index", "actual_hash", "expected_hash", "result").collect()))
    checked = firmware.chunk_hash_check(records, received).filter("actual_hash IS NOT NULL OR result = 'NOT_HASHABLE'")
    told = sorted(map(str, checked.select(
        "firmware_id", F.col("chunk_key").cast("int").alias("chunk_index"), "actual_hash", "expected_hash", "result").collect()))
    assert set(told) <= set(expected)
    received.filter("chunk_index = 0").write.parquet(path)
    first = run()
    assert 0 < len(first) < len(expected)
    received.filter("chunk_index <> 0").write.mode("append").parquet(path)
    assert run() == expected
    assert run() == expected


def test_repeats_are_reported_once_but_other_content_is_not_hidden(spark, landing):
    _, _, path, run = landing
    intact = list(CASES).index("intact")
    once = spark.createDataFrame([(intact, 0, bytearray(b"one"))], RECEIVED_CHUNKS)
    once.union(once).union(once).write.parquet(path)
    assert len(run()) == 1
    once.write.mode("append").parquet(path)
    assert len(run()) == 1
    spark.createDataFrame([(intact, 0, bytearray(b"ONE"))], RECEIVED_CHUNKS).write.mode("append").parquet(path)
    rows = run()
    assert len(rows) == 2 and sum("HASH_MISMATCH" in r for r in rows) == 1


def test_files_with_an_old_time_are_verified(spark, landing):
    """A copied file keeps its old time; it is read and reported like any other."""
    _, _, path, run = landing
    intact = list(CASES).index("intact")
    now, known = time.time(), set()
    for age, index, content in ((0, 0, b"one"), (3 * 3_600, 1, b"TWO"), (400 * 86_400, 2, b"THREE")):
        chunk = spark.createDataFrame([(intact, index, bytearray(content))], RECEIVED_CHUNKS)
        chunk.coalesce(1).write.mode("append").parquet(path)
        for file in set(glob.glob(f"{path}/part-*")) - known:
            os.utime(file, (now - age, now - age))
            known.add(file)
        rows = run()
    assert len(rows) == 3 and sum("HASH_MISMATCH" in r for r in rows) == 2


def test_a_batch_reads_the_entries_of_its_images_only(spark, tmp_path):
    entries = spark.range(4_000).select(
        F.col("id").alias("firmware_id"), F.lit("0").alias("chunk_key"), F.lit(0).alias("chunk_index"),
        F.sha2(F.col("id").cast("string"), 256).alias("expected_hash"))
    path = str(tmp_path / "stored")
    chunk_verify.save_entries(entries, path, 100)
    batch = spark.range(205, 215).select(F.col("id").alias("firmware_id"))
    read = chunk_verify.entries_of(batch, path, 100)
    assert sorted(r["firmware_id"] for r in read.collect()) == list(range(205, 215))
    files = read.select(F.input_file_name()).distinct().count()
    assert files <= 2 < len(glob.glob(f"{path}/folder=*/part-*"))
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "folder" in re.search(r"PartitionFilters: \[(.*?)\]", scan)[1]
    assert chunk_verify.entries_of(batch.filter("firmware_id < 0"), path, 100).collect() == []
    assert "firmware_id" in re.search(r"PushedFilters: \[(.*?)\]", scan)[1]


def test_a_batch_over_thousands_of_folders_reads_those_only(spark, tmp_path):
    """5,000 folders of two images each, of 6,000; the others are not opened."""
    entries = spark.range(0, 12_000, 1, 4).select(
        F.col("id").alias("firmware_id"), F.lit(0).alias("chunk_index"), F.lit("h").alias("expected_hash"), (F.col("id") / 2).cast("long").alias("folder"))
    path = str(tmp_path / "stored")
    entries.write.partitionBy("folder").parquet(path)
    batch = spark.range(2_000, 12_000).select(F.col("id").alias("firmware_id"))
    read = chunk_verify.entries_of(batch, path, 2)
    assert read.count() == 10_000
    assert read.select(F.input_file_name()).distinct().count() == 5_000
    scan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and "folder" in re.search(r"PartitionFilters: \[(.*?)\]", scan, re.S)[1]


# ---- verdicts per image -----------------------------------------------------

def batch_verdicts(records, received):
    rows = firmware.firmware_verdicts(records, received).collect()
    return {r["firmware_id"]: (r["verdict"], r["error_count"], r["delivered"]) for r in rows}


@pytest.fixture()
def images(spark, tmp_path):
    records, received = tables(spark)
    paths = {name: str(tmp_path / name) for name in ("entries", "heads", "landing", "verified", "log", "verdicts", "state")}
    chunk_verify.save_entries(firmware.manifest_entries(records), paths["entries"], IMAGES)
    chunk_verify.save_heads(firmware.manifest_heads(records), paths["heads"], IMAGES)

    def run(at=None):
        if at:
            image_verify.tick(spark, paths["verified"], at)
        else:
            hashes = firmware.delivered_hashes(chunk_verify.chunk_stream(spark, paths["landing"], RECEIVED_CHUNKS), "arrived_at")
            chunk_verify.verify_available(hashes, paths["entries"], paths["verified"], paths["log"], IMAGES, paths["heads"])
        image_verify.decide_available(spark, paths["verified"], paths["verdicts"], paths["state"])
        rows = image_verify.read_verdicts(spark, paths["verdicts"]).collect()
        assert len({r["firmware_id"] for r in rows}) == len(rows)
        return {r["firmware_id"]: (r["verdict"], r["error_count"], r["delivered"]) for r in rows}

    return records, received, paths["landing"], run


def test_verdicts_over_two_arrivals_equal_the_batch(images):
    """Given once, with the last chunk or when time is up; chunks of one image arrive apart."""
    records, received, path, run = images
    whole = batch_verdicts(records, received)
    sent = {r["firmware_id"] for r in received.select("firmware_id").distinct().collect()}
    first = received.filter("chunk_index <= 0")
    first.write.parquet(path)
    early = run()
    certain = {"SIGNATURE_FAILED", "STRUCTURE_ERROR"}
    assert early and all(verdict in certain or verdict == whole[n][0] for n, (verdict, _, _) in early.items())
    received.filter("chunk_index > 0 OR chunk_index IS NULL").write.mode("append").parquet(path)
    later = run()
    assert early.items() <= later.items()
    final = run("2100-01-01 00:00:00")
    assert later.items() <= final.items()
    assert set(final) == sent
    # What is certain at once is told of the chunks that had come.
    assert {n: v[:2] for n, v in final.items()} == {n: whole[n][:2] for n in sent}
    names = list(CASES)
    assert names.index("two of three") in final and names.index("two of three") not in later
    assert run("2100-01-02 00:00:00") == final


def test_an_image_without_a_manifest_has_no_verdict(spark, images):
    _, _, path, run = images
    intact = list(CASES).index("intact")
    rows = [(9999, 0, bytearray(b"x")), *[(intact, i, bytearray(c)) for i, c in enumerate([b"one", b"two", b"three"])]]
    spark.createDataFrame(rows, RECEIVED_CHUNKS).write.parquet(path)
    assert run() == {intact: ("OK", 0, 3)}
    # What comes after the verdict changes nothing.
    spark.createDataFrame([(intact, 0, bytearray(b"late"))], RECEIVED_CHUNKS).write.mode("append").parquet(path)
    assert run() == {intact: ("OK", 0, 3)}


@hypothesis_settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 2, 9, -1]), st.sampled_from(["OK", "HASH_MISMATCH", "NOT_HASHABLE"])), max_size=7),
       st.integers(0, 3), st.integers(0, 7))
def test_progress_counts_like_the_batch(arrivals, total, cut):
    """In two parts, through the stored state."""
    listed = {0, 1, 9}
    rows = [(i, r if i in listed - {9} else "ENTRY_WITHOUT_HASH" if i == 9 else "MISSING_IN_MANIFEST") for i, r in arrivals]
    progress = image_verify.Progress("v", total, None, True, None)
    for part in (rows[:cut], rows[cut:]):
        progress = image_verify.Progress(*progress.packed()[1:])
        progress.add(np.array([i for i, _ in part], np.int64), np.array([r for _, r in part], object))
    times = Counter(i for i, _ in rows)
    bad = sum(1 for i in times if i != 9 and (i not in listed or times[i] > 1 or dict(rows)[i] != "OK"))
    if len(rows) != total:
        expected = ("COUNT_MISMATCH", 1)
    elif 9 in times:
        expected = ("MALFORMED_MANIFEST", 1)
    else:
        expected = ("CHUNK_ERROR", bad) if bad else ("OK", 0)
    assert progress.verdict() == expected
    assert progress.certain == (len(rows) >= total)


class CountedHandle:
    """The state of one image, with the names of the calls made."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], []

    def getValueState(self, *_):
        return self

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def listTimers(self):
        self.calls.append("listTimers")
        return iter(list(self.timers))

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


def test_an_image_that_is_complete_at_once_asks_little_of_the_store():
    handle = CountedHandle()
    images = image_verify._Images(1_000)
    images.init(handle)

    def chunk(index, at, result="OK"):
        return Row(firmware_id=7, chunk_index=index, arrived_ms=at, result=result, firmware_version="v", total_chunks=3,
                   bad_key=None, in_sequence=True, early=None)

    told = list(images.handleInputRows((7,), iter([chunk(n, 5) for n in range(3)]), None))
    assert [tuple(r) for r in told] == [(7, "v", "OK", 0, 3)] and handle.calls == ["get", "update"]
    assert list(images.handleInputRows((7,), iter([chunk(0, 9)]), None)) == []
    handle.value = None
    assert list(images.handleInputRows((7,), iter([chunk(0, 5), chunk(None, 6, None)]), None)) == [] and handle.timers == [1_006]
    assert [tuple(r) for r in images.handleInputRows((7,), iter([chunk(1, 8)]), None)] == [(7, "v", "CHUNK_ERROR", 1, 3)]
    assert handle.timers == []


def test_small_heads_of_many_folders_are_written_by_many_tasks(spark, tmp_path):
    heads = spark.range(400).select(
        F.col("id").alias("firmware_id"), F.lit("v").alias("firmware_version"), F.lit(1).alias("total_chunks"),
        F.lit(None).cast("string").alias("bad_key"), F.lit(True).alias("in_sequence"), F.lit(None).cast("string").alias("early"))
    chunk_verify.save_heads(heads, str(tmp_path / "heads"), 10)
    parts = {f.name.split("-")[1] for f in (tmp_path / "heads").rglob("part-*.parquet")}
    assert len(parts) >= min(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
