"""The registered corpus queries: names, columns, SQL, and the whole table in every result."""

import re

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import __spark_entry__ as entry_points
from fleetwright.llm.common import sorted_runs
from fleetwright.llm.queries import ORACLE, QUERIES
from tests.oracle import assert_same, connect

COLUMNS = {
    1: ["doc_id", "held_out", "lang_pred", "score"],
    2: ["doc_id", "size", "source_size", "target", "taken"],
    3: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    4: ["doc_id", "held_out", "score", "predicted"],
    5: ["doc_id", "start", "n_tokens", "ids_crc32"],
    6: ["query_id", "rank", "vec_id", "score"],
    7: ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    8: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    9: ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    10: ["doc_id", "fingerprint", "component_id"],
    11: ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    12: ["item_id", "rank", "doc_id", "score"],
    13: ["doc_id", "held_out", "score", "predicted"],
}
KINDS = {
    "held_out": "boolean", "score": "double", "lang_pred": "string", "predicted": "int", "rank": "int", "piece": "int",
    "target": "double", "base_score": "double", "kept": "boolean", "base_failed": "boolean", "fingerprint": "string",
    "base_sha256": "string", "spans": "string", "groups_sha256": "string",
}


def test_one_query_per_operator():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES] == sorted(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_and_rows(spark, testdata, name):
    folder = str(testdata / "sf0.001")
    df = QUERIES[name](spark, folder)
    wanted = COLUMNS[int(re.match(r"op(\d+)_", name)[1])]
    assert df.columns[:len(wanted)] == wanted
    kinds = {**KINDS, "score": "bigint"} if name == "op12_lexical" else KINDS
    assert {c: t for c, t in df.dtypes if c in wanted} == {c: kinds.get(c, "bigint") for c in wanted}
    if wanted[0] == "doc_id":
        everyone = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").distinct().count()
        assert df.select("doc_id").distinct().count() == everyone


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, testdata, name):
    con = connect(testdata / "sf0.01")
    assert assert_same(QUERIES[name](spark, str(testdata / "sf0.01")), con, ORACLE[name]) > 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=40), st.lists(st.integers(1, 7), min_size=1, max_size=8))
def test_sorted_runs_are_whole(keys, sizes):
    keys.sort()
    batches, place = [], 0
    for k in range(len(keys) + 1):
        size = sizes[k % len(sizes)]
        batches.append(pa.RecordBatch.from_arrays([pa.array(keys[place:place + size], pa.int64())], ["k"]))
        place += size
    seen = []
    for table, starts in sorted_runs(iter(batches), "k"):
        values = table.column("k").to_pylist()
        ends = [*starts[1:].tolist(), len(values)]
        for a, b in zip(starts.tolist(), ends):
            assert len(set(values[a:b])) == 1
            seen.append((values[a], b - a))
    assert seen == [(k, keys.count(k)) for k in sorted(set(keys))]
