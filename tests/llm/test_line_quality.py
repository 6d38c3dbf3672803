"""Line quality: the chain against all labellings, features against plain counts, held-out documents."""

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from fleetwright.llm import line_quality as lq
from fleetwright.llm.common import sized
from fleetwright.llm.queries import QUERIES


def _all_labellings(score, transitions):
    """Partition, marginals of good and pair sums by enumeration."""
    total, good, pairs = 0.0, np.zeros(len(score)), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=len(score)):
        weight = np.exp(sum(s for s, y in zip(score, labels) if y) + sum(transitions[a, b] for a, b in zip(labels, labels[1:])))
        total += weight
        good += weight * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += weight
    return np.log(total), good / total, pairs / total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 7), min_size=1, max_size=5), st.integers(0, 10**6))
def test_chains_against_all_labellings(sizes, seed):
    rng = np.random.default_rng(seed)
    document = np.repeat(np.arange(len(sizes)), sizes)
    score, transitions = rng.normal(0, 3, len(document)), rng.normal(0, 2, (2, 2))
    chains = lq.forward_backward(document, score, transitions, len(sizes))
    for d, n in enumerate(sizes):
        if n:
            partition, good, pairs = _all_labellings(score[document == d], transitions)
            assert chains.log_partition[d] == pytest.approx(partition)
            assert chains.good[document == d] == pytest.approx(good)
            assert chains.pairs[d] == pytest.approx(pairs)


def test_strong_scores_stay_finite():
    chains = lq.forward_backward(np.zeros(5000, int), np.tile([800.0, -800.0], 2500), np.array([[0, -50], [-50, 0.0]]), 1)
    assert np.isfinite(chains.good).all() and np.isfinite(chains.log_partition).all()


def test_gradient_is_the_slope():
    lines = lq.lines_of([b"One two.\nTHREE!! four!!\nfive", b"six | seven | eight", b"", b"a b\na b\n\nc d"])
    good = np.array([1, 0, 1, 0])
    rng = np.random.default_rng(3)
    at = rng.normal(0, 0.3, lq.WIDTH + 4)
    value, slope = lq.loss_and_gradient(good, lines, at)
    for i in [*rng.choice(lq.WIDTH, 30, replace=False), *range(lq.WIDTH, lq.WIDTH + 4)]:
        step = np.zeros_like(at)
        step[i] = 1e-5
        rise = lq.loss_and_gradient(good, lines, at + step)[0] - lq.loss_and_gradient(good, lines, at - step)[0]
        assert rise / 2e-5 == pytest.approx(slope[i], abs=1e-6)


def _plain_lines(text):
    """(number, black bytes, words, repeated words, triples met before, met line before) of each line with a word."""
    rows, words_so_far, triples, lines = [], [], set(), set()
    for number, line in enumerate(text.split(b"\n")):
        words, again, repeated = line.split(), 0, 0
        if not words:
            continue
        for word in words:
            again += bool(words_so_far) and words_so_far[-1] == word
            words_so_far.append(word)
            triple = tuple(words_so_far[-3:])
            if len(triple) == 3:
                repeated += triple in triples
                triples.add(triple)
        rows.append((number, len(re.sub(rb"[ \t\n\x0b\x0c\r]", b"", line)), len(words), again, repeated, line in lines))
        lines.add(line)
    return rows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t!é|A", max_size=40), max_size=5))
def test_lines_against_plain_counts(texts):
    texts = [t.encode() for t in texts]
    lines = lq.lines_of(texts)
    plain = [(d, *row) for d, text in enumerate(texts) for row in _plain_lines(text)]
    assert list(zip(lines.document.tolist(), lines.number.tolist(), lines.weight.tolist())) == [row[:3] for row in plain]
    value = dict(zip(lq.NAMES, lines.values.T))
    for i, (_, _, black, words, again, repeated, same) in enumerate(plain):
        assert value["words"][i] == pytest.approx(np.log1p(words) / 6)
        assert value["again"][i] * words == pytest.approx(again, abs=1e-3)
        assert value["repeated"][i] * words == pytest.approx(repeated, abs=1e-3)
        assert bool(value["same_line"][i]) == same
    x = lq.features(lines)
    assert x.shape == (len(plain), lq.WIDTH) and np.isfinite(x).all()
    n = len(lq.NAMES)
    for i in range(1, len(plain)):
        before = x[i, -2 * n:-n]
        assert (before == (lines.values[i - 1] if plain[i][0] == plain[i - 1][0] else 0)).all()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 30).map(lambda n: "x" * n)), max_size=30), st.integers(1, 40), st.integers(1, 5))
def test_parts_keep_all_rows_and_bounds(texts, most_bytes, most_rows):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    parts = list(sized(iter([batch, batch.slice(0, 0)]), "t", most_bytes, most_rows))
    assert [t for p in parts for t in p.column("t").to_pylist()] == texts
    for p in parts:
        assert 1 <= p.num_rows <= most_rows
        assert p.num_rows == 1 or sum(len(t or "") for t in p.column("t").to_pylist()) <= most_bytes


def test_minimum_of_a_bowl():
    scale = np.array([1.0, 10.0, 100.0])
    found = lq.minimise(lambda p: (float(scale @ (p - 1) ** 2), 2 * scale * (p - 1)), np.zeros(3), 200)
    assert found == pytest.approx(np.ones(3), abs=1e-2)


def test_query_tells_held_out_documents_apart(spark, testdata):
    folder = str(testdata / "sf0.1")
    rows = {r.doc_id: r for r in QUERIES["op13_line_quality"](spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for key, r in rows.items():
        assert r.held_out == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [i for i in labels if rows[i].held_out]
    truth, score = (np.array(v) for v in zip(*((labels[i], rows[i].score) for i in unseen)))
    better = (score[truth == 1][:, None] > score[truth == 0]).mean() + (score[truth == 1][:, None] == score[truth == 0]).mean() / 2
    print("order", better, "bad found", (score[truth == 0] < 0.3).mean(), "good kept", (score[truth == 1] >= 0.3).mean())
    assert better > 0.97
    assert (score[truth == 1] >= 0.3).mean() > 0.98 and (score[truth == 0] < 0.3).mean() > 0.9
    assert abs(score.mean() - truth.mean()) < 0.03


def _toy(spark, extra=()):
    rows = [(i, "Some kind words here.\nAnd more of them." if i % 3 else "BUY!! NOW!!\nBUY!! NOW!! | $$$", 9) for i in range(200)]
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, score int")


def test_odd_rows(spark):
    extra = [(1000, None, 1), (1001, "", None), (1002, " \n\t\n", 1), (None, "BUY!! NOW!!", 1), (3, "BUY!! NOW!!\nBUY!! NOW!! | $$$", 1),
             (1003, "Some kind words here.\n" * 20_000, 1), (1004, "word " * 50_000, 1)]
    docs = _toy(spark, extra)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(200)] + [(5, None), (4, 1), (None, 0), (1000, 0), (1001, 1)],
                                   "doc_id long, quality int")
    model = lq.learn(docs, labels)
    found = [(r.doc_id, r.score) for r in lq.scores(docs, model).collect()]
    assert len(found) == docs.count()
    score = dict(found)
    assert score[1000] == score[1001] == score[1002] == 0.5
    assert score[4] > 0.9 and score[3] < 0.3 and score[None] < 0.5
    assert [s for d, s in found if d == 3][0] == [s for d, s in found if d == 3][1]
    lines = lq.line_labels(docs, model).filter("doc_id = 4 OR doc_id = 3").collect()
    assert {(r.doc_id, r.line, r.good) for r in lines} == {(4, 0, True), (4, 1, True), (3, 0, False), (3, 1, False)}


def test_without_labels_or_documents(spark):
    docs = _toy(spark)
    for rows, constant in (([], 0.5), ([(1, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)):
        model = lq.learn(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        assert {r.score for r in lq.scores(docs, model).collect()} == {constant}
        assert lq.scores(docs.limit(0), model).collect() == [] and lq.line_labels(docs.limit(0), model).collect() == []
