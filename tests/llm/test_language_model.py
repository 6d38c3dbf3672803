"""Language model scores: base against plain counting, normalisation, gain, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwright.llm import language_model as lm
from fleetwright.llm.queries import QUERIES


def plain_tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


def test_query_against_plain_counts(spark, testdata):
    folder = str(testdata / "sf0.01")
    rows = {r.doc_id: r for r in QUERIES["op7_language_model"](spark, folder).collect()}
    docs = {r.doc_id: plain_tokens(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert set(rows) == set(docs)
    counts = Counter()
    for key, tokens in docs.items():
        assert rows[key].held_out == (zlib.crc32(str(key).encode()) % 7 == 2)
        if not rows[key].held_out:
            counts.update(tokens)
    total, types = sum(counts.values()), len(counts)
    for key, tokens in docs.items():
        r = rows[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), total)
        base = sum(math.log10((counts[t] + 1) / (total + types + 1)) for t in tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in rows.values() if r.held_out]
    model, base = sum(r.score for r in held), sum(r.base_score for r in held)
    assert model > base


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(0)
    # "a" is followed by "b", "b" by "c", and rare words by "a".
    texts = []
    for i in range(1500):
        words = ["a"]
        while len(words) < 60:
            words.append({"a": "b", "b": "c"}.get(words[-1]) or (f"rare{rng.integers(500)}x" if rng.random() < .5 else "a"))
        texts.append((i, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2, "doc_id")
    chunked = lm.chunks(docs.withColumn("training", F.col("doc_id") % 5 != 0))
    counted = lm.counted_words(chunked)
    counts = lm.word_figures(counted, chunked)
    return chunked, counted, counts, *lm.train(chunked, counts)


def test_probabilities_add_up_to_one(trained):
    _, counted, counts, model, _ = trained
    likely = np.exp(model.log_probabilities().astype(float))
    assert likely.sum(axis=1) == pytest.approx(np.ones(len(likely)), abs=1e-4)
    assert (likely[:, lm.BEGIN] == 0).all()
    words = {bytes(r["word"]): r["total"] for r in counted.collect() if r["word"] is not None and r["total"]}
    classes = counts.classes(list(words))
    within = 10 ** counts.within_class(classes, np.array(list(words.values())))
    for number in range(lm.FREQUENT, lm.END):
        some = classes == number
        if some.any():
            tokens, types = counts.shared[number - lm.FREQUENT]
            assert within[some].sum() + 1 / (tokens + types + 1) == pytest.approx(1)
    assert (within[classes < lm.FREQUENT] == 1).all()


def test_model_learns_what_follows(trained):
    chunked, counted, counts, model, classes = trained
    scores = lm.scores(chunked, lm.totals_by_chunk(counted), classes, counts, model).collect()
    held = [r for r in scores if not r.training]
    assert len(held) == 300
    # Most words are certain from the one before.
    assert np.mean([r.score / r.n_tokens for r in held]) > np.mean([r.base_score / r.n_tokens for r in held]) + 0.15


def test_gradient_steps_follow_the_loss():
    """A step's gradient is that of the noise-contrastive loss."""
    rng = np.random.default_rng(1)
    noise = np.full(lm.CLASSES, 1 / lm.CLASSES)
    model = lm.Bilinear.begin(np.ones(lm.CLASSES))
    first, last, target = (rng.integers(0, lm.CLASSES, 50) for _ in range(3))

    def loss(m, drawn):
        meant = m.context[first] * m.places[0] + m.context[last] * m.places[1]
        expected = np.log(lm.NOISE * noise)
        good = (meant * m.target[target]).sum(1) + m.bias[target] - expected[target]
        bad = meant @ m.target[drawn].T + m.bias[drawn] - expected[drawn]
        return (np.logaddexp(0, -good).sum() + np.logaddexp(0, bad).sum()) / 50

    trainer = lm.Trainer(lm.Bilinear.from_flat(model.flat()), noise, 0)
    drawn = np.random.default_rng([lm._SEED, 0]).choice(lm.CLASSES, lm.NOISE, p=noise)
    trainer.step(first, last, target)
    gradient = np.sqrt(trainer.past.flat() - 1e-6)
    values = model.flat()
    for place in rng.choice(len(values), 60, replace=False):
        up, down = values.copy(), values.copy()
        up[place] += 1e-5
        down[place] -= 1e-5
        slope = (loss(lm.Bilinear.from_flat(up), drawn) - loss(lm.Bilinear.from_flat(down), drawn)) / 2e-5
        assert abs(slope) == pytest.approx(gradient[place], abs=2e-5)


def test_chunks_may_be_cut_anywhere(spark, monkeypatch):
    rows = [(i, f"w{i % 7} x w{i % 3} y z" if i % 4 else None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {r.doc_id: r for r in lm.score_documents(docs, F.col("doc_id") % 3 != 0).collect()}
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 9)
    monkeypatch.setattr(lm, "SCORED_TOKENS", 4)
    found = {r.doc_id: r for r in lm.score_documents(docs, F.col("doc_id") % 3 != 0).collect()}
    for key in want:
        assert (found[key].n_known, found[key].train_tokens) == (want[key].n_known, want[key].train_tokens)
        assert found[key].base_score == pytest.approx(want[key].base_score)


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (None, "A b", 1), (4, "a B", 1), (4, "a B", 1), (5, "q " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = lm.score_documents(docs, F.col("doc_id") != 5).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == 6 and by[1].score == by[2].score and by[1].n_tokens == 1
    assert by[1].train_tokens == 8 and by[None].n_known == 3 and by[5].n_known == 1
    assert by[1].base_score == pytest.approx(math.log10(5 / (8 + 3 + 1)))
    assert by[None].base_score == pytest.approx(math.log10(3 * 3 * 5 / 12 ** 3))
    nothing = lm.score_documents(docs, F.lit(False)).collect()
    assert {r.n_known for r in nothing} == {0} and {r.base_score for r in nothing} == {0.0}
    assert lm.score_documents(docs.limit(0), F.lit(True)).collect() == []
