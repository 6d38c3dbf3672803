"""Language identification: held-out accuracy, codes, margins against plain sums, odd rows."""

import zlib

import numpy as np
import pytest

from fleetwright.llm import language
from fleetwright.llm.queries import QUERIES


def test_query_is_right_on_held_out_documents(spark, testdata):
    folder = str(testdata / "sf0.1")
    rows = {r.doc_id: r for r in QUERIES["op1_language"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    unseen = [d for d in docs if rows[d.doc_id].held_out]
    assert {d.doc_id for d in unseen} == {d.doc_id for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2}
    right = np.array([rows[d.doc_id].lang_pred == d.lang for d in unseen])
    assert right.mean() > 0.99
    assert all(0 <= r.score <= 1 for r in rows.values())
    sure = np.array([not rows[d.doc_id].ambiguous for d in unseen])
    assert right[sure].mean() >= right.mean() and sure.mean() > 0.95


@pytest.mark.parametrize("languages", [2, 3, 4, 5, 8, 30])
def test_codewords_stand_apart(languages):
    code = language.codewords(languages)
    assert code.shape[0] == languages and set(np.unique(code)) == {-1, 1}
    assert (np.abs(code.sum(axis=0)) < languages).all()
    apart = (code.shape[1] - code @ code.T) / 2
    assert apart[np.triu_indices(languages, 1)].min() >= max(1, code.shape[1] // 5)
    assert (language.codewords(languages) == code).all()


def plain_margin(text, weights):
    total, n_grams = 0, 0
    for n in range(1, language.LONGEST_GRAM + 1):
        for i in range(len(text) - n + 1):
            packed = int.from_bytes(text[i:i + n], "little")
            total = total + weights[packed * language._PRIMES[n - 1] % 2 ** 32 >> 32 - language.CELL_BITS].astype(float)
            n_grams += 1
    return total / max(n_grams, 1)


def test_margins_are_plain_sums(monkeypatch):
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(1 << language.CELL_BITS, 3)).astype(np.float32)
    texts = [bytes(rng.integers(97, 123, n, dtype=np.uint8)) for n in (2, 3, 2, 40, 1, 1, 7, 300, 5, 2)]
    for at_once in (1 << 19, 400):
        monkeypatch.setattr(language, "_AT_ONCE", at_once)
        found = language.margins(texts, weights)
        assert found == pytest.approx(np.array([plain_margin(t, weights) for t in texts]), abs=1e-5)


def test_one_wrong_bit_is_corrected():
    code = language.codewords(4)
    width = code.shape[1]
    model = language.Model(list("abcd"), code, None, np.ones(width), np.zeros(width), np.full(width, 2 / width))
    for row in range(4):
        for bit in range(width):
            margin = 3 * code[row].copy()
            margin[bit] = -margin[bit]
            assert model.losses(margin[None])[0].argmin() == row


def test_odd_rows(spark):
    train = [(i, "the cat and the hat " * 5, "en") if i % 2 else (i, "der Hund und die Katze " * 5, "de") for i in range(200)]
    model = language.learn(spark.createDataFrame(train + [(500, "x", None), (501, None, "fr"), (None, "y", "en")],
                                                 "doc_id long, text string, lang string"))
    assert model.languages == ["de", "en"]
    rows = [(1, None, 0), (2, "", 0), (3, "123 --- !", 0), (4, "the hat and the cat", 0), (4, "the hat and the cat", 0),
            (None, "die Katze und der Hund", 0), (6, "und die " * 100_000, None), (7, "é", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    found = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[1].score == 0
    assert (found[4].lang_pred, found[None].lang_pred, found[6].lang_pred) == ("en", "de", "de")
    assert found[7].lang_pred in ("de", "en")
    assert language.predict(docs.limit(0), model).collect() == []


def test_nothing_or_one_language_learnt(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, "1", None)], "doc_id long, text string, lang string")
    model = language.learn(docs)
    assert {r.lang_pred for r in language.predict(docs, model).collect()} == {"und"}
    one = language.learn(spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string"))
    assert {r.doc_id: r.lang_pred for r in language.predict(docs, one).collect()} == {1: "en", 2: "und"}
