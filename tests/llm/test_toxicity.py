"""Toxicity: exact neighbours against all cosines, held-out quality, odd rows."""

import zlib

import numpy as np
import pytest

from fleetwright.llm import toxicity
from fleetwright.llm.queries import QUERIES


def _vectors(rng, rows, terms):
    vectors = []
    for _ in range(rows):
        some = rng.choice(terms, rng.integers(0, 6), replace=False)
        weights = rng.integers(1, 4, len(some)).astype(float)
        norm = np.sqrt((weights ** 2).sum()) or 1.0
        vectors.append({int(t): float(w / norm) for t, w in zip(some, weights)})
    return vectors


@pytest.mark.parametrize("block,rows", [(4, 200), (64, 500), (64, 3)])
def test_nearest_are_those_of_all_cosines(block, rows):
    rng = np.random.default_rng(block + rows)
    vectors = _vectors(rng, rows, 30)
    index = toxicity.BlockMaxIndex(vectors, 30, block)
    dense = np.zeros((rows, 30))
    for i, v in enumerate(vectors):
        for t, w in v.items():
            dense[i, t] = w
    for query in _vectors(rng, 60, 30):
        q = np.zeros(30)
        for t, w in query.items():
            q[t] = w
        cosines = dense @ q
        want = np.sort(cosines[cosines > 0])[::-1][:10]
        found = index.nearest(query, 10)
        assert [c for c, _ in found] == pytest.approx(want.tolist())
        assert all(abs(cosines[e] - c) < 1e-12 for c, e in found)
        for (c, e), (c2, e2) in zip(found, found[1:]):
            assert c > c2 or e < e2


def test_blocks_out_of_reach_are_skipped(monkeypatch):
    vectors = [{0: 1.0}] * 20 + [{0: 0.1, 1: 0.9949874371066199}] * 2_000
    index = toxicity.BlockMaxIndex(vectors, 2, 10)
    looked = []
    index.starts[0] = _Watched(index.starts[0], looked)
    assert [e for _, e in index.nearest({0: 1.0}, 10)] == list(range(10))
    assert len(set(looked)) <= 4


class _Watched:
    def __init__(self, values, looked):
        self.values, self.looked = values, looked

    def __getitem__(self, block):
        self.looked.append(block)
        return self.values[block]


def test_rising_curve():
    x, y = toxicity.rising(np.array([.1, .2, .3, .4, .5, .6]), np.array([0, 1, 0, 0, 1, 1.]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all()


def test_query_separates_held_out_documents(spark, testdata):
    folder = str(testdata / "sf0.1")
    rows = {r.doc_id: r for r in QUERIES["op4_toxicity"](spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for key, r in rows.items():
        assert r.held_out == (zlib.crc32(str(key).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    unseen = [i for i in labels if rows[i].held_out]
    truth = np.array([labels[i] for i in unseen])
    score = np.array([rows[i].score for i in unseen])
    better = (score[truth == 1][:, None] > score[truth == 0]).mean()
    same = (score[truth == 1][:, None] == score[truth == 0]).mean()
    assert better + same / 2 > 0.98
    guess = score >= 0.5
    assert (guess & (truth == 0)).sum() <= 0.02 * (truth == 0).sum()
    assert (guess & (truth == 1)).sum() >= 0.8 * (truth == 1).sum()
    # Calibrated: the mean score is near the rate.
    assert abs(score.mean() - truth.mean()) < 0.03


def test_odd_rows(spark):
    texts = [(i, "awful nasty words here" if i % 3 == 0 else "kind words here", 9) for i in range(300)]
    docs = spark.createDataFrame(
        texts + [(1000, None, 1), (1001, "", None), (None, "awful", 1), (1002, "awful " * 30_000, 1), (3, "awful nasty words here", 1)],
        "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(250)] + [(5, None), (3, 0), (None, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    found = {r.doc_id: r for r in toxicity.scores(docs, model).collect()}
    assert found[3].score > 0.5 and found[1002].score > 0.5 and found[None].score > 0.5
    assert found[1000].score == found[1001].score < 0.1
    assert found[4].score < 0.1 and 3 in found[0].nearest
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(300) if i % 3} | {1000, 1001}


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert [r.score for r in toxicity.scores(docs, model).collect()] == [0.0]
    assert toxicity.scores(docs.limit(0), model).collect() == []
    assert toxicity.without_toxic(docs.limit(0), model).collect() == []


def test_every_word_counts(spark):
    # Each toxic text has words of its own and of one other; none is in as many rows as chance asks for.
    pairs = [(i, f"vile{i // 2} mean{i // 2} day", int(i % 20 < 2)) for i in range(400)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string, toxic int")
    model = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert {b"vile0", b"mean1", b"day"} <= set(model.terms) and len(model.ids) == 400
    unseen = spark.createDataFrame([(1000, "so vile0 mean0"), (1001, "so vile1 mean1"), (1002, "so day")], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.scores(unseen, model).collect()}
    assert set(found[1000].nearest[:2]) == {0, 1} and set(found[1001].nearest[:2]) == {2, 3}
    assert found[1000].score > 0.5 > found[1001].score and len(found[1002].nearest) == toxicity.NEIGHBOURS


def test_index_is_built_in_little_more_memory_than_it_takes():
    import tracemalloc

    rng = np.random.default_rng(1)
    rows = [(i, i % 2 == 0, np.sort(rng.choice(20_000, 300, replace=False)).astype(np.int32), np.ones(300, np.int32))
            for i in range(2_000)]
    model = toxicity._model(toxicity.joined([b"%d" % i for i in range(20_000)]), np.ones(20_000), rows)
    tracemalloc.start()
    index = model.index
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    plain = toxicity.BlockMaxIndex([toxicity.unit(*rows[i][2:], model.idf) for i in model.ids], 20_000)
    assert all((getattr(index, k) == getattr(plain, k)).all() for k in ("sizes", "terms", "values", "examples", "weights"))
    assert peak < 2.2 * now


def test_model_comes_back_whole():
    import pickle

    idf = np.array([1.0, 2.0, 1.5])
    rows = [(7, True, [0, 2], [1, 300]), (8, False, [1], [70_000]), (9, False, [], [])]
    model = toxicity._model(toxicity.joined([b"a", b"b", b"c"]), idf, [(*r[:2], *(np.array(x, np.int32) for x in r[2:])) for r in rows])
    back = pickle.loads(pickle.dumps(model))
    assert back.terms == model.terms == {b"a": 0, b"b": 1, b"c": 2} and back.ids == model.ids
    assert (back.index.terms == model.index.terms).all() and (back.index.values == model.index.values).all()
