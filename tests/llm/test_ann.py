"""Nearest neighbours: recall against brute force, ties, copies, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetwright.llm import ann
from fleetwright.llm.queries import QUERIES


def exact(ids, vectors, queries, k):
    rows = np.array(vectors, dtype=np.float64)
    result = {}
    for q in queries:
        far = np.sqrt(((rows - rows[ids.index(q)]) ** 2).sum(axis=1))
        ranked = sorted((d, i) for d, i in zip(far.tolist(), ids) if i != q)
        result[q] = ranked[:k]
    return result


def found_by_query(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return found


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_query_recall(spark, testdata, scale):
    folder = str(testdata / scale)
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in table], [r.embedding for r in table]
    queries = [i for i in ids if i % 100 == 0]
    want = exact(ids, vectors, queries, 10)
    rows = QUERIES["op6_ann"](spark, folder).collect()
    found = found_by_query(rows)
    assert set(found) == set(want) and all(len(f) == 10 for f in found.values())
    assert {r["rank"] for r in rows} == set(range(1, 11))
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in queries)
    assert hits >= 0.9 * 10 * len(queries)
    place = {i: np.array(v, dtype=np.float64) for i, v in zip(ids, vectors)}
    for q, near in found.items():
        assert near == sorted(near) and q not in [i for _, i in near]
        assert all(d == pytest.approx(np.linalg.norm(place[q] - place[i]), abs=1e-12) for d, i in near)


def _frame(spark, ids, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in zip(ids, vectors)],
                                 "vec_id long, embedding array<float>, score int")


def test_copies_and_ties(spark):
    """A third of the rows is one vector; grid vectors give ties."""
    rng = np.random.default_rng(0)
    vectors = [[1, 2, 3]] * 300 + rng.integers(1, 4, (600, 3)).tolist()
    ids = list(range(900))
    found = found_by_query(ann.search(_frame(spark, ids, vectors), F.col("vec_id") % 50 == 0).collect())
    want = exact(ids, vectors, [i for i in ids if i % 50 == 0], 10)
    assert found == want


def test_runs_are_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "RUN_ROWS", 8)
    monkeypatch.setattr(ann, "HELD_QUERIES", 3)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(500, 4)).astype(np.float32).tolist()
    ids = list(range(500))
    found = found_by_query(ann.search(_frame(spark, ids, vectors), F.col("vec_id") % 10 == 0, k=3, leaf_points=64).collect())
    want = exact(ids, vectors, [i for i in ids if i % 10 == 0], 3)
    hits = sum(len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 3 * len(want)


def test_queue_takes_leaves_by_their_smallest_margin():
    rng = np.random.default_rng(2)
    forest = ann.grow(rng.normal(size=(800, 6)), trees=3, leaf_points=20)
    vector = rng.normal(size=6)
    bounds = {}

    def walk(node, bound):
        if node < 0:
            bounds[~node] = bound
            return
        margin = float(forest.normals[node] @ vector - forest.offsets[node])
        walk(int(forest.children[node, 0]), max(bound, margin))
        walk(int(forest.children[node, 1]), max(bound, -margin))

    for root in forest.roots:
        walk(root, -np.inf)
    order = forest.search(vector, forest.leaves)
    assert sorted(order) == list(range(forest.leaves))
    assert all(bounds[a] <= bounds[b] for a, b in zip(order, order[1:]))
    own = {int(forest.leaf_of(vector[None], t)[0]) for t in range(3)}
    assert own == {leaf for leaf, bound in bounds.items() if bound < 0}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (None, [1.0, 0.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]),
            (100, [2.0, 0.0]), (200, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = found_by_query(ann.search(frame, F.col("vec_id") % 100 == 0).collect())
    near = float(np.float64(np.float32(0.1)))
    assert found == {0: [(0.0, 9), (near, 1), (1.0, 100)],
                     100: [(1.0, 0), (1.0, 9), (pytest.approx(np.hypot(1, near)), 1)]}
    assert ann.search(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert ann.search(frame, F.col("vec_id") == 12345).collect() == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert ann.search(one, F.col("vec_id") == 0).collect() == []
