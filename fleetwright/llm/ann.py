"""Approximate nearest neighbours by a forest of random-projection trees.

1. Equal vectors are one point, which keeps the smallest ids it stands for: more
   than a search returns are never needed, so a vector that fills a third of the
   table costs one point.
2. Trees are grown on a bounded sample of the points: a node's hyperplane lies
   between two random points at the median. All points are then routed to their
   leaf in every tree.
3. A query descends all trees through one priority queue ordered by the smallest
   margin on the way, and takes the leaves that come first.
4. How many leaves that must be is measured: the exact neighbours of some queries,
   found against all points, are looked up in the order of leaves.
5. Queries meet the points of their leaves by shuffle; distances are computed in
   double precision on the original vectors, and the nearest are kept.

Defined cases: rows without id, and vectors that are NULL, zero, hold a NULL or a
number that is not finite, or have another length than most, take no part. Rows
with the same id are one row, with the smallest of their vectors; ties in distance
go to the smaller id. Other columns are not read; an empty table, or one without
queries, gives an empty result.
"""

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwright.llm.common import materialise, sorted_runs

TREES, LEAF_POINTS = 8, 96
# Bound of the sample the trees are grown on, in numbers (62,500 vectors of 64).
SAMPLE_NUMBERS = 4_000_000
# Queries whose exact neighbours are found to set the number of leaves, the recall
# asked of them, and the room left above the number that reaches it.
MEASURED_QUERIES, TARGET_RECALL, ROOM = 160, 0.965, 1.15
# Points or queries of a leaf handled by one task at once.
RUN_ROWS = 8_192
# Queries whose nearest a task keeps before it hands them on.
HELD_QUERIES = 100_000
SEED = 17


# ---- forest -----------------------------------------------------------------

@dataclass
class Forest:
    """All trees in one node table. A child below zero is the leaf ~child."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray
    roots: list[int]
    leaves: int

    def leaf_of(self, vectors: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of each vector in one tree."""
        node = np.full(len(vectors), self.roots[tree])
        while (open_ones := np.flatnonzero(node >= 0)).size:
            at = node[open_ones]
            side = np.einsum("ij,ij->i", vectors[open_ones], self.normals[at]) > self.offsets[at]
            node[open_ones] = self.children[at, side.astype(int)]
        return ~node

    def search(self, vector: np.ndarray, count: int) -> list[int]:
        """The first `count` leaves in the order of the shared queue."""
        margins = (self.normals @ vector - self.offsets).tolist()
        children, found = self.children, []
        queue = [(-np.inf, root) for root in self.roots]
        heapq.heapify(queue)
        while queue and len(found) < count:
            bound, node = heapq.heappop(queue)
            if node < 0:
                found.append(~node)
                continue
            margin = margins[node]
            heapq.heappush(queue, (max(bound, margin), int(children[node, 0])))
            heapq.heappush(queue, (max(bound, -margin), int(children[node, 1])))
        return found


def grow(sample: np.ndarray, trees: int = TREES, leaf_points: int = LEAF_POINTS, seed: int = SEED) -> Forest:
    rng = np.random.default_rng(seed)
    normals, offsets, children, roots, leaves = [], [], [], [], 0

    def split(rows):
        nonlocal leaves
        for _ in range(3 if len(rows) > leaf_points else 0):
            a, b = sample[rng.choice(rows, 2, replace=False)]
            normal = a - b
            length = np.linalg.norm(normal)
            if length == 0 or not np.isfinite(length):
                continue
            along = sample[rows] @ (normal / length)
            middle = float(np.median(along))
            right = along > middle
            if 0 < right.sum() < len(rows):
                node = len(normals)
                normals.append(normal / length)
                offsets.append(middle)
                children.append(None)
                children[node] = (split(rows[~right]), split(rows[right]))
                return node
        leaves += 1
        return -leaves

    for _ in range(trees):
        roots.append(split(np.arange(len(sample))))
    width = sample.shape[1]
    return Forest(np.array(normals).reshape(-1, width), np.array(offsets),
                  np.array(children, dtype=np.int64).reshape(-1, 2), roots, leaves)


# ---- points -----------------------------------------------------------------

def _numbers(column) -> np.ndarray:
    """A list column as a float64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1 if rows else 0)


def _taking_part(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that have an id and a proper vector."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).filter(
        F.exists("embedding", lambda x: x != 0))
    lengths = rows.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").first()
    same = rows.filter(F.size("embedding") == (lengths["length"] if lengths else 0))
    return same.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _points(rows: DataFrame, ids: int) -> DataFrame:
    """(point, embedding, ids): distinct vectors with their `ids` smallest ids, the
    first of which names the point. The limit acts in every task before the shuffle."""
    order = Window.partitionBy("embedding").orderBy("vec_id")
    first = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= ids)
    grouped = first.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return materialise(grouped.withColumn("point", F.col("ids")[0]), "points")


def _sample(points: DataFrame, total: int, width: int) -> np.ndarray:
    share = min(1.0, SAMPLE_NUMBERS / max(width, 1) / max(total, 1))
    drawn = points.filter(F.pmod(F.xxhash64("point", F.lit(SEED)), F.lit(1_000_000)) < int(share * 1_000_000))
    table = drawn.select("embedding").toArrow()
    return _numbers(table.column("embedding")) if table.num_rows else np.zeros((0, width))


# ---- how many leaves --------------------------------------------------------

def _exact(points: DataFrame, queries: list, k: int) -> list:
    """The k nearest other points of some query points, against all points."""
    asked, vectors = [q["point"] for q in queries], np.array([q["embedding"] for q in queries], dtype=np.float64)

    def nearest(batches):
        for batch in batches:
            found = batch.column("point").to_numpy(zero_copy_only=False)
            rows, out = _numbers(batch.column("embedding")), []
            for q, vector in zip(asked, vectors):
                far = ((rows - vector) ** 2).sum(axis=1)
                far[found == q] = np.inf
                best = np.argpartition(far, min(k, len(far)) - 1)[:k]
                out += [(q, float(far[b]), b) for b in best.tolist() if np.isfinite(far[b])]
            places = pa.array([b for _, _, b in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([q for q, _, _ in out], pa.int64()), pa.array([d for _, d, _ in out], pa.float64()),
                 batch.column("embedding").take(places)], ["query", "far", "embedding"])

    kind = points.schema["embedding"].dataType.simpleString()
    some = points.select("point", "embedding").mapInArrow(nearest, f"query bigint, far double, embedding {kind}")
    order = Window.partitionBy("query").orderBy("far")
    return some.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).collect()


def leaves_needed(forest: Forest, queries: list, neighbours: list) -> int:
    """How many leaves a query takes so that TARGET_RECALL of the neighbours lie in them."""
    near: dict[int, list] = {}
    for row in neighbours:
        near.setdefault(row["query"], []).append(row["embedding"])
    ranks = []
    for query in queries:
        vectors = np.array(near.get(query["point"], []), dtype=np.float64)
        if not len(vectors):
            continue
        place = np.empty(forest.leaves, np.int64)
        place[forest.search(np.array(query["embedding"], dtype=np.float64), forest.leaves)] = np.arange(forest.leaves)
        ranks.append(np.min([place[forest.leaf_of(vectors, t)] for t in range(len(forest.roots))], axis=0))
    if not ranks:
        return forest.leaves
    ordered = np.sort(np.concatenate(ranks))
    reach = ordered[min(int(np.ceil(TARGET_RECALL * len(ordered))), len(ordered)) - 1] + 1
    return int(min(np.ceil(reach * ROOM), forest.leaves))


# ---- search -----------------------------------------------------------------

def _rows_in_leaves(points: DataFrame, forest: Forest, subs: int, parts: int) -> DataFrame:
    """Each point once per tree, under the keys of the runs its leaf is handled in."""
    def routed(batches):
        for batch in batches:
            ids, rows = batch.column("point"), _numbers(batch.column("embedding"))
            sub = batch.column("sub").to_numpy(zero_copy_only=False)
            for tree in range(len(forest.roots)):
                cell = forest.leaf_of(rows, tree) * subs + sub
                for part in range(parts):
                    yield _keyed(cell * parts + part, ids, batch.column("embedding"), False)

    rows = points.withColumn("sub", F.pmod(F.xxhash64("point"), F.lit(subs))).select("point", "embedding", "sub")
    return rows.mapInArrow(routed, _keyed_schema(points))


def _queries_in_leaves(asking: DataFrame, forest: Forest, count: int, subs: int, parts: int) -> DataFrame:
    def routed(batches):
        for batch in batches:
            part = batch.column("part").to_numpy(zero_copy_only=False)
            taken = [np.array(forest.search(v, count), dtype=np.int64) for v in _numbers(batch.column("embedding"))]
            # A batch of rows at a time, as one query may take many leaves.
            for row, leaves in enumerate(taken):
                keys = ((leaves[:, None] * subs + np.arange(subs)) * parts + part[row]).ravel()
                same = pa.array(np.full(len(keys), row))
                yield _keyed(keys, batch.column("point").take(same), batch.column("embedding").take(same), True)

    rows = asking.withColumn("part", F.pmod(F.xxhash64("point"), F.lit(parts))).select("point", "embedding", "part")
    return rows.mapInArrow(routed, _keyed_schema(asking))


def _keyed(keys, points, embeddings, asks):
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), points, embeddings, pa.array(np.full(len(keys), asks))],
        ["run", "point", "embedding", "asks"])


def _keyed_schema(points):
    return f"run bigint, point bigint, embedding {points.schema['embedding'].dataType.simpleString()}, asks boolean"


def _merged(best: dict[int, dict[int, float]], k: int):
    """What a task hands on: the k nearest points of each of its queries."""
    rows = [(q, p, d) for q, near in best.items() for p, d in _nearest(near, k).items()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.float64())], ["query", "point", "score"])


def _nearest(near: dict[int, float], k: int) -> dict[int, float]:
    return dict(heapq.nsmallest(k, near.items(), key=lambda pair: (pair[1], pair[0])))


def _candidates(keyed: DataFrame, k: int) -> DataFrame:
    """(query, point, score): per task the nearest points of each query it met."""
    def compared(batches):
        best: dict[int, dict[int, float]] = {}
        for table, starts in sorted_runs(batches, "run"):
            ids = table.column("point").to_numpy()
            asks = table.column("asks").to_numpy()
            vectors = _numbers(table.column("embedding"))
            for a, b in zip(starts, np.r_[starts[1:], len(ids)]):
                asking = np.flatnonzero(asks[a:b]) + a
                there = np.flatnonzero(~asks[a:b]) + a
                if not len(asking) or not len(there):
                    continue
                rows, names = vectors[there], ids[there]
                for q in asking.tolist():
                    far = np.sqrt(((rows - vectors[q]) ** 2).sum(axis=1))
                    near = best.setdefault(int(ids[q]), {})
                    if len(far) > k:
                        some = far <= np.partition(far, k - 1)[k - 1]
                        near.update(zip(names[some].tolist(), far[some].tolist()))
                    else:
                        near.update(zip(names.tolist(), far.tolist()))
                    if len(near) > 8 * k:
                        best[int(ids[q])] = _nearest(near, k)
            if len(best) > HELD_QUERIES:
                yield _merged(best, k)
                best = {}
        yield _merged(best, k)

    sorted_rows = keyed.repartition("run").sortWithinPartitions("run")
    return sorted_rows.mapInArrow(compared, "query bigint, point bigint, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", embedding: str = "embedding",
           trees: int = TREES, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query row, itself left out.

    `is_query` is a condition on a column named vec_id.
    """
    rows = _taking_part(vectors.select(F.col(key).alias("vec_id"), F.col(embedding).alias("embedding")))
    points = _points(rows, k + 1)
    asked = (
        rows.filter(is_query).join(points.select("point", "embedding"), "embedding")
        .select(F.col("vec_id").alias("query_id"), "point")
    )
    asked = materialise(asked, "asked")
    asking = points.join(asked.select("point").distinct(), "point", "left_semi")
    near = _search_points(points, asking, k + 1, trees, leaf_points)

    # A query's own point is the nearest of all and stands for the query's copies.
    found = (
        asked.join(near.withColumnRenamed("point", "near"), asked["point"] == near["query"])
        .join(points.select(F.col("point").alias("near"), "ids"), "near")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter(F.col("vec_id") != F.col("query_id"))
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _search_points(points: DataFrame, asking: DataFrame, k: int, trees: int, leaf_points: int) -> DataFrame:
    """(query, point, score): the k nearest points found of every asking point."""
    total = points.count()
    queries = asking.count()
    if not total or not queries:
        return points.sparkSession.createDataFrame([], "query bigint, point bigint, score double")
    width = points.select(F.size("embedding")).first()[0]
    forest = grow(_sample(points, total, width), trees, leaf_points)
    share = int(min(1.0, MEASURED_QUERIES / queries) * 1_000_000)
    measured = asking.filter(F.pmod(F.xxhash64("point", F.lit(3)), F.lit(1_000_000)) < share).select("point", "embedding").collect()
    count = leaves_needed(forest, measured, _exact(points, measured, k - 1) if measured else [])

    per_leaf = total * len(forest.roots) / forest.leaves
    subs = max(1, round(per_leaf / RUN_ROWS))
    parts = max(1, round(queries * count / forest.leaves / RUN_ROWS))
    keyed = _rows_in_leaves(points, forest, subs, parts).union(_queries_in_leaves(asking, forest, count, subs, parts))
    once = _candidates(keyed, k).groupBy("query", "point").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query").orderBy("score", "point")
    return once.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).select("query", "point", "score")
