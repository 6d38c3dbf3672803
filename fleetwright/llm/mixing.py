"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: sources in code point order (NULL last) weigh 5, 2, 1, repeating, and
   share the words of all documents. A target stops at 3 times its source's words
   and the excess goes to the others by weight, until none is above.
2. Blocks: a source's documents fall by hash into blocks of about `block_words`
   words, and a hash orders the blocks. A source gives its blocks in that order,
   from the beginning again when all are given, until its target is met: the block
   where the target lies gives the documents that come nearest to it. The number
   of blocks a source gives is its quota.
3. Tree: the quotas are split among output shards. A node deals its blocks to its
   two halves by a draw from the multivariate hypergeometric distribution, so each
   shard has its exact number of blocks and its sources vary as in a fair draw.
   A shard's blocks of a source are a run of the source's order, disjoint from all
   other shards'.
4. Within a shard a hash of document and copy gives the order.

All draws are seeded by source, node and document: reruns agree. Documents stay
whole, and taken at most as often as the cap says.

Defined cases: a NULL or empty text has no words and is not taken; NULL is a
source of its own; a NULL id counts like any other, and equal rows fall into
one block but count each by itself where the target lies. Other columns are not read (`mix`) or kept (`mixed_documents`).
An empty table gives an empty result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetwright.llm.common import WORD, materialise

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 50_000
SHARD_BLOCKS = 64
SEED = 2024

# Documents around a target's edge among which the nearest sum is looked for.
EDGE_DOCUMENTS = 64

# Sources whose quotas are drawn together. Beyond it sources are dealt to trees of
# their own, whose shards are numbered on, so no task holds more.
TREE_SOURCES = 100_000


def word_count(text) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---- targets ----------------------------------------------------------------

def targets(sizes: DataFrame, weights=WEIGHTS, cap: float = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, rank) from (source, source_size).

    With w the weight and s the size, a source is capped if its share per weight
    at the end is above cap * s / w. Sources are taken in the order of that
    bound: those with the smallest are capped as long as the rest, shared among
    the others, exceeds it. One row per source passes here, never a document.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", weight).withColumn("bound", cap * F.col("source_size") / F.col("w"))
    by_bound = Window.orderBy("bound", "rank")
    everything = Window.partitionBy()
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        ranked
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("w").over(everything))
        .withColumn("spent", cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("gone", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("all_words") - F.col("spent")) / (F.col("all_weight") - F.col("gone")))
    )
    # The level of the first source that is not capped holds for all after it.
    level = F.min(F.when(F.col("level") < F.col("bound"), F.struct("bound", "rank", "level"))).over(everything)["level"]
    capped = (F.col("source_size") * float(cap)).alias("target")
    return ahead.withColumn("final", level).select(
        "source", "source_size", "rank",
        F.when(F.col("final").isNull() | (F.col("bound") <= F.col("final")), capped)
        .otherwise(F.col("w") * F.col("final")).alias("target"))


# ---- blocks -----------------------------------------------------------------

def _same_source(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right.withColumnRenamed("source", "_other"), F.col("source").eqNullSafe(F.col("_other"))).drop("_other")


def nearest_sum(sizes: list[int], room: int) -> np.ndarray:
    """Which of `sizes` add up to the sum nearest to `room`.

    Bit s of a layer says whether the sizes so far can add up to s.
    """
    layers = [1]
    for size in sizes:
        layers.append(layers[-1] | layers[-1] << size)
    below = layers[-1] & ((1 << room + 1) - 1)
    above = layers[-1] >> room
    total = below.bit_length() - 1
    over = room + (above & -above).bit_length() - 1
    if above and over - room < room - total:
        total = over
    taken = np.zeros(len(sizes), bool)
    for k in reversed(range(len(sizes))):
        if not layers[k] >> total & 1:
            taken[k] = True
            total -= sizes[k]
    return taken


def _fitting(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one block's documents in hash order, those that fill what is left: the
    first ones, and around the edge those that come nearest together."""
    rows = rows.sort_values(["draw", "size", "place"], ignore_index=True)
    sizes, room = rows["size"].to_numpy(), int(rows["room"].iloc[0])
    edge = int(np.searchsorted(np.cumsum(sizes), room, side="right"))
    first, last = max(edge - EDGE_DOCUMENTS // 2, 0), edge + EDGE_DOCUMENTS // 2
    fits = np.arange(len(rows)) < first
    fits[first:last] = nearest_sum(sizes[first:last].tolist(), room - int(sizes[:first].sum()))
    return rows.assign(fits=fits)[["place", "fits"]]


def _split(quota: np.ndarray, shards: int, seed: int, node: int, first: int, out: list) -> None:
    """Deal `quota` blocks per source to `shards` leaves; appends (shard, quotas)."""
    if shards == 1:
        out.append((first, quota))
        return
    half, total = shards // 2, int(quota.sum())
    wanted = total * half // shards
    draw = np.random.default_rng([seed, node]).multivariate_hypergeometric(quota, wanted, method="marginals")
    _split(draw, half, seed, 2 * node, first, out)
    _split(quota - draw, shards - half, seed, 2 * node + 1, first + half, out)


def shard_quotas(quotas: DataFrame, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED) -> DataFrame:
    """(rank, shard, from_block, to_block) from (rank, quota): the run of a source's
    blocks, counted over all its repeats, that each shard takes."""
    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank", ignore_index=True)
        quota = rows["quota"].to_numpy(dtype=np.int64)
        leaves: list = []
        _split(quota, max(1, -(-int(quota.sum()) // shard_blocks)), seed, 1, 0, leaves)
        given, pieces = np.zeros(len(quota), np.int64), []
        for shard, draw in leaves:
            some = np.flatnonzero(draw)
            pieces.append(pd.DataFrame({
                "rank": rows["rank"].to_numpy()[some], "shard": shard + (rows["tree"].iloc[0] << 32),
                "from_block": given[some], "to_block": given[some] + draw[some]}))
            given += draw
        return pd.concat(pieces, ignore_index=True)

    treed = quotas.withColumn("tree", F.floor(F.col("rank") / TREE_SOURCES))
    return treed.groupBy("tree").applyInPandas(
        tree, "rank int, shard bigint, from_block bigint, to_block bigint")


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights=WEIGHTS,
        cap: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS,
        seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, place, size, source_size, target, taken, and
    `copies`, an array of (copy, shard, draw): which repeat, its shard, and its
    place among the shard's rows in the order of `draw`.

    The texts are read once, for their sizes; all else works on narrow rows.
    `place` numbers the rows as they were read.
    """
    narrow = materialise(docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        F.monotonically_increasing_id().alias("place")), "sizes")
    return _mix(narrow, weights, cap, block_words, shard_blocks, seed)


def _mix(narrow, weights, cap, block_words, shard_blocks, seed, carried=None):
    """`mix` of the written rows `narrow`. `carried`, the same rows with one more column
    `row`, keeps that column; it meets the plan's tables at the very end only."""
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialise(
        targets(sizes, weights, cap).withColumn(
            "blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long")), "sources")

    def in_blocks(rows):
        draw = F.xxhash64("doc_id", F.lit(seed))
        return _same_source(rows, sources).withColumn("draw", draw).withColumn("block", F.pmod("draw", "blocks"))

    dealt = in_blocks(narrow)

    # Whole repeats first; then blocks in their order up to the one that holds the target.
    rest = F.col("target") - F.floor(F.col("target") / F.greatest("source_size", F.lit(1))) * F.col("source_size")
    in_order = Window.partitionBy("rank").orderBy(F.xxhash64("block", "rank", F.lit(seed)), "block")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialise(
        dealt.filter(F.col("size") > 0).groupBy("rank", "block")
        .agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
        .withColumn("position", F.row_number().over(in_order) - 1)
        .withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .withColumn("repeats", F.floor(F.col("target") / F.col("source_size")))
        .withColumn("room", rest - F.col("ahead"))
        .withColumn("part", F.when(F.col("words") <= F.col("room"), 2).when(F.col("room") > 0, 1).otherwise(0))
        .select("rank", "block", "position", "repeats", "room", "part"), "blocks")

    # The block where the target lies is the only one looked into; it has about block_words words.
    edge = blocks.filter(F.col("part") == 1).select("rank", "block", "room")
    fitting = (
        dealt.filter(F.col("size") > 0).join(edge, ["rank", "block"])
        .select("rank", "block", "place", "draw", "size", "room")
        .groupBy("rank", "block").applyInPandas(_fitting, "place bigint, fits boolean")
        .filter("fits").select("place", F.lit(True).alias("fits"))
    )
    quotas = blocks.groupBy("rank").agg(
        F.count("*").alias("all_blocks"),
        (F.first("repeats") * F.count("*") + F.sum((F.col("part") > 0).cast("long"))).alias("quota"))
    runs = shard_quotas(quotas.filter(F.col("quota") > 0).select("rank", "quota"), shard_blocks, seed)

    # Copy c of the block at position p is number c * all_blocks + p of its source's order.
    numbered = (
        blocks.join(quotas, "rank")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats"))))
        .filter((F.col("copy") < F.col("repeats")) | (F.col("part") > 0))
        .withColumn("number", F.col("copy") * F.col("all_blocks") + F.col("position"))
    )
    homes = _in_run(numbered, runs).groupBy("rank", "block").agg(
        F.max("repeats").alias("repeats"), F.max("part").alias("part"),
        F.sort_array(F.collect_list(F.struct("copy", "shard"))).alias("homes"))
    # A row per block, and per document at an edge: written, so that their size is known.
    homes, fitting = materialise(homes, "homes"), materialise(fitting, "fitting")

    final = dealt if carried is None else in_blocks(carried)
    placed = final.join(homes, ["rank", "block"], "left").join(fitting, "place", "left")
    # The last, partial repeat goes to documents of whole blocks, and to those chosen at the edge.
    last = (F.col("part") == 2) | F.coalesce("fits", F.lit(False))
    copies = F.when(F.col("size") > 0, F.filter("homes", lambda h: (h["copy"] < F.col("repeats")) | last))
    copies = F.transform(F.coalesce(copies, F.expr("CAST(array() AS array<struct<copy: bigint, shard: bigint>>)")), lambda h: F.struct(
        h["copy"].alias("copy"), h["shard"].alias("shard"),
        F.xxhash64("doc_id", h["copy"], F.lit(seed + 1)).alias("draw")))
    return placed.withColumn("copies", copies).select(
        "doc_id", "place", "size", "source_size", "target",
        (F.col("size") * F.size("copies")).alias("taken"), "copies", *(["row"] if carried is not None else []))


def _in_run(numbered: DataFrame, runs: DataFrame) -> DataFrame:
    """Give each numbered block the shard whose run of its source holds the number.

    Both are ordered along the source by one window: a run begins where its first
    number is, and the last beginning up to a block is its run.
    """
    begins = runs.select("rank", F.col("from_block").alias("number"), "shard", F.lit(0).alias("kind"))
    wanted = numbered.select("rank", "number", F.lit(None).cast("bigint").alias("shard"), F.lit(1).alias("kind"),
                             "block", "copy", "repeats", "part")
    along = Window.partitionBy("rank").orderBy("number", "kind")
    return (
        begins.unionByName(wanted, allowMissingColumns=True)
        .withColumn("shard", F.last("shard", ignorenulls=True).over(along)).filter("kind = 1")
    )


def mixed_documents(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix itself: `docs` repeated as taken, each shard's rows together and shuffled."""
    rows = materialise(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                   F.col(key).alias("doc_id"), F.col(source).alias("source"),
                                   word_count(F.col(text)).alias("size"),
                                   F.monotonically_increasing_id().alias("place")), "documents")
    plan = _mix(rows.drop("row"), carried=rows, **{
        "weights": WEIGHTS, "cap": MAX_REPEATS, "block_words": BLOCK_WORDS, "shard_blocks": SHARD_BLOCKS,
        "seed": SEED, **options})
    taken = plan.filter(F.size("copies") > 0).select("row", F.explode("copies").alias("copy"))
    return taken.repartition("copy.shard").sortWithinPartitions("copy.shard", "copy.draw").select("row.*")
