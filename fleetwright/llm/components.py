"""Connected components of a graph given as links, without collecting it."""

from pyspark.sql import DataFrame, functions as F

from fleetwright.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest around the node."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        both.join(least, "a").filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them.

    Links lead from the larger to the smaller node.
    """
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .union(least.select("a", F.col("m").alias("b")))
        .filter(F.col("a") != F.col("b")).distinct()
    )


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (bigint a, b); the root is its component's smallest.

    Alternates the two star operations until nothing changes: the number of
    rounds grows with the logarithm of the largest component. Aggregation
    combines on the map side and each round is written, so neither a hot node nor
    a lost executor needs one task or a long recomputation. Nodes without a link
    are not listed; an empty table gives an empty one.
    """
    larger = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = materialise(larger.filter(F.col("a") != F.col("b")).distinct(), "links")
    before, mark = None, _mark(stars)
    while mark != before and mark[0]:
        stars = materialise(_small_star(_large_star(stars)), "stars")
        before, mark = mark, _mark(stars)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
