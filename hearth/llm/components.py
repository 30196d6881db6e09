"""Connected components of a graph held as a DataFrame of edges (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)`` for each node with an edge; root is the least node.

    Null ends, loops and repeated edges are ignored; no edges give an empty result. Each round writes
    its edges (never more than the first) to the shared folder; the driver sees a count and a checksum
    only. The stars stop changing after a number of rounds logarithmic in the longest path.
    """
    stars = write_scratch(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = _state(stars)
    while before[0]:
        stars = write_scratch(_small_star(_large_star(stars)), "stars")
        now = _state(stars)
        if now == before:
            break
        before = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
