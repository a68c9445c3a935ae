"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour or itself."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    larger = both.where(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").where(F.col("b") != F.col("least"))
    tied = others.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b: long): root is the smallest node reachable.

    Each round is stored, so the plan does not grow, and rounds end when a round changes no
    link. Links only ever point at smaller nodes, at most one per node and round more.
    """
    edges, seen = stored(links.where("a <> b").select("a", "b"), "links"), None
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.union(edges.select(F.col("a").alias("node"), F.col("b").alias("root")))
