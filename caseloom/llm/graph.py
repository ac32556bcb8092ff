"""Connected components of an edge table, by alternating star contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.frames import cut


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One contraction: hang neighbours (larger ones only if ``both_ways``) on the least node around.

    Only minima are aggregated and joined back, so no node's neighbours are gathered in one place.
    """
    if both_ways:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    hung = edges.join(least, "a")
    if both_ways:  # (u, v) with v > u: v -> m
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # u and its lower neighbours -> m
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the least node reachable. Rounds grow with log of the size."""
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        edges = cut(_star(_star(edges, True), False))
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
