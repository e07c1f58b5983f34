"""Connected components by alternating star contraction, as joins and aggregates on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import cut_lineage


def _is_done(edges: DataFrame) -> bool:
    """Whether every node with a smaller neighbour has one only, which itself has none: all components are stars."""
    ends = edges.select(F.col("a").alias("n"), F.lit(0).alias("up")).unionByName(edges.select(F.col("b").alias("n"), F.lit(1).alias("up")))
    seen = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
    return seen.filter("ups > 1 or (ups = 1 and low = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``[node, root]`` for every node of ``edges[a, b]``; the root is the smallest node that can be reached.

    Each round ties every node to the smallest node it sees, then flattens; the rounds grow with the logarithm of the
    longest path. Joins on a hub are plain equi-joins of (node, smallest), which adaptive execution splits.
    """
    edges = edges.filter(F.col("a") != F.col("b"))
    edges = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while not _is_done(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours meet the smallest of the neighbourhood
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        # small star: each node and its smaller neighbours meet the smallest of those
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        edges = cut_lineage(small.filter(F.col("x") != F.col("y")).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    child = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return child.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
