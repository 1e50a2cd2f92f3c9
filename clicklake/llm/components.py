"""Connected components by alternating large-star and small-star steps, with every step written down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Written down, so that a hot node's edges meet a plain table and the join can be split.
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "cc-least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Works on each node's smaller neighbours: one per group it was found in, never many."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a")
    return moved.select("b", "m").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node either has one neighbour above it and none below, or is the top of its star."""
    one, none = F.lit(1), F.lit(0)
    ends = edges.select(F.col("a").alias("node"), one.alias("child"), none.alias("top"))
    ends = ends.union(edges.select(F.col("b").alias("node"), none.alias("child"), one.alias("top")))
    odd = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("top").alias("top"))
    return odd.where("child > 1 OR (child = 1 AND top = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns a, b): the label is the smallest node reachable.

    Nodes need only be orderable. Steps go on until only stars are left, about the logarithm of the longest
    chain.
    """
    edges = stored(edges.where("a != b").select("a", "b").distinct(), "cc")
    while not _are_stars(edges):
        edges = stored(_small_star(_large_star(edges)).distinct(), "cc")
    # A star may still hang on a node that is not its smallest.
    least = edges.groupBy("b").agg(F.min("a").alias("m")).select("b", F.least("b", "m").alias("label"))
    least = stored(least, "cc-least")
    members = edges.join(least, "b").select(F.col("a").alias("node"), "label")
    return members.union(least.select(F.col("b").alias("node"), "label"))
