"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_stored, stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)`` but the roots themselves.

    The component is the smallest node that can be reached. Large-star hangs every larger
    neighbour of a node below its smallest one, small-star every smaller neighbour and the
    node itself; the two repeat until nothing moves, after a number of rounds that grows with
    the logarithm of the longest path. Every step is a grouping with partial minima and one
    join, so a node with very many neighbours is split like any skewed join. Rows with a null
    end and loops are no links; without links there are no rows.
    """
    ends = links.where("a != b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("component")
    )
    edges = stored(ends.distinct())
    mark = _fingerprint(edges)
    while mark[0]:
        large = stored(_large_star(edges))
        drop_stored(edges)
        edges = stored(_small_star(large))
        drop_stored(large)
        now = _fingerprint(edges)
        if now == mark:
            break
        mark = now
    return edges


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("node").alias("u"), F.col("component").alias("v")).union(
        edges.select("component", "node")
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("m"))
    return moved.select("node", F.col("m").alias("component")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("component").alias("m"))
    moved = edges.join(least, "node").where("component != m").select(F.col("component"), "m")
    return (
        least.select("node", F.col("m").alias("component"))
        .union(moved.select(F.col("component").alias("node"), "m"))
        .distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    # The sum wraps on purpose, so that any order of rows gives the same value.
    hashes = F.xxhash64("node", "component").cast("decimal(38, 0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashes)).first())
