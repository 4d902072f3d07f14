"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import store


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node per node: columns ``node``, ``component``.

    ``edges`` has ``a`` and ``b``, longs or any type with an order; direction, repeats and loops do not matter, and
    nodes without an edge to another do not appear. Large-star and small-star steps take
    turns until no edge changes: every step is an aggregation to one row per node and an
    equi-join, so a node with very many neighbours is split like any skewed join key, and
    no component is ever gathered. Each round is written to the shared folder, which cuts
    the lineage and outlives lost executors. Rounds grow with the logarithm of the
    longest path. Empty input gives no rows.
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = store(ordered.filter("u <> v").distinct(), "edges")
    before = _state(current)
    while before[0]:
        current = store(_small_star(_large_star(current)), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    ends = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = ends.select(F.col("component").alias("node"), "component").distinct()
    return ends.unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the smallest node next to it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
