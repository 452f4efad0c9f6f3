"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwork.llm.spark_util import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Every edge goes down, from a node that has no other edge: components with their least node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), (F.col("u") < F.col("v")).cast("int").alias("up")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of integer ids, any orientation -> ``(node, component)`` with the
    smallest id reachable, for every node that has an edge to another.

    Each round points nodes at the least neighbour of their neighbourhood; the rounds end
    when only stars are left (about log2 of the longest chain).  Hubs are only ever
    aggregated (partial minimum) or joined, never gathered.  Null ends are ignored.
    """
    edges = materialise(edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(F.col("u").cast("long"), F.col("v").cast("long")).distinct())
    while not _is_stars(edges):
        edges = materialise(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct())
