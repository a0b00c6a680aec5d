"""Connected components by alternating large and small stars, on the executors throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.llm.scratch import drop, materialize


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: hang each node's larger neighbours on the smallest of it and its neighbours. Small: the smaller ones.

    The minimum is pre-aggregated in every task and joined back, so a node with very many neighbours is
    never one task's group."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that a link touches; root is the least node of its component."""
    edges = materialize(
        links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )  # every edge points to its smaller end
    before = None
    while (now := _checksum(edges)) != before:
        before, old = now, edges
        edges = materialize(_star(_star(edges, True), False), "edges")
        drop(old)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    out = materialize(roots, "roots")
    drop(edges)
    return out
