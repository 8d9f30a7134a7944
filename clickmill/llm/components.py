"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them: the greater ones, or the smaller ones and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges.select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    hung = both.join(low, "u")
    if large:
        out = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(doc, component) of every node with an edge: the smallest node that it reaches.

    edges has long columns u and v. Minima are aggregated before they are joined, so a node
    with very many neighbours only makes a join key that the skew join splits. The number
    of steps grows with the logarithm of the number of nodes.
    """
    now = settle(edges.where("u <> v").distinct(), "edges")
    while True:
        now = settle(_star(_star(now, True), False), "edges")
        # Done when each node hangs on one node that hangs on none.
        twice = now.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        hanging = now.join(now.select(F.col("u").alias("v")), "v", "left_semi")
        if hanging.isEmpty() and twice.isEmpty():
            break
    out = now.select(F.col("u").alias("doc"), F.col("v").alias("component"))
    return out.union(now.select(F.col("v").alias("doc"), F.col("v").alias("component")).distinct())
