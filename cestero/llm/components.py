"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cestero.llm.text import staged


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none that has one itself."""
    up, down = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = edges.select("u", up.alias("ups"), down.alias("downs")).union(
        edges.select("v", down, up)
    )
    sums = ends.groupBy("u").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs"))
    return sums.where("ups > 1 OR ups + downs > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of all ends of ``edges`` (``u, v``); the smallest node names it.

    Every round points the larger neighbours of a node to the smallest one and
    then the smaller ones likewise, until only stars are left: O(log^2) rounds,
    each on at most as many edges as before. What reaches the driver is whether
    that is so. Loops and repeated edges do no harm.
    """
    edges = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(lowest.withColumnRenamed("m", "v")).distinct())
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
