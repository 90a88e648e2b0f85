"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.llm.common import written


def _stars(edges: DataFrame, low_only: bool) -> DataFrame:
    """One step over (u, v): every node's neighbours are linked to the least of them and itself."""
    if low_only:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = near.join(least, "u")
    if low_only:
        out = linked.select(F.col("v").alias("u"), "m").unionByName(least.select("u", "m"))
    else:
        out = linked.where("v > u").select(F.col("v").alias("u"), "m")
    return out.where("u <> m").select("u", F.col("m").alias("v")).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the component's least node.

    No node's neighbours are ever gathered: each step is a minimum by key and a
    join back, so a hub with any number of neighbours is split like other skewed
    join keys. Rounds grow with the logarithm of the longest chain.
    """
    spark = edges.sparkSession
    e = written(spark, edges.select("u", "v").where("u <> v").distinct(), name)
    while True:
        e = written(spark, _stars(_stars(e, False), True), name)
        # Done when all edges point at roots: nobody is both a child and a root.
        if e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
