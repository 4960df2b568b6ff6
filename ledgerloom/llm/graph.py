"""Connected components of a table of edges, all in DataFrames."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """Every node of ``edges`` (columns a, b) with the smallest node it reaches: columns node, root.

    Alternating large and small stars: every node hands its larger neighbours,
    then its smaller ones, to the smallest node it knows. No neighbourhood is
    gathered: a round is a minimum per node and a join on the node, which adaptive
    execution splits at hubs. Each round is written to the shared folder, and
    rounds end when the edges stop changing. Self-loops and repeated edges are allowed.
    """
    edges = written(edges.filter(F.col("a") != F.col("b"))
                    .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.withColumnRenamed("m", "v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
