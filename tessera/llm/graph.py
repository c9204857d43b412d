"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of an
    undirected edge list of longs; loops are ignored.

    Each step rewires edges towards the smallest known neighbour and is written
    to the shared folder; the edge count never grows beyond twice the input,
    and a hub's neighbours only meet in a minimum. Steps are about logarithmic
    in the longest chain.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = stored(pairs, "edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # Done when every node but a root has one edge, and that to a root.
        ends = pairs.select("u", F.lit(1).alias("edges"), F.lit(False).alias("root")) \
            .unionByName(pairs.select(F.col("v").alias("u"), F.lit(0).alias("edges"), F.lit(True).alias("root"))) \
            .groupBy("u").agg(F.sum("edges").alias("edges"), F.max("root").alias("root"))
        if ends.where("edges > 1 or (edges = 1 and root)").isEmpty():
            break
    roots = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
