"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of an edge.

    Large-star and small-star steps in turn: every node hands its smallest neighbour to the larger ones, then to the
    smaller ones, until the edges are a star around the smallest node of each component. Smallest neighbours are
    groupings with partial sums; the edges of a node that most others link to are split by the adaptive join. Each
    step is written, so lost executors cost one step; the driver sees a count and a checksum.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    e, before = settle(e, "edges"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large.filter("u > v"), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).distinct()
        e = settle(small.filter("u > v"), "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    star = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())
