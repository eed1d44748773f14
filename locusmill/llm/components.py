"""Connected components of a link table, by large-star and small-star steps over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: label is the smallest node that links reach. Nodes without a link to another node are left out.

    Each step hangs neighbours on the smallest node seen. Only min() and the join of a node's own links with that one
    minimum are used, so that a node with very many links is split like any skewed join. An even and an odd step
    repeat until a step changes nothing; O(log n) pairs of steps in practice.
    """
    links = cut(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct())
    state = None
    while True:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        large = both.where("v > u").join(m, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        # small star: smaller neighbours of u, and u, go to the smallest
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi")).where("lo < hi")
        fresh = cut(small.union(low.select(F.col("m").alias("lo"), "hi")).where("lo < hi").distinct())
        now = fresh.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        drop_cut(links)
        links = fresh
        if state == now:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("label"))
        state = now
