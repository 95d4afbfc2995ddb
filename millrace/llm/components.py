"""Connected components of a link table by alternating star contraction, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b); the component is its smallest node.

    Each round points the larger neighbours of a node, then its smaller ones, at the smallest
    of them, until the links form stars. A node with many links is met by grouped minima and
    joins only, never as one collected group.
    """
    links = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        # Every link now points from the larger to the smaller node.
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a"), F.col("low").alias("b")))).alias("l"))
        links = saved(small.select("l.*").where("a <> b").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
