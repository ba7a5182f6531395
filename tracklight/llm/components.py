"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.runtime import stage


def connected(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component) for every node of ``edges`` (a, b); loops and repeats are allowed.

    Each step joins a node's neighbours with the least of them, so edges only ever point closer to the root;
    minima combine inside tasks, and every step is written so that it starts from files. An empty table
    gives no rows.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "star")
    if now.isEmpty():
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    print_of = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = print_of(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "star")
        after = print_of(now)
        if after == before:
            break
        before = after
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
