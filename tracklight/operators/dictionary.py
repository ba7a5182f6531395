"""Dense integer ids for values, and tables rewritten with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklight.functions.transforms import parse_tags


def build_dictionary(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` as ``(key, idx)`` with idx 0..n-1; null counts as a value.

    The order is (first three hex digits of the value's md5, value). Each of the 4,097 prefixes is
    numbered on its own and shifted by the size of those before it, so no task sorts all values.
    """
    values = df.select(F.col(column).cast("string").alias("key")).distinct()
    values = values.withColumn("prefix", F.coalesce(F.substring(F.md5("key"), 1, 3), F.lit("")))
    sizes = values.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    # one row per prefix: 4,097 at most, whatever the data
    running = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("prefix", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("start"))
    position = F.row_number().over(Window.partitionBy("prefix").orderBy("key"))
    return values.join(F.broadcast(starts), "prefix").select(
        "key", (position + F.col("start") - 1).cast("int").alias("idx")
    )


def build_tag_dictionary(df: DataFrame, column: str = "tags") -> DataFrame:
    return build_dictionary(df.select(F.explode(parse_tags(column)).alias("tag")), "tag")


def remap(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """Replace values, null among them, by their index; values the dictionary lacks become null."""
    lookup = dictionary.select(F.col("key").alias("remapped_key"), F.col("idx").alias("remapped"))
    columns = [F.col("remapped").alias(column) if c == column else F.col(c) for c in df.columns]
    return df.join(lookup, F.col(column).cast("string").eqNullSafe(F.col("remapped_key")), "left").select(*columns)


def remap_tag_list(df: DataFrame, key: str, column: str, dictionary: DataFrame) -> DataFrame:
    """``(key, tag_ids)``: tags in their order as indices, unknown tags null, no tags []."""
    tags = df.select(key, F.posexplode_outer(parse_tags(column)).alias("pos", "tag"))
    found = tags.join(dictionary.select(F.col("key").alias("tag"), "idx"), "tag", "left")
    listed = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "idx"))))
    return found.groupBy(key).agg(F.transform(listed, lambda s: s["idx"]).alias("tag_ids"))


def original_ids(df: DataFrame, column: str, dictionary: DataFrame, out: str) -> DataFrame:
    """Reverse lookup: index back to the value it stands for."""
    return df.join(dictionary.select(F.col("idx").alias(column), F.col("key").alias(out)), column)
