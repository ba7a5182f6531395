"""Ranking inside groups whose size is not bounded.

A plain window sends a whole group to one task. The rows of groups above ``hot_rows`` are therefore dealt
into ranges of (group, order), as many as their rows ask for; every range is ranked on its own and
shifted by the rows of its group in the ranges before it. Ranks with ties are those of the
distinct values, so that rows with one value may lie anywhere. The result is that of the plain window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklight.runtime import broadcast_if_small, by_rows, stage

HOT_ROWS = 2_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """``(key, n, pieces)`` of the keys with more than ``hot_rows`` rows, written; ``pieces`` of at most so many rows.

    None if there is no such key.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    found = stage(counts.withColumn("pieces", F.ceil(F.col("n") / hot_rows).cast("int")), "hot-keys")
    return None if found.isEmpty() else found


def rank_in_group(
    df: DataFrame,
    group: str,
    order: list[Column],
    *,
    rank: str = "rn",
    size: str = "group_rows",
    ties: str | None = None,
    derived: dict[str, Column] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``rank`` 1..n along ``order`` and the group's row count.

    With ``ties``, the name of the only ordering column, rows with equal values share the least of their ranks.
    ``derived`` columns are added to the rows and, where no group is hot, computed after the shuffle and not sent.
    """
    window = Window.partitionBy(group)
    kind = F.rank if ties else F.row_number
    derived = derived or {}
    keys = hot_keys(df, group, hot_rows)
    if keys is None:
        df = by_rows(df, df.count(), group).withColumns(derived)
        return df.withColumn(rank, kind().over(window.orderBy(*order)).cast("bigint")).withColumn(size, F.count(F.lit(1)).over(window))

    df = df.withColumns(derived)
    n_keys, total = keys.agg(F.count(F.lit(1)), F.sum("n")).first()
    known = broadcast_if_small(keys.select(F.col(group).alias("hot_key"), F.col("n").alias("hot_n")), n_keys, 64)
    is_hot = F.col(group).eqNullSafe(F.col("hot_key"))
    cold = df.join(known, is_hot, "left_anti")
    cold = cold.withColumn(rank, kind().over(window.orderBy(*order)).cast("bigint")).withColumn(size, F.count(F.lit(1)).over(window))
    hot = df.join(known, is_hot).drop("hot_key")

    items = hot.groupBy(group, ties).agg(F.count(F.lit(1)).alias("weight")) if ties else hot.withColumn("weight", F.lit(1))
    ranges = max(2, 2 * -(-total // hot_rows))
    dealt = items.repartitionByRange(ranges, F.col(group), *order).withColumn("range", F.spark_partition_id())
    dealt = stage(dealt, "ranges")
    sizes = dealt.groupBy(group, "range").agg(F.sum("weight").alias("range_rows"))
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select(
        F.col(group).alias("range_key"), F.col("range").alias("in_range"), F.coalesce(F.sum("range_rows").over(earlier), F.lit(0)).alias("before")
    )
    offsets = broadcast_if_small(offsets, n_keys * 2 + ranges, 64)
    placed = dealt.join(offsets, F.col(group).eqNullSafe(F.col("range_key")) & (F.col("range") == F.col("in_range")))
    inside = Window.partitionBy(group, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    position = (F.col("before") + F.coalesce(F.sum("weight").over(inside), F.lit(0)) + 1).cast("bigint")
    if not ties:
        ranked = placed.withColumn(rank, position)
    else:
        values = placed.select(F.col(group).alias("value_key"), F.col(ties).alias("value"), position.alias(rank))
        same = F.col(group).eqNullSafe(F.col("value_key")) & F.col(ties).eqNullSafe(F.col("value"))
        ranked = hot.join(values, same)
    return cold.unionByName(ranked.select(*df.columns, rank, F.col("hot_n").cast("bigint").alias(size)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
