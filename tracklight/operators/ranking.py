"""Top-k lists and ranks per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklight.operators.skew import HOT_ROWS, rank_in_group
from tracklight.schema import PREDICTION, RANK, TRACK, USER


def best_first(prediction: str = PREDICTION, track: str = TRACK, high_track_first: bool = False) -> list:
    """Highest score first; equal scores are ordered by track id."""
    return [F.col(prediction).desc(), F.col(track).desc() if high_track_first else F.col(track).asc()]


def topk_per_user(df: DataFrame, k: int, high_track_first: bool = False) -> DataFrame:
    """The best ``k`` rows per user with ``rank`` 1..k.

    The filter on the row number lets Spark keep only k rows per user and task before the shuffle.
    """
    order = Window.partitionBy(USER).orderBy(*best_first(high_track_first=high_track_first))
    return df.withColumn(RANK, F.row_number().over(order)).where(F.col(RANK) <= k)


def enumerate_ranks(df: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rank`` 1..n over all scored rows of each user."""
    ranked = rank_in_group(df, USER, best_first(), rank=RANK, hot_rows=hot_rows)
    return ranked.drop("group_rows")


def percent_rank(df: DataFrame, value: str = PREDICTION, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``percent_rank`` of each row within its user, 0 for the highest ``value``."""
    ranked = rank_in_group(df, USER, [F.col(value).desc()], ties=value, hot_rows=hot_rows)
    share = F.coalesce(F.try_divide((F.col("rn") - 1).cast("double"), F.col("group_rows") - 1), F.lit(0.0))
    return ranked.withColumn("percent_rank", share).drop("rn", "group_rows")
