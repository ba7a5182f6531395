"""Row filters and deterministic samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.functions.hashing import uniform
from tracklight.schema import TRACK, USER


def count_per_key(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def keep_in(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi").select(*df.columns)


def active_users(df: DataFrame, min_user_rows: int = 50, min_track_rows: int = 2) -> DataFrame:
    """Rows of users with enough rows and of tracks with enough rows, both counted before filtering."""
    users = count_per_key(df, USER).where(F.col("n") >= min_user_rows).select(USER)
    tracks = count_per_key(df, TRACK).where(F.col("n") >= min_track_rows).select(TRACK)
    # the keys are looked up in a hash table of their partition: the rows are shuffled, not sorted
    return keep_in(keep_in(df, users.hint("shuffle_hash"), USER), tracks.hint("shuffle_hash"), TRACK)


def sample_bernoulli(df: DataFrame, fraction: float = 0.005, seed: int = 0, keys=(USER, TRACK)) -> DataFrame:
    """Rows kept with probability ``fraction``, decided by their key and not by their partition."""
    return df.where(uniform(*[F.col(k) for k in keys], "sample", seed) < fraction)


def first_users(df: DataFrame, n: int) -> DataFrame:
    return df.select(USER).distinct().orderBy(USER).limit(n)
