"""Train/test splits, folds and unseen-track draws, all decided by seeded hashes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklight.functions.hashing import digest, hash48, uniform
from tracklight.operators.dictionary import build_dictionary
from tracklight.operators.filters import count_per_key
from tracklight.operators.skew import HOT_ROWS, rank_in_group
from tracklight.runtime import broadcast_if_small
from tracklight.schema import PLAYS, TRACK, USER

DRAWS_PER_ROW = 4096
#: Tracks of a block of ``all_unseen``, on average at most.
BLOCK_TRACKS = 4096


def split_per_user(df: DataFrame, seed: int = 42, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``split``: a fifth of each user's rows, rounded up, is test; a single row stays in train."""
    # the bytes of the digest order as its text does, in half the memory
    keyed = {"digest": F.unhex(digest(F.col(USER), F.col(TRACK), seed))}
    ranked = rank_in_group(df, USER, [F.col("digest"), F.col(TRACK)], derived=keyed, hot_rows=hot_rows)
    test_rows = F.expr("(group_rows + 4) div 5")
    is_test = (F.col("group_rows") > 1) & (F.col("rn") <= test_rows)
    return ranked.withColumn("split", F.when(is_test, "test").otherwise("train")).select(*df.columns, "split")


def split_ratio(df: DataFrame, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``split`` over the whole table, each row on its own."""
    draw = uniform(F.col(USER), F.col(TRACK), "ratio", seed)
    return df.withColumn("split", F.when(draw < train, "train").otherwise("test"))


def folds(df: DataFrame, n: int = 5, seed: int = 1) -> DataFrame:
    """Add ``fold`` 0..n-1; training data for fold i is every row with another fold."""
    return df.withColumn("fold", F.pmod(hash48(F.col(USER), F.col(TRACK), "fold", seed), F.lit(n)).cast("int"))


def next_prime(n: int) -> int:
    candidate = max(2, n)
    while any(candidate % d == 0 for d in range(2, math.isqrt(candidate) + 1)):
        candidate += 1
    return candidate


def draw_unseen(train: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` pseudo-random unseen tracks per user as ``(user, track, draw)``; all unseen ones if fewer.

    Each user walks the track numbers in steps of a personal stride modulo a prime, which visits
    every track once. ``n`` plus the user's seen tracks plus the numbers past the last track are
    enough steps for an exact result, so the work follows the rows of train and no pair of user and
    track is listed for its own sake. Long walks are cut into pieces that spread over tasks.
    """
    tracks = build_dictionary(train, TRACK).select(F.col("key").cast("int").alias(TRACK), "idx")
    n_tracks = train.select(TRACK).distinct().count()
    if n_tracks == 0:
        return train.select(USER, TRACK).withColumn("draw", F.lit(0).cast("bigint"))
    prime = next_prime(n_tracks)
    seen = train.select(USER, TRACK)
    walks = count_per_key(seen, USER, "n_seen").select(
        USER,
        (1 + F.pmod(hash48(F.col(USER), "stride", seed), F.lit(max(1, prime - 1)))).alias("stride"),
        F.pmod(hash48(F.col(USER), "start", seed), F.lit(prime)).alias("start"),
        F.least(F.lit(prime), F.col("n_seen") + n + (prime - n_tracks)).cast("bigint").alias("steps"),
    )
    last_piece = F.expr(f"(steps - 1) div {DRAWS_PER_ROW}")
    pieces = walks.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece)))
    pieces = pieces.repartition(USER, "piece")
    low = F.col("piece") * DRAWS_PER_ROW
    high = F.least(low + DRAWS_PER_ROW, F.col("steps")) - 1
    steps = pieces.withColumn("draw", F.explode(F.sequence(low, high)))
    position = F.pmod(F.col("start") + F.col("stride") * F.col("draw"), F.lit(prime)).cast("int")
    # an exploded row counts as one in Spark's estimates: without the hint all steps may be broadcast through the driver
    drawn = steps.select(USER, "draw", position.alias("idx")).hint("merge").join(tracks, "idx")
    unseen = drawn.join(seen, [USER, TRACK], "left_anti")
    order = Window.partitionBy(USER).orderBy("draw")
    return unseen.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n).select(USER, TRACK, "draw")


def all_unseen(train: DataFrame) -> DataFrame:
    """All tracks of train less the seen ones, for every user: ``(user, track)``.

    Each user meets the tracks block by block, and a block's tracks less those that the user has seen there come out as rows. What
    is shuffled are users times blocks and the rows of train; no row holds more than the tracks of a block.
    """
    tracks = train.select(TRACK).distinct()
    n_tracks = tracks.count()
    blocks = max(1, math.ceil(n_tracks / BLOCK_TRACKS))
    block = F.pmod(F.xxhash64(F.col(TRACK).cast("bigint")), F.lit(blocks)).cast("int").alias("block")
    offered = tracks.groupBy(block).agg(F.collect_list(TRACK).alias("tracks"))
    seen = train.groupBy(USER, block).agg(F.collect_set(TRACK).alias("seen"))
    users = train.select(USER).distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # the block's tracks come last, so that they are not shuffled with every user
    met = users.join(seen, [USER, "block"], "left").join(broadcast_if_small(offered, n_tracks, 16), "block")
    unseen = F.array_except("tracks", F.coalesce("seen", F.array().cast(met.schema["seen"].dataType)))
    return met.select(USER, F.explode(unseen).alias(TRACK))


def add_negatives(train: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Train rows plus ``n`` unseen tracks per user with playcount 0."""
    negatives = draw_unseen(train, n, seed).select(USER, TRACK, F.lit(0).cast(train.schema[PLAYS].dataType).alias(PLAYS))
    return train.select(USER, TRACK, PLAYS).unionByName(negatives)
