"""Explicit and weighted factorization by batch steps over DataFrames.

Only observed cells are ever rows. Sums per user and per track combine map-side or are spread over
tasks, so a popular track or a very active user does not land in one task. Factor tables are written
after every step.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.functions.transforms import clip
from tracklight.functions.vectors import dot, dot_of, map_of, random_vector, sum_of
from tracklight.models.solver import gram, solve_rows
from tracklight.operators.scoring import best_unseen, block_of, block_rows, grid_partitions, list_column, matrix
from tracklight.operators.skew import hot_keys
from tracklight.runtime import Relay, stage
from tracklight.schema import PLAYS, PREDICTION, TRACK, USER

RATING = "rating"
#: Limit of an element of a pair's push, what is added to the lengths of a pair, and the length from which ``TERMS`` terms of the series in
#: ``TINY`` leave less than 1e-12 of a similarity.
PUSH, TINY, SHORT, TERMS = 0.01, 1e-10, 1e-3, 3


def as_ratings(df: DataFrame, rating: str = PLAYS) -> DataFrame:
    return df.select(USER, TRACK, F.col(rating).cast("double").alias(RATING))


def start_factors(ratings: DataFrame, width: int, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded uniform factors of every user and track that occurs."""
    users = ratings.select(USER).distinct().select(USER, random_vector(width, 1.0, 0.0, F.lit("u"), F.col(USER), seed).alias("vector"))
    tracks = ratings.select(TRACK).distinct().select(TRACK, random_vector(width, 1.0, 0.0, F.lit("i"), F.col(TRACK), seed).alias("vector"))
    return users, tracks


def with_factors(pairs: DataFrame, users: DataFrame, tracks: DataFrame) -> DataFrame:
    """Pairs with both factor vectors as ``u`` and ``v``."""
    return pairs.join(users.select(USER, F.col("vector").alias("u")), USER).join(
        tracks.select(TRACK, F.col("vector").alias("v")), TRACK
    )


def predict(pairs: DataFrame, users: DataFrame, tracks: DataFrame) -> DataFrame:
    joined = with_factors(pairs, users, tracks)
    return joined.withColumn(PREDICTION, dot("u", "v")).drop("u", "v")


def _stepped(cells: DataFrame, key: str, own: str, other: str, width: int, rate: float, reg: float) -> DataFrame:
    """Factors of ``key`` after one batch step: v + rate * sum(2 * error * other - reg * v)."""
    push = map_of(width, lambda x: 2.0 * F.col("error") * x, other)
    summed = cells.select(key, push.alias("push"), F.col(own)).groupBy(key).agg(
        sum_of("push", width).alias("push"), F.count(F.lit(1)).alias("n"), F.first(own).alias("v")
    )
    moved = map_of(width, lambda v, p: v + rate * (p - reg * F.col("n") * v), "v", "push")
    return summed.select(key, moved.alias("vector"))


def gradient_step(
    ratings: DataFrame, users: DataFrame, tracks: DataFrame, width: int, rate: float = 0.001, reg: float = 0.04
) -> tuple[DataFrame, DataFrame]:
    """One batch step on the observed cells: squared error plus ``reg / 2`` of the factor norms per cell."""
    cells = with_factors(ratings, users, tracks).withColumn("error", F.col(RATING) - dot_of("u", "v", width))
    return (
        _stepped(cells, USER, "u", "v", width, rate, reg),
        _stepped(cells, TRACK, "v", "u", width, rate, reg),
    )


def penalised_rmse(ratings: DataFrame, users: DataFrame, tracks: DataFrame, reg: float = 0.04) -> DataFrame:
    """sqrt((squared error + reg / 2 * factor norms, both per observed cell) / cells)."""
    cells = with_factors(ratings, users, tracks)
    gap = F.col(RATING) - dot("u", "v")
    loss = gap * gap + F.lit(reg / 2) * (dot("u", "u") + dot("v", "v"))
    return cells.agg(F.sqrt(F.avg(loss)).alias("rmse"))


def _cell_pushes(mine: DataFrame, theirs: DataFrame, width: int, rate: float, weight: float, rows: int | None) -> DataFrame:
    """(track, push): the limited pushes of ``mine`` by every one of ``theirs``, pair by pair in a grid of blocks; one row per track and block."""
    most = rows or min(4096, block_rows(width))
    own, other = (max(1, math.ceil(side.count() / most)) for side in (mine, theirs))
    cols = [F.col(TRACK).cast("bigint").alias(TRACK), F.col("vector").cast("array<double>").alias("vector")]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    partitions = grid_partitions(mine.sparkSession, own * other)
    left = mine.select(block_of(TRACK, own).alias("a"), *cols).withColumn("b", every(other)).repartition(partitions, "a", "b")
    right = theirs.select(block_of(TRACK, other).alias("b"), *cols).withColumn("a", every(own)).repartition(partitions, "a", "b")

    def push(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        ids = mine[TRACK].to_numpy()
        v, w = matrix(mine["vector"]), matrix(theirs["vector"])
        total = np.zeros_like(v)
        if len(v) and len(w):
            lw = np.sqrt((w * w).sum(axis=1))
            chunk = max(1, 2_000_000 // len(w))
            for low in range(0, len(v), chunk):
                part = v[low : low + chunk]
                similarity = (part @ w.T) / (np.sqrt((part * part).sum(axis=1))[:, None] * lw[None, :] + TINY)
                strength = rate * weight * (1.0 - similarity) / width
                for f in range(v.shape[1]):
                    gap = part[:, f][:, None] - w[:, f][None, :]
                    total[low : low + chunk, f] = np.clip(strength * gap, -PUSH, PUSH).sum(axis=1)
        return pa.table({TRACK: ids, "push": list_column(total)})

    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(push, f"{TRACK} bigint, push array<double>")


def _directions(v: np.ndarray) -> list[np.ndarray]:
    """v / |v| ** (j + 1) for the terms j of 1 / (|a| |b| + TINY) = sum of (-TINY) ** j / (|a| |b|) ** (j + 1); 0 for no length."""
    length = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return [np.divide(v, length ** (j + 1), out=np.zeros_like(v), where=length > 0) for j in range(TERMS)]


def _summed_pushes(tracks: DataFrame, width: int, rate: float, weight: float) -> DataFrame:
    """(track, push): the pushes of ``tracks`` by each other, where none reaches its limit, from sums over all of them.

    Without the limit, a push sums (1 - a . b / |a| |b|) * (a - b) over all b, which splits into sums of b, of its direction and of
    their product: no pair is formed.
    """
    size = TERMS * width * (width + 1) + width + 1

    def partial(batches):
        total = np.zeros(size)
        for batch in batches:
            v = matrix(batch.column("vector"))
            if len(v):
                with_one = np.hstack([np.ones((len(v), 1)), v])
                total += np.concatenate([*((d.T @ with_one).ravel() for d in _directions(v)), with_one.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    vectors = tracks.select(TRACK, F.col("vector").cast("array<double>").alias("vector"))
    sums = np.zeros(size)
    for place, value in vectors.select("vector").mapInArrow(partial, "place int, value double").groupBy("place").agg(F.sum("value")).collect():
        sums[place] = value
    products, (n, *rest) = sums[: TERMS * width * (width + 1)].reshape(TERMS, width, width + 1), sums[TERMS * width * (width + 1) :]

    def push(batches):
        for batch in batches:
            v = matrix(batch.column("vector")) if batch.num_rows else np.zeros((0, width))
            similar = sum((-TINY) ** j * (d @ products[j]) for j, d in enumerate(_directions(v)))
            total = rate * weight / width * (n * v - np.array(rest) - v * similar[:, :1] + similar[:, 1:])
            yield pa.RecordBatch.from_arrays([batch.column(TRACK).cast(pa.int64()), list_column(total)], names=[TRACK, "push"])

    return vectors.mapInArrow(push, f"{TRACK} bigint, push array<double>")


def spread_step(tracks: DataFrame, width: int, rate: float, weight: float, rows: int | None = None) -> DataFrame:
    """Push track vectors apart: for every pair, rate * weight * (1 - cosine) / width times their gap.

    Each element of a pair's push is limited to 0.01. Exact over all pairs of tracks: tracks whose elements are so small that no two of
    them reach the limit push each other through sums over all of them; the others, and tracks of almost no length, meet all
    tracks pair by pair in blocks, cell by cell, and each cell returns one summed push per track.
    """
    reach = PUSH * width / (4.0 * abs(rate * weight)) * (1.0 - 1e-9) if rate * weight else math.inf
    largest = F.array_max(F.transform("vector", F.abs))
    length = F.sqrt(dot("vector", "vector"))
    alike = F.coalesce((largest <= reach) & ((length == 0) | (length >= SHORT)), F.lit(False))
    near, far = tracks.where(alike), tracks.where(~alike)
    pushes = _summed_pushes(near, width, rate, weight)
    if far.limit(1).count():
        pushes = pushes.unionByName(_cell_pushes(far, tracks, width, rate, weight, rows)).unionByName(_cell_pushes(near, far, width, rate, weight, rows))
    summed = pushes.groupBy(TRACK).agg(sum_of("push", width).alias("push"))
    moved = F.zip_with("vector", "push", lambda x, p: x + p)
    return tracks.join(summed.withColumn(TRACK, F.col(TRACK).cast("int")), TRACK).select(TRACK, moved.alias("vector"))


def fit_gradient(
    ratings: DataFrame,
    width: int = 3,
    steps: int = 20,
    rate: float = 0.001,
    reg: float = 0.04,
    diversity_weight: float = 0.0,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Factors after ``steps`` batch steps, with the pairwise spread of tracks if it has a weight."""
    ratings = stage(ratings, "ratings")
    users, tracks = start_factors(ratings, width, seed)
    user_steps, track_steps = Relay(ratings.sparkSession, "users"), Relay(ratings.sparkSession, "tracks")
    for _ in range(steps):
        moved_users, moved_tracks = gradient_step(ratings, users, tracks, width, rate, reg)
        users, tracks = user_steps.write(moved_users), track_steps.write(moved_tracks)
        if diversity_weight:
            tracks = track_steps.write(spread_step(tracks, width, rate, diversity_weight))
    return users, tracks


def fit_explicit(ratings: DataFrame, width: int = 3, iterations: int = 10, reg: float = 0.04, seed: int = 42) -> ALSModel:
    """The same objective solved in closed form; the penalty of a cell is half of ``reg``."""
    model = ALS(
        userCol=USER, itemCol=TRACK, ratingCol=RATING, rank=width, maxIter=iterations, regParam=reg / 2,
        coldStartStrategy="drop", seed=seed,
    )
    return model.fit(ratings)


def recommend(users: DataFrame, tracks: DataFrame, rated: DataFrame, k: int, low: float = 1.0, high: float = 5.0) -> DataFrame:
    """Best ``k`` unrated tracks per user, ordered by the raw score, which is then clipped to the scale."""
    best = best_unseen(users, tracks, k, seen=rated)
    return best.withColumn(PREDICTION, clip(F.col(PREDICTION), low, high))


def reconstructed_rows(users: DataFrame, tracks: DataFrame, width: int) -> DataFrame:
    """Per user: number, sum and sum of squares of the predictions for all tracks.

    A row sum is u . sum(v) and its squares are u^T (sum v v^T) u, so the full matrix is never formed.
    """
    total = tracks.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("vector")[i]).alias(f"s_{i}") for i in range(width)]).first()
    products = gram(tracks, width)
    as_array = lambda values: F.array(*[F.lit(float(x)) for x in values])
    through = F.array(*[dot("vector", as_array(products[i])) for i in range(width)])
    return users.select(
        USER,
        F.lit(total["n"]).cast("bigint").alias("n"),
        dot("vector", as_array([total[f"s_{i}"] for i in range(width)])).alias("row_sum"),
        dot("vector", through).alias("row_squares"),
    )


# --- weighted factorization -------------------------------------------------------------------


def solve_side(
    ratings: DataFrame,
    key: str,
    other: str,
    factors: DataFrame,
    width: int,
    missing: float,
    ridge: float,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Least squares per ``key``: missing cells enter through the Gram matrix, observed ones as sums."""
    rows = ratings.join(factors.select(other, F.col("vector").alias("v")), other).select(
        key, F.lit(1.0 - missing).alias("weight"), F.col(RATING).alias("target"), F.lit(1.0).alias("counts"), "v"
    )
    return solve_rows(rows, key, width, base=missing * gram(factors, width), ridge=ridge, hot=hot)


def fit_weighted(
    ratings: DataFrame, width: int = 3, iterations: int = 10, missing: float = 0.01, reg: float = 0.04, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Weighted factorization over all cells: observed ones weigh 1, the others have target 0 and weight ``missing``."""
    ratings = stage(ratings, "ratings")
    users, tracks = start_factors(ratings, width, seed)
    user_steps, track_steps = Relay(ratings.sparkSession, "users"), Relay(ratings.sparkSession, "tracks")
    tracks = track_steps.write(tracks)
    n_users = ratings.select(USER).distinct().count()
    n_tracks = tracks.count()
    hot_users, hot_tracks = hot_keys(ratings, USER), hot_keys(ratings, TRACK)
    for _ in range(iterations):
        users = user_steps.write(solve_side(ratings, USER, TRACK, tracks, width, missing, reg / 2 * n_tracks, hot_users))
        tracks = track_steps.write(solve_side(ratings, TRACK, USER, users, width, missing, reg / 2 * n_users, hot_tracks))
    return users, tracks


def weighted_loss(
    ratings: DataFrame, users: DataFrame, tracks: DataFrame, width: int, missing: float = 0.01, reg: float = 0.04
) -> float:
    """The loss over all cells, from sums over observed cells and two Gram matrices."""
    cells = with_factors(ratings, users, tracks).select(RATING, dot("u", "v").alias("p"))
    observed = cells.agg(
        F.sum((F.col(RATING) - F.col("p")) ** 2).alias("error"), F.sum(F.col("p") ** 2).alias("squares")
    ).first()
    gu, gv = gram(users, width), gram(tracks, width)
    everywhere = float((gu * gv).sum())
    ridge = reg / 2 * (tracks.count() * np.trace(gu) + users.count() * np.trace(gv))
    return float(observed["error"] + missing * (everywhere - observed["squares"]) + ridge)
