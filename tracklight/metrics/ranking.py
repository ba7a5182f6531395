"""Ranking metrics of recommendation lists, for several list lengths in one pass.

``recs`` holds ``(user, track, rank)`` with ranks 1..n, ``truth`` the held-out ``(user, track,
playcount)`` rows. Hits are found by an equi-join on (user, track), which no single key can skew, and
only hits, never whole histories, are gathered per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklight.runtime import broadcast_if_small
from tracklight.schema import PLAYS, RANK, TRACK, USER


def _discounted_ranks(upto):
    """1 / log2(i + 1) summed over i = 1..upto, where ``upto`` is at most k."""
    ranks = F.sequence(F.lit(1).cast("bigint"), upto)
    return F.aggregate(ranks, F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + F.lit(1.0)))


def _total(array, value):
    """Sum of ``value(element, place)`` over a short array."""
    return F.aggregate(F.transform(array, value), F.lit(0.0), lambda s, x: s + x)


PIECE = 4096


def flat_ideals(truth: DataFrame) -> DataFrame:
    """``(user, ideal)``: 1 / max(log2 i, 1) summed over i = 1..n for a user with n rows.

    The sum depends on n alone: whole pieces of ranks are added up once, the rest in the user's row.
    """
    counts = truth.groupBy(USER).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    discount = lambda first, last: F.when(
        last >= first, F.aggregate(F.sequence(first, last), F.lit(0.0), lambda s, i: s + 1.0 / F.greatest(F.log2(i.cast("double")), F.lit(1.0)))
    ).otherwise(0.0)
    pieces = truth.sparkSession.range(most // PIECE + 1).select(
        F.col("id").alias("piece"), discount(F.col("id") * PIECE + 1, (F.col("id") + 1) * PIECE).alias("own")
    )
    # one row per 4,096 ranks of the longest history
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("piece", F.coalesce(F.sum("own").over(before), F.lit(0.0)).alias("whole"))
    placed = counts.withColumn("piece", F.expr(f"n div {PIECE}")).join(broadcast_if_small(pieces, most // PIECE + 1, 16), "piece")
    return placed.select(USER, (F.col("whole") + discount(F.col("piece") * PIECE + 1, F.col("n"))).alias("ideal"))


def user_metrics(recs: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """One row per (user, k) for users with both recommendations and relevant tracks.

    Per user three short rows meet: the hits of the list, the size of the truth and its most played
    tracks, each at most max(ks) long. The relevance of a track is its share of the user's held-out
    plays; the graded NDCG is a ratio in which the plays themselves give the same value.
    """
    top = max(ks)
    held = truth.select(USER, TRACK, F.col(PLAYS).cast("double").alias("plays"))
    listed = recs.where(F.col(RANK) <= top).select(USER, TRACK, F.col(RANK).cast("double").alias("rank"))
    hit = F.when(F.col("plays").isNotNull(), F.struct("rank", "plays"))
    found = (
        listed.join(held, [USER, TRACK], "left")
        .groupBy(USER)
        .agg(F.count(F.lit(1)).alias("n_recs"), F.array_sort(F.collect_list(hit)).alias("all_hits"))
    )
    sizes = truth.groupBy(USER).agg(F.count(F.lit(1)).alias("n_truth"))
    by_plays = Window.partitionBy(USER).orderBy(F.col("plays").desc(), TRACK)
    best = held.withColumn("place", F.row_number().over(by_plays)).where(F.col("place") <= top)
    best = best.groupBy(USER).agg(F.sort_array(F.collect_list("plays"), asc=False).alias("best"))

    each_k = F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    users = found.join(sizes, USER).join(best, USER).select("*", each_k)
    users = users.withColumn("n_list", F.least("n_recs", F.col("k").cast("bigint")))
    users = users.withColumn("found", F.filter("all_hits", lambda h: h["rank"] <= F.col("k")))
    hits, cut = F.size("found").cast("bigint"), F.least("n_truth", F.col("k").cast("bigint"))
    graded = _total("found", lambda h, i: h["plays"] / F.log2(h["rank"] + 1.0))
    ideal = _total(F.slice("best", 1, F.col("n_list").cast("int")), lambda p, i: p / F.log2(i + 2.0))
    precisions = _total("found", lambda h, i: (i + 1.0) / h["rank"])
    return users.select(
        USER,
        "k",
        "n_list",
        "n_truth",
        hits.alias("hits"),
        (hits / F.col("n_list")).alias("precision_list"),
        (hits / F.col("k")).alias("precision_at_k"),
        (hits / F.col("n_truth")).alias("recall"),
        (hits > 0).cast("double").alias("hit"),
        (_total("found", lambda h, i: 1.0 / F.log2(h["rank"] + 1.0)) / _discounted_ranks(cut)).alias("ndcg"),
        F.coalesce(F.try_divide(graded, ideal), F.lit(0.0)).alias("ndcg_graded"),
        _total("found", lambda h, i: 1.0 / F.greatest(F.log2(h["rank"]), F.lit(1.0))).alias("dcg_flat"),
        (precisions / F.col("n_truth")).alias("ap"),
        (precisions / cut).alias("ap_at_k"),
    )


def ranking_summary(recs: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """Per k: the mean over users of list-length precision, recall, graded NDCG, hit and AP."""
    return user_metrics(recs, truth, ks).groupBy("k").agg(
        F.avg("precision_list").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("ndcg_graded").alias("ndcg"),
        F.avg("hit").alias("hit"),
        F.avg("ap").alias("map"),
    )


def list_analysis(recs: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """Per k: list-length precision, recall, hit and an NDCG against the whole truth list.

    In this NDCG the first two ranks weigh the same.
    """
    per_user = user_metrics(recs, truth, ks).join(flat_ideals(truth), USER)
    return per_user.groupBy("k").agg(
        F.avg("precision_list").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("hit").alias("hit"),
        F.avg(F.col("dcg_flat") / F.col("ideal")).alias("ndcg"),
    )


def ranking_at_k(recs: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """Per k: precision, recall, NDCG and both MAPs over common users, and hit rate over all test users.

    Every k has a row: without common users the means are null and the hit rate is 0, without test users all are null.
    """
    per_user = user_metrics(recs, truth, ks)
    test_users = truth.agg(F.countDistinct(USER)).scalar()
    asked = truth.sparkSession.createDataFrame([(k,) for k in sorted(set(ks))], "k int")
    means = per_user.groupBy("k").agg(
        F.avg("precision_at_k").alias("precision_at_k"),
        F.avg("recall").alias("recall_at_k"),
        F.sum("hit").alias("users_hit"),
        F.avg("ndcg").alias("ndcg_at_k"),
        F.avg("ap").alias("map"),
        F.avg("ap_at_k").alias("map_at_k"),
    )
    return F.broadcast(asked).join(means, "k", "left").select(
        "k",
        "precision_at_k",
        "recall_at_k",
        F.try_divide(F.coalesce("users_hit", F.lit(0.0)), test_users).alias("hit_at_k"),
        "ndcg_at_k",
        "map",
        "map_at_k",
    )


def hit_at_k(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Share of all test users with at least one relevant recommendation."""
    listed = recs.where(F.col(RANK) <= k).select(USER, TRACK)
    hit_users = truth.select(USER, TRACK).join(listed, [USER, TRACK], "left_semi").agg(F.countDistinct(USER)).scalar()
    return truth.agg(F.countDistinct(USER).alias("users")).select(
        F.coalesce(F.try_divide(hit_users.cast("double"), F.col("users")), F.lit(0.0)).alias("hit_at_k")
    )


def precision_recall(recs: DataFrame, truth: DataFrame, train: DataFrame, k: int) -> DataFrame:
    """Mean list precision and recall over test users that also occur in train.

    Users without any recommendation count with 0.
    """
    listed = recs.where(F.col(RANK) <= k).select(USER, TRACK).distinct()
    hits = listed.join(truth.select(USER, TRACK), [USER, TRACK]).groupBy(USER).agg(F.count(F.lit(1)).alias("hits"))
    sizes = listed.groupBy(USER).agg(F.count(F.lit(1)).alias("n_recs"))
    users = truth.groupBy(USER).agg(F.count(F.lit(1)).alias("n_truth"))
    users = users.join(train.select(USER).distinct(), USER, "left_semi")
    joined = users.join(sizes, USER, "left").join(hits, USER, "left").na.fill(0)
    return joined.agg(
        F.coalesce(F.avg(F.coalesce(F.try_divide("hits", "n_recs"), F.lit(0.0))), F.lit(0.0)).alias("precision"),
        F.coalesce(F.avg(F.col("hits") / F.col("n_truth")), F.lit(0.0)).alias("recall"),
    )
