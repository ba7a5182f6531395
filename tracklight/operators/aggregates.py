"""Table statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklight.schema import PREDICTION, TRACK, USER

LEAF_VALUES = 100_000
ACCURACY = 10_000


def dataset_stats(df: DataFrame) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(USER).alias("n_users"),
        F.countDistinct(TRACK).alias("n_items"),
    )
    possible = F.col("n_users") * F.col("n_items")
    return counts.select(
        "*",
        possible.alias("n_possible"),
        (possible - F.col("n_rows")).alias("n_zero"),
        (1 - F.try_divide(F.col("n_rows").cast("double"), possible)).alias("sparsity"),
        F.try_divide(F.col("n_rows").cast("double"), possible).alias("density"),
    )


def split_overlap(split: DataFrame) -> DataFrame:
    """Users in train, in test and in both, from one pass over the split table."""
    per_user = split.groupBy(USER).agg(
        F.max((F.col("split") == "train").cast("int")).alias("in_train"),
        F.max((F.col("split") == "test").cast("int")).alias("in_test"),
    )
    return per_user.agg(
        F.sum("in_train").cast("bigint").alias("train_users"),
        F.sum("in_test").cast("bigint").alias("test_users"),
        F.sum(F.col("in_train") * F.col("in_test")).cast("bigint").alias("common_users"),
    )


def candidate_counts(train: DataFrame) -> DataFrame:
    """Per user: tracks that exist, tracks seen, tracks left to recommend. No pair is formed."""
    pairs = train.select(USER, TRACK).distinct()
    n_tracks = train.select(TRACK).agg(F.countDistinct(TRACK).alias("n")).scalar()
    seen = pairs.groupBy(USER).agg(F.count(F.lit(1)).alias("n_seen"))
    return seen.select(USER, n_tracks.alias("n_candidates"), "n_seen", (n_tracks - F.col("n_seen")).alias("n_unseen"))


def _order_statistics(df: DataFrame, column: str, positions: list[int], rows: int, leaf: int, reach: float) -> dict:
    """Values at the given 0-based positions in sorted order.

    Approximate quantiles on both sides of a position bracket its value; exact counts tell whether the
    value is an end of the bracket or lies inside, and only the rows inside are looked at again.
    """
    c = F.col(column)
    if rows <= leaf:
        values = sorted(r[0] for r in df.select(column).collect())
        return {p: float(values[p]) for p in positions}
    ends = [end for p in positions for end in (max(0.0, p / rows - reach), min(1.0, p / rows + reach))]
    cuts = [float(v) for v in df.agg(F.percentile_approx(column, ends, ACCURACY)).first()[0]]
    brackets = {p: (cuts[2 * i], cuts[2 * i + 1]) for i, p in enumerate(positions)}
    counts = df.agg(
        *[
            F.count_if(test).alias(f"{name}_{p}")
            for p, (low, high) in brackets.items()
            for name, test in (
                ("below", c < low),
                ("low", c == low),
                ("inside", (c > low) & (c < high)),
                ("high", (c == high) & F.lit(high > low)),
            )
        ]
    ).first()
    found, inside, missed = {}, {}, []
    for p, (low, high) in brackets.items():
        below, at_low, between, at_high = (counts[f"{n}_{p}"] for n in ("below", "low", "inside", "high"))
        place = p - below
        if place < 0 or place >= at_low + between + at_high:
            missed.append(p)
        elif place < at_low:
            found[p] = low
        elif place < at_low + between:
            inside[p] = (place - at_low, between)
        else:
            found[p] = high
    if missed:
        found.update(_order_statistics(df, column, missed, rows, leaf, 4 * reach))
    between = {p: (c > brackets[p][0]) & (c < brackets[p][1]) for p in inside}
    if inside and sum(n for _, n in inside.values()) <= leaf:
        values = sorted(r[0] for r in df.where(reduce(Column.__or__, between.values())).select(column).collect())
        for p, (place, _) in inside.items():
            low, high = brackets[p]
            found[p] = float([v for v in values if low < v < high][place])
        return found
    for p, (place, n) in inside.items():
        found[p] = _order_statistics(df.where(between[p]), column, [place], n, leaf, reach)[place]
    return found


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float], leaf_values: int = LEAF_VALUES) -> list:
    """Exact quantiles with linear interpolation, without holding a column in one buffer."""
    df = df.where(F.col(column).isNotNull())
    rows = df.count()
    if not rows:
        return [None] * len(probabilities)
    places = [p * (rows - 1) for p in probabilities]
    positions = sorted({int(x) for x in places} | {min(int(x) + 1, rows - 1) for x in places})
    values = _order_statistics(df, column, positions, rows, leaf_values, 2.0 / ACCURACY)
    results = []
    for x in places:
        low = values[int(x)]
        results.append(low + (values[min(int(x) + 1, rows - 1)] - low) * (x - int(x)))
    return results


def prediction_stats(df: DataFrame, leaf_values: int = LEAF_VALUES) -> DataFrame:
    """Count, mean, spread, quartiles, extremes, zeros and distinct values of the predictions."""
    q25, q50, q75 = exact_quantiles(df, PREDICTION, [0.25, 0.5, 0.75], leaf_values)
    p = F.col(PREDICTION)
    return df.agg(
        F.count(p).alias("n"),
        F.avg(p).alias("mean"),
        F.stddev_samp(p).alias("std"),
        F.min(p).alias("min"),
        F.lit(q25).cast("double").alias("q25"),
        F.lit(q50).cast("double").alias("q50"),
        F.lit(q75).cast("double").alias("q75"),
        F.max(p).alias("max"),
        F.count_if(p == 0).alias("n_zero"),
        F.count_if(p != 0).alias("n_nonzero"),
        (100.0 * F.try_divide(F.count_if(p == 0), F.count(p))).alias("pct_zero"),
        (100.0 * F.try_divide(F.count_if(p != 0), F.count(p))).alias("pct_nonzero"),
        F.countDistinct(p).alias("n_distinct"),
    )
