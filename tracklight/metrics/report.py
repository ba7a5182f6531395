"""Summary tables over algorithms and list lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.metrics.diversity import collaborative_diversity, novelty
from tracklight.metrics.ranking import ranking_at_k
from tracklight.operators.skew import union_all

KS = [10, 25, 50]


def metrics_by_k(recs: DataFrame, truth: DataFrame, train: DataFrame, ks: list[int] | None = None) -> DataFrame:
    """Ranking metrics, novelty and diversity for every k, from one ranked list."""
    ks = ks or KS
    return (
        ranking_at_k(recs, truth, ks)
        .join(novelty(recs, train, ks), "k")
        .join(collaborative_diversity(recs, train, ks), "k")
    )


def metric_bundle(recs: DataFrame, truth: DataFrame, train: DataFrame, k: int) -> DataFrame:
    return metrics_by_k(recs, truth, train, [k]).drop("k")


def summary_rows(algo: str, metrics: DataFrame | None, data: DataFrame, ks: list[int] | None = None) -> DataFrame:
    """``(data, algo, k, metrics...)``; ``data`` is the number of rows of the data set.

    Without metrics the rows hold only the labels and the metric columns come out null after a union.
    """
    rows = data.agg(F.count(F.lit(1))).scalar()
    if metrics is None:
        spark = data.sparkSession
        metrics = union_all([spark.range(1).select(F.lit(k).alias("k")) for k in (ks or KS)])
    rest = [c for c in metrics.columns if c != "k"]
    return metrics.select(rows.alias("data"), F.lit(algo).alias("algo"), "k", *rest)


def summary(rows: list[DataFrame]) -> DataFrame:
    """All summary rows ordered by algorithm and k."""
    total = rows[0]
    for r in rows[1:]:
        total = total.unionByName(r, allowMissingColumns=True)
    return total.orderBy("algo", "k")


def algo_k_series(summary_table: DataFrame, metric: str, ks: list[int] | None = None) -> DataFrame:
    """One row per algorithm with the metric at each k: the data of a line per algorithm."""
    ks = ks or KS
    wide = summary_table.groupBy("algo").pivot("k", ks).agg(F.first(metric))
    return wide.select("algo", *[F.col(str(k)).alias(f"k{k}") for k in ks])
