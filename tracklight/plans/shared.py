"""Tables that several queries read, written once per session and data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tracklight.models import baseline, content, factorization
from tracklight.runtime import stage
from tracklight.sources.tables import catalogue, train_test

TOP = 50
_tables: dict[tuple, object] = {}


def once(spark: SparkSession, folder: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _tables:
        _tables[key] = build()
    return _tables[key]


def random_lists(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = train_test(spark, folder)
    return once(spark, folder, "random", lambda: stage(baseline.recommend(train, TOP), "random"))


def encoded(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, int]:
    return once(spark, folder, "encoded", lambda: content.encode(catalogue(spark, folder)))


def mean_profiles(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = train_test(spark, folder)
    features, _, width = encoded(spark, folder)
    return once(spark, folder, "profiles", lambda: stage(content.profiles(train, features, width), "profiles"))


def cosine_lists(spark: SparkSession, folder: str, k: int = 25) -> DataFrame:
    train, test = train_test(spark, folder)
    _, vectors, _ = encoded(spark, folder)
    build = lambda: stage(content.recommend_similar(mean_profiles(spark, folder), vectors, train, test, k), "cosine")
    return once(spark, folder, f"cosine{k}", build)


def start_factors(spark: SparkSession, folder: str, width: int = 8) -> tuple[DataFrame, DataFrame]:
    train, _ = train_test(spark, folder)
    build = lambda: tuple(stage(side, "start") for side in factorization.start_factors(train, width))
    return once(spark, folder, f"start{width}", build)


def factor_lists(spark: SparkSession, folder: str) -> DataFrame:
    train, _ = train_test(spark, folder)
    users, tracks = start_factors(spark, folder)
    return once(spark, folder, "factors", lambda: stage(factorization.best_unseen(users, tracks, TOP, seen=train), "factors"))
