"""Histories and catalogues from the order tables: a customer listens to the parts it ordered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklight.operators.filters import active_users
from tracklight.operators.splits import split_per_user
from tracklight.runtime import by_rows, stage
from tracklight.schema import PLAYS, TRACK, USER


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_staged: dict[tuple, DataFrame] = {}


def _once(spark: SparkSession, folder: str, name: str, build, **options) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _staged:
        _staged[key] = stage(build(), name, **options)
    return _staged[key]


def collect_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and part, from one join of the two largest tables."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").cast("int").alias(USER))
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", F.col("l_partkey").cast("int").alias(TRACK), "l_quantity"
    )
    rows = lines.count()
    joined = by_rows(orders, rows, "o_orderkey").join(by_rows(lines, rows, "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    # left to adaptive execution, tasks get 64 MB of compressed rows each, whose groups take ten times that
    pairs = by_rows(joined.select(USER, TRACK, "l_quantity"), rows, USER, TRACK)
    return pairs.groupBy(USER, TRACK).agg(F.sum("l_quantity").cast("bigint").alias(PLAYS))


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """The indexed interactions, written once per session: counts and filters read them several times."""
    return _once(spark, folder, "interactions", lambda: collect_interactions(spark, folder))


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.select(
        F.col("p_partkey").cast("int").alias(TRACK),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("artist"),
        F.col("p_type").alias("genre"),
        F.concat_ws(", ", F.split("p_name", " ")).alias("tags"),
        F.col("p_size").cast("double").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def raw_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """The history with text ids, as it arrives before indexing."""
    return interactions(spark, folder).select(
        F.concat(F.lit("T"), TRACK).alias(TRACK), F.concat(F.lit("U"), USER).alias(USER), F.col(PLAYS).cast("int").alias(PLAYS)
    )


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Active users' history with its ``split``, written once per session and read by every model."""
    build = lambda: split_per_user(stage(active_users(interactions(spark, folder)), "active"))
    return _once(spark, folder, "history", build, partition_by="split")


def train_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    split = history(spark, folder)
    keep = [USER, TRACK, PLAYS]
    return split.where(F.col("split") == "train").select(*keep), split.where(F.col("split") == "test").select(*keep)
