"""Errors of predicted ratings and the rank error of plays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.operators.ranking import percent_rank
from tracklight.operators.skew import HOT_ROWS
from tracklight.schema import PLAYS, PREDICTION


def rating_errors(df: DataFrame, rating: str = PLAYS, prediction: str = PREDICTION) -> DataFrame:
    gap = F.col(rating).cast("double") - F.col(prediction)
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))


def roem(predictions: DataFrame, rating: str = PLAYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Play-weighted mean percent rank of the predictions; 0 is best."""
    ranked = percent_rank(predictions, hot_rows=hot_rows)
    weighted = F.sum(F.col(rating) * F.col("percent_rank"))
    return ranked.agg(F.try_divide(weighted, F.sum(F.col(rating).cast("double"))).alias("roem"))
