"""Random lists and readable playlists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.functions.hashing import uniform
from tracklight.operators.ranking import topk_per_user
from tracklight.operators.splits import draw_unseen
from tracklight.runtime import BROADCAST_BYTES
from tracklight.schema import PREDICTION, RANK, TRACK, USER

#: A track with its name and artist in memory.
NAME_BYTES = 128


def recommend(train: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """``k`` random unseen tracks per user with random scores, best score first."""
    drawn = draw_unseen(train, k, seed).select(USER, TRACK, uniform(F.col(USER), F.col(TRACK), "score", seed).alias(PREDICTION))
    return topk_per_user(drawn, k)


def playlist(recs: DataFrame, catalogue: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Recommended tracks with their original id, name and artist, in rank order per user."""
    named = recs.select(USER, RANK, TRACK, PREDICTION)
    # files of names are much smaller than the names: beyond the limit neither table may be broadcast through the driver
    fits = catalogue.count() * NAME_BYTES <= BROADCAST_BYTES
    lookup = lambda df: df if fits else df.hint("merge")
    if dictionary is not None:
        named = named.join(lookup(dictionary.select(F.col("idx").alias(TRACK), F.col("key").alias("original_id"))), TRACK)
    return named.join(lookup(catalogue.select(TRACK, "name", "artist")), TRACK)
