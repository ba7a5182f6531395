"""Column names and declared schemas of the tables the package reads and writes."""

from pyspark.sql import types as T

USER, TRACK, PLAYS = "user_id", "track_id", "playcount"
PREDICTION, RANK = "prediction", "rank"

RAW_INTERACTIONS = T.StructType(
    [
        T.StructField(TRACK, T.StringType()),
        T.StructField(USER, T.StringType()),
        T.StructField(PLAYS, T.IntegerType()),
    ]
)

INTERACTIONS = T.StructType(
    [
        T.StructField(USER, T.IntegerType()),
        T.StructField(TRACK, T.IntegerType()),
        T.StructField(PLAYS, T.LongType()),
    ]
)

# Both columns are text on disk: the index follows a blank and is trimmed before the cast.
DICTIONARY = T.StructType([T.StructField("key", T.StringType()), T.StructField("idx", T.StringType())])
