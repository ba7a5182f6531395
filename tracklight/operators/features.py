"""Track features and user profiles.

Features are kept as long rows ``(track, feature_idx, value)`` without zeros, so a wide tag
vocabulary costs no more than the tags that tracks really have. Dense vectors are built per track or
user only where a model needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklight.functions.transforms import parse_tags
from tracklight.operators.dictionary import build_dictionary, build_tag_dictionary
from tracklight.runtime import BROADCAST_BYTES, stage
from tracklight.schema import PLAYS, TRACK, USER

NUMERIC = ["size", "price"]
#: A dictionary's row in memory without its key.
KEY_BYTES = 128
COUNT = -1  # pseudo feature that every track has once


def min_max(column: str, low, high):
    """Scale to [0, 1]; a constant column becomes 0, null stays null."""
    c = F.col(column).cast("double")
    return F.when(c.isNotNull(), F.coalesce(F.try_divide(c - low, high - low), F.lit(0.0)))


def scale_numeric(catalogue: DataFrame, columns: list[str]) -> DataFrame:
    """``catalogue`` with the named columns scaled over the whole table."""
    limits = catalogue.agg(
        *[F.min(F.col(c).cast("double")).alias(f"low_{c}") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"high_{c}") for c in columns],
    )
    return catalogue.withColumns(
        {c: min_max(c, limits.select(f"low_{c}").scalar(), limits.select(f"high_{c}").scalar()) for c in columns}
    )


def _lookup(dictionary: DataFrame, column: str) -> DataFrame:
    """``(column, idx)`` to join to the catalogue's rows, which are never broadcast however small their files are: the
    dictionary is, or where it is large, neither."""
    keyed = dictionary.select(F.col("key").alias(column), "idx")
    rows, letters = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(column)), F.lit(0))).first()
    return F.broadcast(keyed) if rows * KEY_BYTES + 4 * letters <= BROADCAST_BYTES else keyed.hint("merge")


def genre_features(catalogue: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """One-hot genre as ``(track, idx, value)``; a null genre has no row."""
    genres = catalogue.where(F.col("genre").isNotNull())
    dictionary = dictionary if dictionary is not None else build_dictionary(genres, "genre")
    return genres.select(TRACK, "genre").join(_lookup(dictionary, "genre"), "genre").select(TRACK, "idx", F.lit(1.0).alias("value"))


def tag_features(catalogue: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Multi-hot tags as ``(track, idx, value)``; a repeated tag counts once."""
    dictionary = dictionary if dictionary is not None else build_tag_dictionary(catalogue)
    tags = catalogue.select(TRACK, F.explode(F.array_distinct(parse_tags("tags"))).alias("tag"))
    return tags.join(_lookup(dictionary, "tag"), "tag").select(TRACK, "idx", F.lit(1.0).alias("value"))


def feature_names(catalogue: DataFrame, numeric: list[str] | None = None) -> DataFrame:
    """``(feature_idx, feature)``: numeric columns, then genres, then tags."""
    numeric = NUMERIC if numeric is None else numeric
    genres = build_dictionary(catalogue.where(F.col("genre").isNotNull()), "genre")
    n_genres = genres.agg(F.count(F.lit(1))).scalar()
    tags = build_tag_dictionary(catalogue)
    base = F.lit(len(numeric))
    named = genres.select((base + F.col("idx")).alias("feature_idx"), F.concat(F.lit("genre_"), "key").alias("feature"))
    named = named.unionByName(
        tags.select((base + n_genres + F.col("idx")).cast("int").alias("feature_idx"), F.concat(F.lit("tag_"), "key").alias("feature"))
    )
    for i, c in enumerate(numeric):
        row = catalogue.sparkSession.range(1).select(F.lit(i).alias("feature_idx"), F.lit(c).alias("feature"))
        named = named.unionByName(row)
    return named


def track_features(catalogue: DataFrame, numeric: list[str] | None = None) -> DataFrame:
    """All non-zero features of all tracks as ``(track, feature_idx, value)``.

    Every track also has one COUNT row, so that sums over a user's tracks carry their number and a
    track without any feature is not lost.
    """
    numeric = NUMERIC if numeric is None else numeric
    genres = build_dictionary(catalogue.where(F.col("genre").isNotNull()), "genre")
    n_genres = genres.agg(F.count(F.lit(1))).scalar()
    scaled = scale_numeric(catalogue, numeric)
    pairs = F.array(*[F.struct(F.lit(i).alias("feature_idx"), F.col(c).alias("value")) for i, c in enumerate(numeric)])
    numbers = scaled.select(TRACK, F.inline(pairs)) if numeric else None
    base = F.lit(len(numeric))
    genre = genre_features(catalogue, genres).select(TRACK, (base + F.col("idx")).alias("feature_idx"), "value")
    tag = tag_features(catalogue).select(TRACK, (base + n_genres + F.col("idx")).cast("int").alias("feature_idx"), "value")
    features = genre.unionByName(tag)
    if numbers is not None:
        features = numbers.where(F.col("value").isNotNull() & (F.col("value") != 0)).unionByName(features)
    ones = catalogue.select(TRACK, F.lit(COUNT).alias("feature_idx"), F.lit(1.0).alias("value"))
    return features.unionByName(ones)


def feature_width(catalogue: DataFrame, numeric: list[str] | None = None) -> int:
    numeric = NUMERIC if numeric is None else numeric
    genres = catalogue.agg(F.countDistinct("genre")).first()[0]
    tags = catalogue.select(F.explode(parse_tags("tags")).alias("tag")).agg(F.countDistinct("tag")).first()[0]
    return len(numeric) + genres + tags


def to_vectors(long: DataFrame, key: str, width: int, idx: str = "feature_idx", value: str = "value") -> DataFrame:
    """Long rows to ``(key, vector)`` of ``width`` elements, zero where no row exists."""
    cells = F.map_from_entries(F.collect_list(F.struct(F.col(idx), F.col(value).cast("double"))))
    dense = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.col("cells")[i], F.lit(0.0)))
    return long.groupBy(key).agg(cells.alias("cells")).select(key, dense.alias("vector"))


def profile_means(train: DataFrame, features: DataFrame, weighted: bool = False, normalised: bool = False) -> DataFrame:
    """User profiles as ``(user, feature_idx, value)`` without zeros, plus the COUNT row of each user.

    Plain: the mean feature vector of the user's tracks. Weighted: every vector times its share of
    the user's plays, summed and divided by the number of tracks, or not divided if ``normalised``.
    The join and the sums are the only shuffles of the history; sums combine map-side, so a user
    with very many rows does not land in one task.
    """
    joined = train.select(USER, TRACK, PLAYS).join(features, TRACK)
    plays = F.col(PLAYS).cast("double")
    contribution = plays * F.col("value") if weighted else F.col("value")
    sums = joined.groupBy(USER, "feature_idx").agg(
        F.sum(contribution).alias("total"), F.sum(plays).alias("plays"), F.count(F.lit(1)).alias("n")
    )
    # a user has one row per feature here, so the window holds no more rows than there are features
    own = Window.partitionBy(USER)
    is_count = F.col("feature_idx") == COUNT
    sums = sums.withColumn("user_plays", F.max(F.when(is_count, F.col("plays"))).over(own)).withColumn(
        "user_rows", F.max(F.when(is_count, F.col("n"))).over(own)
    )
    divisor = F.lit(1.0)
    if weighted:
        divisor = divisor * F.col("user_plays")
    if not (weighted and normalised):
        divisor = divisor * F.col("user_rows")
    return sums.select(USER, "feature_idx", F.try_divide(F.col("total"), divisor).alias("value")).where(F.col("value") != 0)


def profile_medians(train: DataFrame, features: DataFrame) -> DataFrame:
    """Element-wise exact median of the feature vectors of a user's tracks, without zeros, plus COUNT rows.

    Equal values are counted first and the counts added up in value order, so a group holds distinct
    values of one feature and not rows, and passes through sorted without being held in memory.
    """
    joined = train.select(USER, TRACK).join(features, TRACK)
    # read three times below; without the write the join would run three times
    counts = stage(joined.groupBy(USER, "feature_idx", "value").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = counts.where(F.col("feature_idx") == COUNT).select(USER, F.col("n").alias("user_rows"))
    zeros = (
        counts.groupBy(USER, "feature_idx")
        .agg(F.sum("n").alias("nonzero"))
        .join(totals, USER)
        .where(F.col("nonzero") < F.col("user_rows"))
        .select(USER, "feature_idx", F.lit(0.0).alias("value"), (F.col("user_rows") - F.col("nonzero")).alias("n"))
    )
    cells = Window.partitionBy(USER, "feature_idx")
    upto = cells.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counts.unionByName(zeros).withColumn("upto", F.sum("n").over(upto)).withColumn("rows", F.sum("n").over(cells))
    holds = lambda place: (F.col("upto") > place) & (F.col("upto") - F.col("n") <= place)
    at = lambda place: F.max(F.when(holds(place), F.col("value")))
    median = (at(F.expr("(rows - 1) div 2")) + at(F.expr("rows div 2"))) / 2
    return counted.groupBy(USER, "feature_idx").agg(median.alias("value")).where(F.col("value") != 0)


def relevance(df: DataFrame) -> DataFrame:
    """``(user, track, score)``: each row's share of its user's plays."""
    totals = df.groupBy(USER).agg(F.sum(PLAYS).alias("total"))
    share = F.try_divide(F.col(PLAYS).cast("double"), F.col("total"))
    return df.select(USER, TRACK, PLAYS).join(totals, USER).select(USER, TRACK, share.alias("score"))


def attach_metadata(df: DataFrame, catalogue: DataFrame, columns: list[str]) -> DataFrame:
    return df.join(catalogue.select(TRACK, *columns), TRACK)


def interaction_blocks(train: DataFrame, width: int = 32) -> DataFrame:
    """The user-by-track 0/1 matrix, pivoted in blocks of ``width`` neighbouring track ids.

    Row (user, block) holds columns ``t0..``; blocks in which the user heard nothing have no row.
    """
    cells = train.select(
        USER,
        F.expr(f"{TRACK} div {width}").cast("int").alias("block"),
        F.pmod(F.col(TRACK), F.lit(width)).cast("int").alias("slot"),
        (F.col(PLAYS) > 0).cast("int").alias("heard"),
    )
    pivoted = cells.groupBy(USER, "block").pivot("slot", list(range(width))).agg(F.max("heard"))
    return pivoted.select(USER, "block", *[F.coalesce(F.col(str(i)), F.lit(0)).alias(f"t{i}") for i in range(width)])
