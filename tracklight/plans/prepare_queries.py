"""Queries over sources, filters, encodings, joins, aggregates, windows, sets and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklight.functions import transforms, vectors
from tracklight.functions.hashing import uniform
from tracklight.metrics.diversity import list_pairs
from tracklight.models import baseline
from tracklight.operators import aggregates, dictionary, features, filters, ranking, skew, splits
from tracklight.plans import shared
from tracklight.plans.checks import hash48, sql
from tracklight.runtime import new_path, stage
from tracklight.schema import INTERACTIONS, PLAYS, PREDICTION, RANK, RAW_INTERACTIONS, TRACK, USER
from tracklight.sources import io
from tracklight.sources.tables import catalogue, history, interactions, raw_interactions, table, train_test

QUERIES: dict[str, tuple] = {}
PAIR = "user_id || '-' || track_id"


def query(name: str, check: str | None = None):
    def register(build):
        QUERIES[name] = (build, check)
        return build

    return register


def long(n: str = "n"):
    return F.count(F.lit(1)).cast("bigint").alias(n)


# --- sources and sinks ------------------------------------------------------------------------

RAW = "SELECT 'T' || track_id AS track_id, 'U' || user_id AS user_id, CAST(playcount AS INTEGER) AS playcount FROM inter"


@query("scan_raw_csv", sql(RAW, "inter"))
def scan_raw_csv(spark, folder):
    path = new_path(spark, "raw")
    raw_interactions(spark, folder).write.option("header", True).csv(path)
    return io.read_raw_csv(spark, path, RAW_INTERACTIONS)


@query("scan_tsv_inferred", sql("SELECT user_id, track_id, CAST(playcount AS INTEGER) AS playcount FROM inter", "inter"))
def scan_tsv_inferred(spark, folder):
    path = new_path(spark, "inferred")
    io.write_tsv(interactions(spark, folder), path)
    return io.read_tsv_inferred(spark, path)


@query("scan_tsv_typed_limit", sql("SELECT * FROM inter ORDER BY user_id, track_id LIMIT 1000", "inter"))
def scan_tsv_typed_limit(spark, folder):
    path = new_path(spark, "typed")
    io.write_tsv(interactions(spark, folder), path)
    return io.read_tsv(spark, path, INTERACTIONS, limit=1000, order=[USER, TRACK])


@query("sink_tsv", sql("SELECT split, user_id, track_id, playcount FROM splits", "splits"))
def sink_tsv(spark, folder):
    path = new_path(spark, "split")
    io.write_tsv(history(spark, folder), path, partition_by="split")
    return io.read_tsv(spark, path, history(spark, folder).schema)


@query("scan_dictionary", sql("SELECT key, idx FROM tagdict", "tagdict"))
def scan_dictionary(spark, folder):
    path = new_path(spark, "dictionary")
    io.write_dictionary(dictionary.build_tag_dictionary(catalogue(spark, folder)), path)
    return io.read_dictionary(spark, path)


REVERSE = "SELECT i.track_id, d.key AS original_id, i.playcount FROM (SELECT track_id, sum(playcount)::BIGINT AS playcount FROM active GROUP BY 1) i JOIN d ON d.idx = i.track_id"


@query(
    "scan_dictionary_reverse",
    sql(
        REVERSE,
        "active",
        d="SELECT 'T' || v AS key, CAST(row_number() OVER (ORDER BY substr(md5('T' || v), 1, 3), 'T' || v) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT track_id AS v FROM inter)",
    ),
)
def scan_dictionary_reverse(spark, folder):
    path = new_path(spark, "dictionary")
    io.write_dictionary(dictionary.build_dictionary(raw_interactions(spark, folder), TRACK), path)
    plays = filters.active_users(interactions(spark, folder)).groupBy(TRACK).agg(F.sum(PLAYS).alias(PLAYS))
    return dictionary.original_ids(plays, TRACK, io.read_dictionary(spark, path), "original_id").select(TRACK, "original_id", PLAYS)


def six_dictionaries(spark, folder) -> DataFrame:
    raw, cat = raw_interactions(spark, folder), catalogue(spark, folder)
    sources = [(raw, USER), (raw, TRACK), (cat, "name"), (cat, "artist"), (cat, "genre")]
    named = [dictionary.build_dictionary(df, c).withColumn("kind", F.lit(c)) for df, c in sources]
    return skew.union_all([*named, dictionary.build_tag_dictionary(cat).withColumn("kind", F.lit("tag"))])


def _dict_sql(kind: str, source: str, column: str) -> str:
    return f"SELECT v AS key, CAST(row_number() OVER (ORDER BY substr(md5(v), 1, 3), v) - 1 AS INTEGER) AS idx, '{kind}' AS kind FROM (SELECT DISTINCT {column} AS v FROM {source})"


SIX = " UNION ALL ".join(
    [
        _dict_sql("user_id", "inter", "'U' || user_id"),
        _dict_sql("track_id", "inter", "'T' || track_id"),
        _dict_sql("name", "cat", "name"),
        _dict_sql("artist", "cat", "artist"),
        _dict_sql("genre", "cat", "genre"),
        _dict_sql("tag", "tagrows", "tag"),
    ]
)
QUERIES["build_dictionary"] = (six_dictionaries, sql(SIX, "inter", "tagrows"))


@query("sink_dictionary", sql("SELECT kind, count(*) AS n, CAST(min(idx) AS INTEGER) AS low, CAST(max(idx) AS INTEGER) AS high FROM (" + SIX + ") GROUP BY 1", "inter", "tagrows"))
def sink_dictionary(spark, folder):
    path = new_path(spark, "dictionaries")
    kinds = stage(six_dictionaries(spark, folder), "dictionaries", partition_by="kind")
    stored = []
    for kind in ("user_id", "track_id", "name", "artist", "genre", "tag"):
        io.write_dictionary(kinds.where(F.col("kind") == kind), f"{path}/{kind}")
        stored.append(io.read_dictionary(spark, f"{path}/{kind}").withColumn("kind", F.lit(kind)))
    return skew.union_all(stored).groupBy("kind").agg(long(), F.min("idx").alias("low"), F.max("idx").alias("high"))


@query("preview", sql("SELECT * FROM cat ORDER BY track_id LIMIT 5", "cat"))
def preview(spark, folder):
    columns, rows = io.preview(catalogue(spark, folder), 5, [TRACK])
    return rows.select(*columns)


# --- projections, filters, scalar transforms --------------------------------------------------


@query("project_reorder", sql("SELECT user_id, track_id, playcount FROM inter", "inter"))
def project_reorder(spark, folder):
    return interactions(spark, folder).select(PLAYS, TRACK, USER).select(USER, TRACK, PLAYS)


@query("project_rename", sql('SELECT user_id AS "user", track_id AS item, playcount FROM inter', "inter"))
def project_rename(spark, folder):
    return interactions(spark, folder).withColumnsRenamed({USER: "user", TRACK: "item"})


@query("project_drop_optional", sql("SELECT track_id, genre, size, price FROM cat", "cat"))
def project_drop_optional(spark, folder):
    return catalogue(spark, folder).drop("name", "artist", "tags", "preview_url", "external_id")


@query("cast_ids", sql("SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(track_id AS VARCHAR) AS track_id, CAST(rank AS DOUBLE) AS rank FROM recs", "recs"))
def cast_ids(spark, folder):
    lists = shared.random_lists(spark, folder)
    return lists.select(F.col(USER).cast("string"), F.col(TRACK).cast("string"), F.col(RANK).cast("double"))


@query("filter_active_users", sql("SELECT * FROM active", "active"))
def filter_active_users(spark, folder):
    return filters.active_users(interactions(spark, folder))


@query("filter_in_set", sql("SELECT * FROM test WHERE track_id IN (SELECT track_id FROM train)", "train", "test"))
def filter_in_set(spark, folder):
    train, test = train_test(spark, folder)
    return filters.keep_in(test, train.select(TRACK).distinct(), TRACK)


@query("filter_one_user", sql("SELECT * FROM train WHERE user_id = (SELECT user_id FROM train GROUP BY 1 ORDER BY sum(playcount) DESC, user_id LIMIT 1)", "train"))
def filter_one_user(spark, folder):
    """The rows of the user with the most plays."""
    train, _ = train_test(spark, folder)
    totals = train.groupBy(USER).agg(F.sum(PLAYS).alias("plays"))
    return train.where(F.col(USER) == totals.agg(F.max_by(F.col(USER), F.struct("plays", -F.col(USER)))).scalar())


@query("filter_null", sql("SELECT t.user_id, t.track_id, t.playcount FROM test t LEFT JOIN (SELECT DISTINCT track_id, 1 AS trained FROM train) k ON k.track_id = t.track_id WHERE k.trained IS NULL", "train", "test"))
def filter_null(spark, folder):
    """Test rows whose track train lacks, by an outer join and a null test."""
    train, test = train_test(spark, folder)
    trained = train.select(TRACK).distinct().withColumn("trained", F.lit(1))
    return test.join(trained, TRACK, "left").where(F.col("trained").isNull()).select(USER, TRACK, PLAYS)


@query("binarise_plays", sql("SELECT user_id, track_id, CAST(1 AS BIGINT) AS playcount FROM train", "train"))
def binarise_plays(spark, folder):
    return train_test(spark, folder)[0].withColumn(PLAYS, F.lit(1).cast("bigint"))


@query("heard_flag", sql("SELECT user_id, track_id, CASE WHEN playcount > 0 THEN 1 ELSE 0 END AS heard FROM train UNION ALL SELECT user_id, track_id, 0 FROM drawn", "train", "drawn"))
def heard_flag(spark, folder):
    pairs = splits.add_negatives(train_test(spark, folder)[0], shared.TOP)
    return pairs.select(USER, TRACK, transforms.heard(PLAYS).alias("heard"))


@query("confidence_log", sql("SELECT user_id, track_id, round(1 + 1.0::DOUBLE * ln(1 + playcount), 6) AS confidence FROM train", "train"))
def confidence_log(spark, folder):
    train, _ = train_test(spark, folder)
    return train.select(USER, TRACK, F.round(transforms.confidence(F.col(PLAYS), 1.0), 6).alias("confidence"))


@query(
    "weight_observed",
    sql(
        "SELECT user_id, track_id, CASE WHEN playcount > 0 THEN 1.0::DOUBLE ELSE 0.01::DOUBLE END AS weight FROM (SELECT user_id, track_id, playcount FROM train UNION ALL SELECT user_id, track_id, 0 FROM drawn)",
        "train",
        "drawn",
    ),
)
def weight_observed(spark, folder):
    pairs = splits.add_negatives(train_test(spark, folder)[0], shared.TOP)
    return pairs.select(USER, TRACK, transforms.cell_weight(PLAYS).alias("weight"))


@query("clip_prediction", sql("SELECT user_id, track_id, least(greatest(prediction, 1.0), 2.5)::DOUBLE AS prediction FROM mfrecs", "mfrecs"))
def clip_prediction(spark, folder):
    lists = shared.factor_lists(spark, folder)
    return lists.select(USER, TRACK, transforms.clip(F.col(PREDICTION), 1.0, 2.5).alias(PREDICTION))


@query("relevance_share", sql("SELECT user_id, track_id, round(score, 9) AS score FROM shares", "shares"))
def relevance_share(spark, folder):
    shares = features.relevance(train_test(spark, folder)[1])
    return shares.select(USER, TRACK, F.round("score", 9).alias("score"))


@query("sample_bernoulli", sql(f"SELECT * FROM inter WHERE {hash48(PAIR + " || '-sample-0'")} < 0.005 * 281474976710656", "inter"))
def sample_bernoulli(spark, folder):
    return filters.sample_bernoulli(interactions(spark, folder), 0.005, 0)


@query("subset_first_users", sql("SELECT DISTINCT user_id FROM test ORDER BY user_id LIMIT 100", "test"))
def subset_first_users(spark, folder):
    return filters.first_users(train_test(spark, folder)[1], 100)


@query("parse_tags", sql("SELECT track_id, tag FROM tagrows", "tagrows"))
def parse_tags(spark, folder):
    return catalogue(spark, folder).select(TRACK, F.explode(transforms.parse_tags("tags")).alias("tag"))


NEXT = "FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"


def neighbours(spark, folder) -> DataFrame:
    """Every vector beside the one with the next id."""
    vecs = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    following = vecs.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return vecs.join(following, "vec_id")


def _kernel(name: str, function, text: str) -> None:
    build = lambda spark, folder: neighbours(spark, folder).select("vec_id", F.round(function("a", "b"), 6).alias("value"))
    QUERIES[name] = (build, f"SELECT a.vec_id, round({text}, 6) AS value {NEXT}")


DOUBLES = "list_transform(a.embedding, lambda x: x::DOUBLE), list_transform(b.embedding, lambda x: x::DOUBLE)"
_kernel("dot_product", vectors.dot, f"list_dot_product({DOUBLES})")
_kernel("cosine", vectors.cosine_similarity, f"list_cosine_similarity({DOUBLES})")
_kernel("euclidean", vectors.euclidean, f"list_distance({DOUBLES})")


@query("norm", "SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS value FROM embeddings")
def norm(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.round(vectors.norm("embedding"), 6).alias("value"))


# --- indexing and encoding --------------------------------------------------------------------


@query("build_tag_dictionary", sql("SELECT key, idx FROM tagdict", "tagdict"))
def build_tag_dictionary(spark, folder):
    return dictionary.build_tag_dictionary(catalogue(spark, folder))


def _remapped(spark, folder, known: DataFrame) -> DataFrame:
    raw = raw_interactions(spark, folder)
    tracks = dictionary.build_dictionary(known, TRACK)
    users = dictionary.build_dictionary(raw, USER)
    return dictionary.remap(dictionary.remap(raw, TRACK, tracks), USER, users)


def _remap_sql(tracks: str) -> str:
    return f"""SELECT CAST(u.idx AS INTEGER) AS user_id, CAST(t.idx AS INTEGER) AS track_id, CAST(i.playcount AS INTEGER) AS playcount
      FROM inter i
      LEFT JOIN (SELECT v, row_number() OVER (ORDER BY substr(md5('U' || v), 1, 3), 'U' || v) - 1 AS idx FROM (SELECT DISTINCT user_id AS v FROM inter)) u ON u.v = i.user_id
      LEFT JOIN (SELECT v, row_number() OVER (ORDER BY substr(md5('T' || v), 1, 3), 'T' || v) - 1 AS idx FROM (SELECT DISTINCT track_id AS v FROM {tracks})) t ON t.v = i.track_id"""


@query("remap_ids", sql(_remap_sql("inter"), "inter"))
def remap_ids(spark, folder):
    return _remapped(spark, folder, raw_interactions(spark, folder))


@query("lookup_join", sql(_remap_sql("(SELECT track_id FROM inter WHERE playcount > 30)"), "inter"))
def lookup_join(spark, folder):
    raw = raw_interactions(spark, folder)
    return _remapped(spark, folder, raw.where(F.col(PLAYS) > 30))


@query(
    "remap_tag_list",
    sql(
        "SELECT r.track_id, string_agg(CAST(d.idx AS VARCHAR), ' ' ORDER BY r.pos) AS tag_ids FROM (SELECT track_id, trim(unnest(string_split(tags, ','))) AS tag, generate_subscripts(string_split(tags, ','), 1) AS pos FROM cat) r LEFT JOIN tagdict d ON d.key = r.tag GROUP BY 1",
        "tagdict",
    ),
)
def remap_tag_list(spark, folder):
    cat = catalogue(spark, folder)
    mapped = dictionary.remap_tag_list(cat, TRACK, "tags", dictionary.build_tag_dictionary(cat))
    return mapped.select(TRACK, F.array_join(F.col("tag_ids").cast("array<string>"), " ").alias("tag_ids"))


@query("one_hot_genre", sql("SELECT c.track_id, g.idx, 1.0::DOUBLE AS value FROM cat c JOIN genres g ON g.key = c.genre", "genres"))
def one_hot_genre(spark, folder):
    return features.genre_features(catalogue(spark, folder))


@query("multi_hot_tags", sql("SELECT DISTINCT r.track_id, d.idx, 1.0::DOUBLE AS value FROM tagrows r JOIN tagdict d ON d.key = r.tag", "tagdict"))
def multi_hot_tags(spark, folder):
    return features.tag_features(catalogue(spark, folder))


@query("minmax_scale", sql("SELECT track_id, round(size, 6) AS size, round(price, 6) AS price FROM scaled", "scaled"))
def minmax_scale(spark, folder):
    scaled = features.scale_numeric(catalogue(spark, folder), features.NUMERIC)
    return scaled.select(TRACK, F.round("size", 6).alias("size"), F.round("price", 6).alias("price"))


@query("assemble_features", sql("SELECT track_id, CAST(feature_idx AS INTEGER) AS feature_idx, round(value, 6) AS value FROM tcells", "tcells"))
def assemble_features(spark, folder):
    _, vecs, _ = shared.encoded(spark, folder)
    return vecs.select(TRACK, F.posexplode("vector").alias("feature_idx", "value")).withColumn("value", F.round("value", 6))


@query("attach_metadata", sql("SELECT f.track_id, CAST(f.feature_idx AS INTEGER) AS feature_idx, round(f.value, 6) AS value, c.name, c.artist FROM feat f JOIN cat c ON c.track_id = f.track_id", "feat"))
def attach_metadata(spark, folder):
    long_rows, _, _ = shared.encoded(spark, folder)
    joined = features.attach_metadata(long_rows.where(F.col("feature_idx") >= 0), catalogue(spark, folder), ["name", "artist"])
    return joined.withColumn("value", F.round("value", 6))


# --- joins ------------------------------------------------------------------------------------


@query(
    "cross_candidates",
    sql(
        """SELECT u.user_id, count(*) AS n_candidates, count(t.user_id) AS n_seen, count(*) - count(t.user_id) AS n_unseen
           FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN (SELECT DISTINCT track_id FROM train) i
           LEFT JOIN train t ON t.user_id = u.user_id AND t.track_id = i.track_id GROUP BY 1""",
        "train",
    ),
)
def cross_candidates(spark, folder):
    return aggregates.candidate_counts(train_test(spark, folder)[0])


def offered(spark, folder) -> DataFrame:
    """Candidate pairs for the anti joins: random lists together with each user's whole history."""
    lists = shared.random_lists(spark, folder).select(USER, TRACK)
    return lists.unionByName(history(spark, folder).select(USER, TRACK))


@query(
    "anti_unseen",
    sql("SELECT o.user_id, o.track_id FROM (SELECT user_id, track_id FROM recs UNION ALL SELECT user_id, track_id FROM splits) o WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = o.user_id AND t.track_id = o.track_id)", "recs"),
)
def anti_unseen(spark, folder):
    return offered(spark, folder).join(train_test(spark, folder)[0].select(USER, TRACK), [USER, TRACK], "left_anti")


@query(
    "difference_unseen",
    sql(
        """(SELECT u.user_id, i.track_id FROM (SELECT DISTINCT user_id FROM train) u CROSS JOIN (SELECT DISTINCT track_id FROM train) i
            UNION SELECT user_id, track_id FROM splits) EXCEPT SELECT user_id, track_id FROM train""",
        "train",
    ),
)
def difference_unseen(spark, folder):
    """Every user's unheard tracks: all tracks of train, and those that only test has, less the user's train rows."""
    train = train_test(spark, folder)[0].select(USER, TRACK)
    only_test = history(spark, folder).select(USER, TRACK).subtract(train).join(train.select(TRACK).distinct(), TRACK, "left_anti")
    return splits.all_unseen(train).unionByName(only_test)


@query("feature_join", sql("SELECT t.user_id, f.feature_idx::INTEGER AS feature_idx, count(*) AS n, round(sum(f.value), 6) AS total FROM train t JOIN feat f ON f.track_id = t.track_id GROUP BY 1, 2", "train", "feat"))
def feature_join(spark, folder):
    long_rows, _, _ = shared.encoded(spark, folder)
    joined = train_test(spark, folder)[0].join(long_rows.where(F.col("feature_idx") >= 0), TRACK)
    return joined.groupBy(USER, "feature_idx").agg(long(), F.round(F.sum("value"), 6).alias("total"))


@query("recs_truth_join", sql("SELECT r.user_id, r.track_id, r.rank, t.playcount FROM recs r JOIN test t ON t.user_id = r.user_id AND t.track_id = r.track_id", "recs", "test"))
def recs_truth_join(spark, folder):
    lists = shared.random_lists(spark, folder).select(USER, TRACK, RANK)
    return lists.join(train_test(spark, folder)[1], [USER, TRACK])


@query("semi_known_tracks", sql("SELECT track_id, name FROM cat WHERE track_id IN (SELECT track_id FROM known)", "cat", "known"))
def semi_known_tracks(spark, folder):
    known = history(spark, folder).select(TRACK).distinct()
    return filters.keep_in(catalogue(spark, folder).select(TRACK, "name"), known, TRACK)


@query("self_pairs", sql("SELECT user_id, track_a, track_b, rank FROM listpairs", "listpairs"))
def self_pairs(spark, folder):
    return list_pairs(shared.random_lists(spark, folder), shared.TOP).drop("n")


@query(
    "playlist_enrich",
    sql(
        "SELECT r.user_id, r.rank, r.track_id, r.prediction, d.key AS original_id, c.name, c.artist FROM recs r JOIN d ON d.idx = r.track_id JOIN cat c ON c.track_id = r.track_id",
        "recs",
        "cat",
        d="SELECT 'T' || v AS key, CAST(row_number() OVER (ORDER BY substr(md5('T' || v), 1, 3), 'T' || v) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT track_id AS v FROM inter)",
    ),
)
def playlist_enrich(spark, folder):
    ids = dictionary.build_dictionary(raw_interactions(spark, folder), TRACK)
    return baseline.playlist(shared.random_lists(spark, folder), catalogue(spark, folder), ids)


# --- aggregations -----------------------------------------------------------------------------


@query("count_per_key", sql("SELECT 'user' AS kind, user_id AS id, count(*) AS n FROM inter GROUP BY 2 UNION ALL SELECT 'track', track_id, count(*) FROM inter GROUP BY 2", "inter"))
def count_per_key(spark, folder):
    df = interactions(spark, folder)
    counted = [
        filters.count_per_key(df, c).select(F.lit(kind).alias("kind"), F.col(c).alias("id"), "n")
        for kind, c in (("user", USER), ("track", TRACK))
    ]
    return skew.union_all(counted)


@query("count_distinct", sql("SELECT count(DISTINCT user_id) AS users, count(DISTINCT track_id) AS tracks, count(DISTINCT playcount) AS playcounts FROM inter", "inter"))
def count_distinct(spark, folder):
    df = interactions(spark, folder)
    return df.agg(F.countDistinct(USER).alias("users"), F.countDistinct(TRACK).alias("tracks"), F.countDistinct(PLAYS).alias("playcounts"))


@query("distinct_keys", sql("SELECT 'user' AS kind, user_id AS id FROM (SELECT DISTINCT user_id FROM train) UNION ALL SELECT 'track', track_id FROM (SELECT DISTINCT track_id FROM train)", "train"))
def distinct_keys(spark, folder):
    train, _ = train_test(spark, folder)
    kinds = [train.select(F.lit(k).alias("kind"), F.col(c).alias("id")).distinct() for k, c in (("user", USER), ("track", TRACK))]
    return skew.union_all(kinds)


@query(
    "collect_per_user",
    sql("SELECT user_id, track_id // 256 AS block, string_agg(track_id || ':' || playcount, ' ' ORDER BY track_id) AS tracks FROM train GROUP BY 1, 2", "train"),
)
def collect_per_user(spark, folder):
    """Track lists per user in pieces of 256 neighbouring ids, so that no list grows with the history."""
    train, _ = train_test(spark, folder)
    pieces = train.groupBy(USER, F.expr(f"{TRACK} div 256").cast("int").alias("block"))
    entry = F.transform(
        F.array_sort(F.collect_list(F.struct(TRACK, PLAYS))),
        lambda s: F.concat_ws(":", s[TRACK].cast("string"), s[PLAYS].cast("string")),
    )
    return pieces.agg(F.array_join(entry, " ").alias("tracks"))


@query(
    "dataset_stats",
    sql(
        """SELECT n_rows, n_users, n_items, n_users * n_items AS n_possible, n_users * n_items - n_rows AS n_zero,
             round(1 - n_rows::DOUBLE / (n_users * n_items), 6) AS sparsity, round(n_rows::DOUBLE / (n_users * n_items), 6) AS density
           FROM (SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT track_id) AS n_items FROM train)""",
        "train",
    ),
)
def dataset_stats(spark, folder):
    stats = aggregates.dataset_stats(train_test(spark, folder)[0])
    return stats.withColumn("sparsity", F.round("sparsity", 6)).withColumn("density", F.round("density", 6))


@query(
    "split_overlap_stats",
    sql(
        """SELECT (SELECT count(DISTINCT user_id) FROM train) AS train_users, (SELECT count(DISTINCT user_id) FROM test) AS test_users,
             (SELECT count(*) FROM (SELECT user_id FROM train INTERSECT SELECT user_id FROM test)) AS common_users""",
        "train",
        "test",
    ),
)
def split_overlap_stats(spark, folder):
    return aggregates.split_overlap(history(spark, folder))


STATS = """SELECT count(prediction) AS n, round(avg(prediction), 6) AS mean, round(stddev_samp(prediction), 6) AS std, round(min(prediction), 6) AS min,
  round(quantile_cont(prediction, 0.25), 6) AS q25, round(quantile_cont(prediction, 0.5), 6) AS q50, round(quantile_cont(prediction, 0.75), 6) AS q75,
  round(max(prediction), 6) AS max, count(*) FILTER (WHERE prediction = 0) AS n_zero, count(*) FILTER (WHERE prediction <> 0) AS n_nonzero,
  round(100.0 * count(*) FILTER (WHERE prediction = 0) / count(prediction), 6) AS pct_zero,
  round(100.0 * count(*) FILTER (WHERE prediction <> 0) / count(prediction), 6) AS pct_nonzero, count(DISTINCT prediction) AS n_distinct"""


@query("prediction_stats", sql(f"{STATS}, 'all' AS scope FROM recs UNION ALL {STATS}, 'top10' AS scope FROM recs WHERE rank <= 10", "recs"))
def prediction_stats(spark, folder):
    lists = shared.random_lists(spark, folder)
    scopes = [("all", lists), ("top10", lists.where(F.col(RANK) <= 10))]
    both = skew.union_all([aggregates.prediction_stats(df).withColumn("scope", F.lit(s)) for s, df in scopes])
    doubles = {c for c, t in both.dtypes if t == "double"}
    return both.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in both.columns])


def _profile(long_rows: DataFrame) -> DataFrame:
    return long_rows.where(F.col("feature_idx") >= 0).select(USER, "feature_idx", F.round("value", 9).alias("value"))


@query("profile_mean", sql("SELECT user_id, feature_idx::INTEGER AS feature_idx, round(value, 9) AS value FROM pcells WHERE value <> 0", "pcells"))
def profile_mean(spark, folder):
    return _profile(features.profile_means(train_test(spark, folder)[0], shared.encoded(spark, folder)[0]))


@query("profile_median", sql("SELECT t.user_id, c.feature_idx::INTEGER AS feature_idx, round(median(c.value), 9) AS value FROM train t JOIN tcells c ON c.track_id = t.track_id GROUP BY 1, 2 HAVING median(c.value) <> 0", "train", "tcells"))
def profile_median(spark, folder):
    return _profile(features.profile_medians(train_test(spark, folder)[0], shared.encoded(spark, folder)[0]))


def _weighted_sql(rows: str) -> str:
    return f"""SELECT t.user_id, c.feature_idx::INTEGER AS feature_idx, round(sum(t.playcount * c.value) / (sum(t.playcount) * {rows}), 9) AS value
      FROM train t JOIN tcells c ON c.track_id = t.track_id GROUP BY 1, 2 HAVING sum(t.playcount * c.value) <> 0"""


@query("profile_weighted", sql(_weighted_sql("count(*)"), "train", "tcells"))
def profile_weighted(spark, folder):
    return _profile(features.profile_means(train_test(spark, folder)[0], shared.encoded(spark, folder)[0], weighted=True))


@query("profile_weighted_normalised", sql(_weighted_sql("1"), "train", "tcells"))
def profile_weighted_normalised(spark, folder):
    long_rows = shared.encoded(spark, folder)[0]
    return _profile(features.profile_means(train_test(spark, folder)[0], long_rows, weighted=True, normalised=True))


SLOTS = ", ".join(f"CAST(max(CASE WHEN track_id % 32 = {i} AND playcount > 0 THEN 1 ELSE 0 END) AS INTEGER) AS t{i}" for i in range(32))


@query("interaction_pivot", sql(f"SELECT user_id, CAST(track_id // 32 AS INTEGER) AS block, {SLOTS} FROM train GROUP BY 1, 2", "train"))
def interaction_pivot(spark, folder):
    return features.interaction_blocks(train_test(spark, folder)[0], 32)


# --- windows and sorts ------------------------------------------------------------------------

SCORED = f"SELECT user_id, track_id, playcount, round({hash48("'p-' || " + PAIR)} / 281474976710656.0::DOUBLE, 3) AS prediction FROM splits"


def scored_history(spark, folder) -> DataFrame:
    """Every history row with a pseudo-random score of three places, so that ties occur."""
    score = F.round(uniform("p", F.col(USER), F.col(TRACK)), 3)
    return history(spark, folder).select(USER, TRACK, PLAYS, score.alias(PREDICTION))


@query("topk_per_user", sql("SELECT user_id, track_id, prediction, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id) AS rank FROM s) WHERE rank <= 10", "splits", s=SCORED))
def topk_per_user(spark, folder):
    return ranking.topk_per_user(scored_history(spark, folder).drop(PLAYS), 10)


@query("argsort_topn", sql("SELECT user_id, track_id, prediction, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id DESC) AS rank FROM s) WHERE rank <= 25", "splits", s=SCORED))
def argsort_topn(spark, folder):
    return ranking.topk_per_user(scored_history(spark, folder).drop(PLAYS), 25, high_track_first=True)


@query("percent_rank_user", sql("SELECT user_id, track_id, playcount, prediction, round(percent_rank() OVER (PARTITION BY user_id ORDER BY prediction DESC), 6) AS percent_rank FROM s", "splits", s=SCORED))
def percent_rank_user(spark, folder):
    ranked = ranking.percent_rank(scored_history(spark, folder))
    return ranked.withColumn("percent_rank", F.round("percent_rank", 6))


@query("rank_enumerate", sql("SELECT user_id, track_id, prediction, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id) AS rank FROM s", "splits", s=SCORED))
def rank_enumerate(spark, folder):
    return ranking.enumerate_ranks(scored_history(spark, folder).drop(PLAYS))


@query("collect_over_window", sql("SELECT user_id, track_id, rank, string_agg(CAST(track_id AS VARCHAR), ' ') OVER (PARTITION BY user_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS list FROM recs WHERE rank <= 10", "recs"))
def collect_over_window(spark, folder):
    """The whole list beside each of its rows; lists are cut to ten before."""
    lists = shared.random_lists(spark, folder).where(F.col(RANK) <= 10)
    whole = Window.partitionBy(USER).orderBy(RANK).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tracks = F.collect_list(F.col(TRACK).cast("string")).over(whole)
    return lists.select(USER, TRACK, RANK, F.array_join(tracks, " ").alias("list"))


# --- sets, splits, samples --------------------------------------------------------------------


@query("union_all", sql("SELECT user_id, track_id, playcount FROM test UNION ALL SELECT user_id, track_id, playcount FROM train", "train", "test"))
def union_all(spark, folder):
    train, test = train_test(spark, folder)
    return test.unionByName(train)


@query("union_distinct_tracks", sql("SELECT track_id FROM train UNION SELECT track_id FROM test", "train", "test"))
def union_distinct_tracks(spark, folder):
    train, test = train_test(spark, folder)
    return train.select(TRACK).union(test.select(TRACK)).distinct()


@query("intersect_users", sql("SELECT user_id FROM train INTERSECT SELECT user_id FROM test", "train", "test"))
def intersect_users(spark, folder):
    train, test = train_test(spark, folder)
    return train.select(USER).intersect(test.select(USER))


@query("split_per_user", sql("SELECT user_id, track_id, playcount, split FROM splits", "splits"))
def split_per_user(spark, folder):
    return splits.split_per_user(stage(filters.active_users(interactions(spark, folder)), "active"))


@query("split_random_ratio", sql(f"SELECT *, CASE WHEN {hash48(PAIR + " || '-ratio-42'")} < 0.8 * 281474976710656 THEN 'train' ELSE 'test' END AS split FROM inter", "inter"))
def split_random_ratio(spark, folder):
    return splits.split_ratio(interactions(spark, folder))


@query("kfold", sql(f"SELECT user_id, track_id, playcount, CAST({hash48(PAIR + " || '-fold-1'")} % 5 AS INTEGER) AS fold FROM train", "train"))
def kfold(spark, folder):
    return splits.folds(train_test(spark, folder)[0])


@query("negative_sampling", sql("SELECT user_id, track_id, playcount FROM train UNION ALL SELECT user_id, track_id, 0 FROM drawn", "train", "drawn"))
def negative_sampling(spark, folder):
    return splits.add_negatives(train_test(spark, folder)[0], shared.TOP)


@query("draw_unseen", sql("SELECT user_id, track_id, draw FROM drawn", "drawn"))
def draw_unseen(spark, folder):
    return splits.draw_unseen(train_test(spark, folder)[0], shared.TOP)
