"""Text formats, dictionaries, filters, splits, draws and encodings, with edge rows."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracklight import runtime
from tracklight.functions import transforms, vectors
from tracklight.operators import aggregates, dictionary, features, filters, ranking, skew, splits
from tracklight.plans import prepare_queries
from tracklight.schema import INTERACTIONS, RAW_INTERACTIONS
from tracklight.sources import io, tables
from tracklight.sources.tables import train_test

# Toy rating matrix, 0 = missing: fixed values.
TOY_10X5 = [
    [5, 3, 0, 1, 4],
    [4, 0, 0, 1, 0],
    [1, 1, 0, 5, 0],
    [0, 0, 0, 4, 0],
    [0, 1, 5, 4, 0],
    [0, 3, 0, 2, 0],
    [1, 0, 2, 0, 4],
    [0, 5, 0, 4, 0],
    [3, 0, 4, 0, 5],
    [5, 3, 0, 1, 0],
]


def test_literal_ratings(spark):
    row = io.literal_ratings(spark, TOY_10X5).agg(F.count("*"), F.sum("rating")).first()
    assert tuple(row) == (26, 81.0)


def test_text_round_trips(spark, plays, tmp_path):
    io.write_tsv(plays, f"{tmp_path}/t")
    assert io.read_tsv(spark, f"{tmp_path}/t", INTERACTIONS).exceptAll(plays).count() == 0
    first = io.read_tsv(spark, f"{tmp_path}/t", INTERACTIONS, limit=3, order=["user_id", "track_id"]).collect()
    assert [r["user_id"] for r in first] == [0, 0, 0]
    assert dict(io.read_tsv_inferred(spark, f"{tmp_path}/t").dtypes)["playcount"] == "int"
    raw = spark.createDataFrame([("t1", "u1", 2), ("t2", "u1", 1)], RAW_INTERACTIONS)
    raw.write.option("header", True).csv(f"{tmp_path}/c")
    assert io.read_raw_csv(spark, f"{tmp_path}/c", RAW_INTERACTIONS).exceptAll(raw).count() == 0


def test_dictionary_file_strips_blanks(spark, tmp_path):
    d = spark.createDataFrame([("rock", 0), ("new wave", 1)], "key string, idx int")
    io.write_dictionary(d, f"{tmp_path}/d")
    lines = sorted(r[0] for r in spark.read.text(f"{tmp_path}/d").collect())
    assert lines == ["new wave\t 1", "rock\t 0"]
    assert io.read_dictionary(spark, f"{tmp_path}/d").exceptAll(d).count() == 0
    assert io.read_dictionary_reverse(spark, f"{tmp_path}/d").columns == ["idx", "key"]


def test_summary_file(spark, tmp_path):
    df = spark.createDataFrame([("als", 10, 0.5)], "algo string, k int, precision double")
    io.write_summary(df, f"{tmp_path}/s")
    assert io.read_summary(spark, f"{tmp_path}/s").collect() == df.collect()
    columns, rows = io.preview(df)
    assert columns == ["algo", "k", "precision"] and rows.count() == 1


def test_dictionary_is_dense_and_counts_null(spark):
    df = spark.createDataFrame([(f"v{i % 500}",) for i in range(900)] + [(None,)], "v string")
    rows = dictionary.build_dictionary(df, "v").collect()
    assert sorted(r["idx"] for r in rows) == list(range(501))
    assert sum(r["key"] is None for r in rows) == 1


def test_remap_unknown_to_null(spark):
    d = spark.createDataFrame([("a", 0), (None, 7)], "key string, idx int")
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    assert sorted((r["n"], r["k"]) for r in dictionary.remap(df, "k", d).collect()) == [(1, 0), (2, None), (3, 7)]


def test_dictionary_files_keep_every_key(spark, tmp_path):
    keys = ['"Heroes"', '"Open', "a\tb", "back\\slash", "\\N", "\\\\t", "new\nline\r", "", " x ", "plain", "tab\t 3", None, "é😀"]
    rows = spark.createDataFrame(list(zip(keys, range(len(keys)))), "key string, idx int")
    io.write_dictionary(rows, str(tmp_path / "d"))
    assert sorted((r["idx"], r["key"]) for r in io.read_dictionary(spark, str(tmp_path / "d")).collect()) == list(enumerate(keys))
    (tmp_path / "bad").write_text("key\t x\n")
    assert [tuple(r) for r in io.read_dictionary(spark, str(tmp_path / "bad")).collect()] == [("key", None)]


def test_tag_literals(spark):
    texts = ["""["drum 'n' bass", 'rock']""", """["rock 'n' roll"]""", "[1, 2]", r"""['it\'s', "a \"b\""]""", "[]", "['', 'a, b', c d ]"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, tags string")
    parsed = [r[1] for r in df.select("n", transforms.parse_tags("tags")).orderBy("n").collect()]
    assert parsed == [["drum 'n' bass", "rock"], ["rock 'n' roll"], ["1", "2"], ["it's", 'a "b"'], [], ["a, b", "c d"]]


def test_tags(spark):
    rows = [(0, "rock, indie "), (1, None), (2, "['a', 'b']"), (3, "rock, rock")]
    df = spark.createDataFrame(rows, "track_id int, tags string")
    parsed = {r[0]: r[1] for r in df.select("track_id", transforms.parse_tags("tags")).collect()}
    assert parsed == {0: ["rock", "indie"], 1: [], 2: ["a", "b"], 3: ["rock", "rock"]}
    d = spark.createDataFrame([("rock", 7), ("a", 1)], "key string, idx int")
    mapped = {r["track_id"]: r["tag_ids"] for r in dictionary.remap_tag_list(df, "track_id", "tags", d).collect()}
    assert mapped == {0: [7, None], 1: [], 2: [1, None], 3: [7, 7]}
    hot = Counter(r["track_id"] for r in features.tag_features(df).collect())
    assert hot == {0: 2, 2: 2, 3: 1}


def test_null_genre_and_constant_feature(spark):
    df = spark.createDataFrame([(0, "x", 1.0, 5.0), (1, None, 3.0, 5.0), (2, "y", None, 5.0)], "track_id int, genre string, size double, price double")
    assert sorted(r["track_id"] for r in features.genre_features(df).collect()) == [0, 2]
    scaled = {r["track_id"]: (r["size"], r["price"]) for r in features.scale_numeric(df, ["size", "price"]).collect()}
    assert scaled == {0: (0.0, 0.0), 1: (1.0, 0.0), 2: (None, 0.0)}


def test_track_without_features_keeps_its_place(spark):
    df = spark.createDataFrame([(0, "x", "t", 1.0, 5.0), (1, None, None, 1.0, 5.0)], "track_id int, genre string, tags string, size double, price double")
    width = features.feature_width(df)
    dense = {r[0]: r[1] for r in features.to_vectors(features.track_features(df), "track_id", width).collect()}
    assert width == 4 and dense[1] == [0.0] * 4 and sum(dense[0]) == 2.0
    names = {r["feature_idx"]: r["feature"] for r in features.feature_names(df).collect()}
    assert names == {0: "size", 1: "price", 2: "genre_x", 3: "tag_t"}


def test_profiles(spark):
    feats = spark.createDataFrame(
        [(1, -1, 1.0), (2, -1, 1.0), (1, 0, 2.0), (2, 0, 4.0), (2, 1, 8.0)], "track_id int, feature_idx int, value double"
    )
    plays = spark.createDataFrame([(0, 1, 3), (0, 2, 1)], "user_id int, track_id int, playcount bigint")
    flat = lambda df: {r["feature_idx"]: r["value"] for r in df.collect() if r["feature_idx"] >= 0}
    assert flat(features.profile_means(plays, feats)) == {0: 3.0, 1: 4.0}
    assert flat(features.profile_means(plays, feats, weighted=True)) == {0: 1.25, 1: 1.0}
    assert flat(features.profile_means(plays, feats, weighted=True, normalised=True)) == {0: 2.5, 1: 2.0}
    four = spark.createDataFrame([(t, -1, 1.0) for t in range(4)] + [(t, 0, v) for t, v in enumerate([1.0, 2.0, 3.0, 10.0])], feats.schema)
    heard = spark.createDataFrame([(0, t, 1) for t in range(4)], plays.schema)
    assert flat(features.profile_medians(heard, four)) == {0: 2.5}


def test_scalar_transforms(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 9.0)], "p bigint, s double")
    rows = df.select(transforms.confidence(F.col("p")), transforms.heard("p"), transforms.clip(F.col("s")), transforms.cell_weight("p")).collect()
    assert [tuple(r) for r in rows] == [(1.0, 0, 1.0, 0.01), (pytest.approx(1.693147, abs=1e-6), 1, 5.0, 1.0)]


def test_vector_kernels_with_zero_vector(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<double>, b array<double>")
    row = df.select(vectors.cosine_similarity("a", "b"), vectors.cosine_distance("a", "b"), vectors.euclidean("a", "b"), vectors.norm("a"), vectors.unit("b")).first()
    assert tuple(row) == (0.0, 1.0, 5.0, 5.0, [0.0, 0.0])


def test_active_users_counts_before_filtering(spark):
    rows = [(0, t, 1) for t in range(3)] + [(1, 0, 1), (1, 1, 1)]
    df = spark.createDataFrame(rows, INTERACTIONS)
    kept = filters.active_users(df, min_user_rows=3, min_track_rows=2)
    assert sorted((r[0], r[1]) for r in kept.collect()) == [(0, 0), (0, 1)]


@pytest.mark.parametrize("hot_rows", [10**9, 20])
def test_split_sizes(spark, hot_rows):
    sizes = {0: 1, 1: 2, 2: 5, 3: 50, 4: 51}
    df = spark.createDataFrame([(u, t, 1) for u, n in sizes.items() for t in range(n)], INTERACTIONS)
    split = splits.split_per_user(df, hot_rows=hot_rows)
    tests = Counter(r["user_id"] for r in split.where("split = 'test'").collect())
    assert [tests[u] for u in range(5)] == [0, 1, 1, 10, 11]
    assert split.count() == df.count()


def test_history_tasks_follow_the_rows_and_digests_are_not_sent(spark, plays, monkeypatch, capsys):
    monkeypatch.setattr(runtime, "TASK_ROWS", 50)
    assert runtime.by_rows(plays, plays.count(), "user_id").rdd.getNumPartitions() == math.ceil(plays.count() / 50)
    splits.split_per_user(plays).explain()
    lines = capsys.readouterr().out.splitlines()
    digests, exchanges = ([i for i, line in enumerate(lines) if word in line] for word in ("md5(", "Exchange hashpartitioning(user_id"))
    assert digests and exchanges and max(digests) < min(exchanges)


def test_hot_users_split_and_rank_like_others(spark, plays):
    plain = splits.split_per_user(plays)
    assert skew.hot_keys(plays, "user_id", 5).count() > 0 and skew.hot_keys(plays, "user_id") is None
    assert splits.split_per_user(plays, hot_rows=5).exceptAll(plain).count() == 0
    scored = plays.select("user_id", "track_id", (F.col("playcount") / 3).alias("prediction"))
    for f in (ranking.enumerate_ranks, ranking.percent_rank):
        assert f(scored, hot_rows=5).exceptAll(f(scored)).count() == 0
        assert f(scored, hot_rows=5).count() == plays.count()


@pytest.mark.parametrize("hot_rows", [3, 5, 17])
def test_hot_ranks_with_nulls_nan_and_ties(spark, hot_rows):
    values = [None] * 10 + [float("nan")] * 3 + [1.0] * 12 + [float(i % 7) for i in range(20)]
    rows = [(u, t, v) for u in (1, 2, None) for t, v in enumerate(values)] + [(3, t, 4.0) for t in range(30)]
    scored = spark.createDataFrame(rows, "user_id int, track_id int, prediction double").repartition(5)
    for f in (ranking.enumerate_ranks, ranking.percent_rank):
        ours, plain = (sorted(map(str, f(scored, hot_rows=h).collect())) for h in (hot_rows, 10**9))
        assert ours == plain


def test_folds_and_ratio_cover_everything(spark, plays):
    sizes = Counter(r["fold"] for r in splits.folds(plays).collect())
    assert sorted(sizes) == [0, 1, 2, 3, 4] and sum(sizes.values()) == plays.count()
    ratio = splits.split_ratio(plays).where("split = 'train'").count() / plays.count()
    assert 0.7 < ratio < 0.9


@pytest.mark.parametrize("n", [1, 5, 100])
@pytest.mark.parametrize("per_row", [4096, 7])
def test_draws_are_unseen_distinct_and_complete(spark, plays, history_rows, n, per_row, monkeypatch):
    monkeypatch.setattr(splits, "DRAWS_PER_ROW", per_row)
    seen, tracks = {}, {t for _, t, _ in history_rows}
    for u, t, _ in history_rows:
        seen.setdefault(u, set()).add(t)
    drawn = {}
    for r in splits.draw_unseen(plays, n).collect():
        drawn.setdefault(r["user_id"], []).append(r["track_id"])
    for u in seen:
        assert len(drawn[u]) == len(set(drawn[u])) == min(n, len(tracks - seen[u]))
        assert not set(drawn[u]) & seen[u]


def test_tasks_of_the_history_follow_its_rows(spark, folder, monkeypatch):
    """The plays of a pair are added up in as many tasks as the rows ask for, whatever adaptive execution would merge."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    monkeypatch.setattr(runtime, "TASK_ROWS", 500)
    plays = tables.collect_interactions(spark, folder)
    assert plays.rdd.getNumPartitions() == -(-lines.count() // 500) > 4
    assert plays.agg(F.sum("playcount")).first()[0] == lines.agg(F.sum("l_quantity").cast("bigint")).first()[0]


def test_walks_of_draws_are_not_broadcast(spark, plays, capsys):
    """Exploded steps look small to the optimizer, whatever their number; they must not pass through the driver."""
    drawn = splits.draw_unseen(plays, 5)
    assert drawn.count()
    drawn.explain()
    plan = capsys.readouterr().out
    assert re.search(r"SortMergeJoin \[idx", plan) and not re.search(r"BroadcastHashJoin \[idx", plan)


def test_user_who_heard_everything_gets_no_draw(spark):
    df = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (1, 0, 1)], INTERACTIONS)
    assert [(r[0], r[1]) for r in splits.draw_unseen(df, 5).select("user_id", "track_id").collect()] == [(1, 1)]
    with_negatives = splits.add_negatives(df, 5).where("playcount = 0")
    assert with_negatives.count() == 1


def test_next_prime():
    assert [splits.next_prime(n) for n in (1, 2, 4, 14, 2000)] == [2, 2, 5, 17, 2003]


@pytest.mark.parametrize("values", [[float(i % 97) for i in range(3000)], [1.0] * 2500 + [0.5, 7.0], list(map(math.sqrt, range(1000)))])
def test_exact_quantiles(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "prediction double").repartition(3)
    expected = np.percentile(values, [25, 50, 75])
    assert aggregates.exact_quantiles(df, "prediction", [0.25, 0.5, 0.75], leaf_values=50) == pytest.approx(list(expected))


def test_stats_of_nothing(spark):
    row = aggregates.prediction_stats(spark.createDataFrame([], "prediction double")).first()
    assert row["n"] == 0 and row["q50"] is None


def test_candidate_counts(spark, plays, history_rows):
    rows = {r["user_id"]: r for r in aggregates.candidate_counts(plays).collect()}
    tracks = {t for _, t, _ in history_rows}
    assert all(rows[u]["n_unseen"] == len(tracks) - sum(1 for a, _, _ in history_rows if a == u) for u in rows)


def test_interaction_blocks_hold_every_play(spark, plays):
    blocks = features.interaction_blocks(plays, 8)
    total = sum(sum(r[f"t{i}"] for i in range(8)) for r in blocks.collect())
    assert total == plays.count()


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_catalogue_is_not_broadcast_for_its_features(spark, monkeypatch, capsys, limit):
    """Files of a catalogue are much smaller than its rows, which must not pass through the driver to meet the dictionary."""
    monkeypatch.setattr(features, "BROADCAST_BYTES", limit, raising=False)
    tracks = spark.createDataFrame([(1, "rock", "a, b, a"), (2, "jazz", "b"), (3, None, "")], "track_id int, genre string, tags string")
    for found, expected in ((features.genre_features(tracks), 2), (features.tag_features(tracks), 3)):
        assert found.where("idx < 2 and value = 1").count() == expected
        found.explain()
        plan = capsys.readouterr().out
        joins = [line for line in plan.splitlines() if re.search(r"Join \[(genre|tag)", line)]
        assert joins and all(("BroadcastHashJoin" in line and "BuildRight" in line) if limit else "SortMergeJoin" in line for line in joins)


@pytest.mark.parametrize("block_tracks", [4096, 5])
def test_all_unseen_is_every_track_less_the_seen_ones(spark, plays, history_rows, monkeypatch, block_tracks):
    monkeypatch.setattr(splits, "BLOCK_TRACKS", block_tracks)
    heard = {(u, t) for u, t, _ in history_rows}
    expected = {(u, t) for u, _ in heard for _, t in heard} - heard
    found = [tuple(r) for r in splits.all_unseen(plays).select("user_id", "track_id").collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_difference_unseen_covers_all_pairs(spark, folder):
    """More than the drawn lists: users times tracks less the rows of train."""
    train = train_test(spark, folder)[0]
    pairs = train.select("user_id").distinct().count() * train.select("track_id").distinct().count() - train.count()
    assert prepare_queries.difference_unseen(spark, folder).join(train.select("track_id").distinct(), "track_id", "left_semi").count() == pairs


def test_self_pairs_holds_every_pair_of_a_list(spark, folder):
    sizes = {r["user_id"]: r["count"] for r in prepare_queries.shared.random_lists(spark, folder).groupBy("user_id").count().collect()}
    pairs = {r["user_id"]: r["count"] for r in prepare_queries.self_pairs(spark, folder).groupBy("user_id").count().collect()}
    assert max(sizes.values()) > 10 and pairs == {u: n * (n - 1) // 2 for u, n in sizes.items() if n > 1}
