"""Metrics against worked examples, brute force and MLlib."""

import math

import numpy as np
import pytest
from pyspark.mllib.evaluation import RankingMetrics
from pyspark.sql import functions as F

from tracklight.metrics import diversity, ranking, rating, report
from tracklight.operators import ranking as ranks


def lists(spark, per_user):
    rows = [(u, t, i + 1, float(len(ts) - i)) for u, ts in per_user.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "user_id int, track_id int, rank int, prediction double")


def truth(spark, rows):
    return spark.createDataFrame(rows, "user_id int, track_id int, playcount bigint")


@pytest.fixture(scope="module")
def worked(spark):
    recs = lists(spark, {0: [1, 2, 3, 4]})
    return ranking.user_metrics(recs, truth(spark, [(0, 2, 5), (0, 4, 3), (0, 9, 2)]), [4]).first()


@pytest.mark.parametrize(
    "column, value",
    [
        ("precision_list", 0.5),
        ("recall", 0.666667),
        ("hit", 1.0),
        ("ap", 0.333333),
        ("ndcg_graded", 0.563385),
        ("ndcg", 0.498189),
    ],
)
def test_worked_list(worked, column, value):
    assert worked[column] == pytest.approx(value, abs=1e-6)


def test_two_maps_and_nominal_k(spark):
    recs, held = lists(spark, {1: [1, 2]}), truth(spark, [(1, t, 1) for t in (1, 2, 3, 4)])
    rows = {r["k"]: r for r in ranking.user_metrics(recs, held, [2, 4]).collect()}
    assert rows[2]["ap"] == pytest.approx(0.5)
    assert rows[2]["ap_at_k"] == pytest.approx(1.0)
    assert rows[4]["precision_at_k"] == 0.5 and rows[4]["precision_list"] == 1.0
    assert rows[4]["recall"] == 0.5
    assert rows[4]["ndcg"] == pytest.approx(0.636682, abs=1e-6)


def test_hit_at_k_counts_all_test_users(spark):
    recs = lists(spark, {0: [1, 2], 1: [3], 2: [9]})
    held = truth(spark, [(0, 1, 1), (1, 3, 1), (2, 5, 1), (3, 7, 1)])
    assert ranking.hit_at_k(recs, held, 2).first()[0] == 0.5
    assert ranking.ranking_at_k(recs, held, [2]).first()["hit_at_k"] == 0.5


def test_agreement_with_mllib(spark, plays):
    recs = ranks.topk_per_user(
        plays.select("user_id", ((F.col("track_id") * 7 + F.col("user_id")) % 60).cast("int").alias("track_id"), F.col("playcount").cast("double").alias("prediction")), 10
    )
    ours = {r["k"]: r for r in ranking.ranking_at_k(recs, plays, [3, 10]).collect()}
    listed = recs.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "track_id"))), lambda s: s["track_id"]).alias("l"))
    held = plays.groupBy("user_id").agg(F.collect_set("track_id").alias("t"))
    pairs = listed.join(held, "user_id").select("l", "t").rdd.map(lambda r: ([float(x) for x in r[0]], [float(x) for x in r[1]]))
    theirs = RankingMetrics(pairs)
    for k in (3, 10):
        assert ours[k]["precision_at_k"] == pytest.approx(theirs.precisionAt(k))
        assert ours[k]["recall_at_k"] == pytest.approx(theirs.recallAt(k))
        assert ours[k]["ndcg_at_k"] == pytest.approx(theirs.ndcgAt(k))
        assert ours[k]["map_at_k"] == pytest.approx(theirs.meanAveragePrecisionAt(k))
        assert ours[k]["map"] <= ours[k]["map_at_k"] + 1e-12
    assert ours[10]["map"] == pytest.approx(theirs.meanAveragePrecision)
    assert ours[3]["hit_at_k"] <= ours[10]["hit_at_k"]


def test_list_analysis_first_two_ranks_weigh_the_same(spark):
    held = truth(spark, [(0, 5, 1), (0, 6, 1)])
    values = [ranking.list_analysis(lists(spark, {0: l}), held, [2]).first()["ndcg"] for l in ([5, 1], [1, 5], [5, 6])]
    assert values == pytest.approx([0.5, 0.5, 1.0])


def test_precision_recall_skips_users_outside_train(spark):
    recs, held = lists(spark, {0: [1, 2], 1: [3]}), truth(spark, [(0, 1, 1), (1, 4, 1), (2, 5, 1)])
    train = truth(spark, [(0, 8, 1), (2, 8, 1)])
    row = ranking.precision_recall(recs, held, train, 5).first()
    assert row["precision"] == pytest.approx(0.25) and row["recall"] == pytest.approx(0.5)


def test_list_distances(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])], "track_id int, vector array<double>")
    recs = lists(spark, {0: [1, 2, 3], 1: [1]})
    cosine = {r[0]: r[1] for r in diversity.list_distance(recs, vectors).collect()}
    euclid = {r[0]: r[1] for r in diversity.list_distance(recs, vectors, "euclidean").collect()}
    assert cosine[0] == pytest.approx(0.528595, abs=1e-6) and cosine[1] == 0
    assert euclid[0] == pytest.approx(1.138071, abs=1e-6) and euclid[1] == 0
    with pytest.raises(ValueError):
        diversity.list_distance(recs, vectors, "manhattan")


@pytest.mark.parametrize("piece", [2, 3, 256])
def test_long_lists_in_pieces(spark, piece, monkeypatch):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(40, 3))
    vectors = spark.createDataFrame([(t, p.tolist()) for t, p in enumerate(points)], "track_id int, vector array<double>")
    listed = {0: list(range(40)), 1: [5, 3, 9, 1], 2: [7]}
    recs = lists(spark, listed)
    monkeypatch.setattr(diversity, "PIECE", piece)
    found = {r[0]: r[1] for r in diversity.list_distance(recs, vectors, "euclidean").collect()}
    for user, tracks in listed.items():
        pairs = [np.linalg.norm(points[a] - points[b]) for i, a in enumerate(tracks) for b in tracks[i + 1 :]]
        assert found[user] == pytest.approx(np.mean(pairs) if pairs else 0)
    top = 25
    rows = {(r["user_id"], r["track_a"], r["track_b"]): (r["n"], r["rank"]) for r in diversity.list_pairs(recs, top).collect()}
    expected = {}
    for user, tracks in listed.items():
        kept = tracks[:top]
        for i, a in enumerate(kept):
            for j in range(i + 1, len(kept)):
                expected[user, min(a, kept[j]), max(a, kept[j])] = (len(kept), j + 1)
    assert rows == expected


def test_every_k_has_a_row_without_common_users(spark):
    row = ranking.ranking_at_k(lists(spark, {0: [1]}), truth(spark, [(1, 4, 1)]), [1, 2]).collect()
    assert [(r["k"], r["hit_at_k"], r["map"]) for r in sorted(row)] == [(1, 0.0, None), (2, 0.0, None)]


def test_flat_ideals_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PIECE", 4)
    held = truth(spark, [(n, t, 1) for n in (1, 3, 4, 5, 8, 11) for t in range(n)])
    for r in ranking.flat_ideals(held).collect():
        assert r["ideal"] == pytest.approx(sum(1 / max(math.log2(i), 1.0) for i in range(1, r["user_id"] + 1)))


def test_zero_vector_has_distance_one(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "track_id int, vector array<double>")
    assert diversity.list_distance(lists(spark, {0: [1, 2]}), vectors).first()["distance"] == pytest.approx(1.0)


def test_novelty(spark):
    train = truth(spark, [(0, 1, 1), (0, 2, 1), (1, 2, 1), (2, 2, 1)])
    assert diversity.novelty(lists(spark, {5: [1]}), train, [10]).first()["novelty"] == pytest.approx(2.0)


def test_collaborative_diversity_worked(spark):
    train = truth(spark, [(0, 1, 1), (0, 2, 1), (1, 1, 1), (2, 2, 1)])
    assert diversity.collaborative_diversity(lists(spark, {9: [1, 2]}), train, [10]).first()["diversity"] == pytest.approx(0.5)


def test_collaborative_diversity_brute_force(spark, plays, history_rows):
    recs = ranks.topk_per_user(plays.select("user_id", "track_id", F.col("playcount").cast("double").alias("prediction")), 6)
    by_track = {}
    for u, t, _ in history_rows:
        by_track.setdefault(t, set()).add(u)
    per_user = {}
    for r in recs.collect():
        per_user.setdefault(r["user_id"], []).append((r["rank"], r["track_id"]))
    for k, ours in {r["k"]: r["diversity"] for r in diversity.collaborative_diversity(recs, plays, [3, 6]).collect()}.items():
        means = []
        for l in per_user.values():
            ts = [t for rank, t in sorted(l) if rank <= k]
            pairs = [(a, b) for i, a in enumerate(ts) for b in ts[i + 1 :]]
            means.append(sum(len(by_track[a] & by_track[b]) / math.sqrt(len(by_track[a]) * len(by_track[b])) for a, b in pairs) / len(pairs))
        assert ours == pytest.approx(1 - sum(means) / len(means))


@pytest.mark.parametrize("dense", [512, 3, 0])
def test_listeners_in_pieces_and_bitmaps(spark, monkeypatch, dense):
    """The way beyond a broadcast: lists, bitmaps and both, over several ranges of user ids, negative ones too."""
    import random

    monkeypatch.setattr(diversity, "DENSE", dense)
    rng = random.Random(3)
    users = [rng.randrange(-40_000, 100_000) for _ in range(60)] + list(range(32_760, 32_775))
    heard = {(u, t) for u in users for t in rng.sample(range(8), 3)} | {(u, 0) for u in users}
    train = spark.createDataFrame(sorted(heard), "user_id int, track_id int")
    pairs = [(a, b, 1.0 + a, 0.5 * b) for a in range(8) for b in range(a + 1, 8)]
    rows = diversity.count_in_pieces(spark.createDataFrame(pairs, "track_id int, other int, k1 double, k2 double"), train, ["k1", "k2"])
    found = {(r.k1, r.k2): r.n for r in rows.groupBy("k1", "k2").agg(F.sum("common").alias("n")).collect()}
    by_track = {t: {u for u, x in heard if x == t} for t in range(8)}
    assert {(x, y): len(by_track[a] & by_track[b]) for a, b, x, y in pairs} == found


def test_both_ways_agree(spark, plays, monkeypatch):
    recs = ranks.topk_per_user(plays.select("user_id", "track_id", F.col("playcount").cast("double").alias("prediction")), 6)
    near = sorted(diversity.collaborative_diversity(recs, plays, [3, 6]).collect())
    monkeypatch.setattr(diversity, "BROADCAST_BYTES", 0)
    for a, b in zip(near, sorted(diversity.collaborative_diversity(recs, plays, [3, 6]).collect()), strict=True):
        assert a.k == b.k and a.diversity == pytest.approx(b.diversity)


def test_roem_and_percent_rank(spark):
    rows = [(0, 1, 6, 5.0), (0, 2, 3, 4.0), (0, 3, 1, 3.0)]
    df = spark.createDataFrame(rows, "user_id int, track_id int, playcount bigint, prediction double")
    assert rating.roem(df).first()[0] == pytest.approx(0.25)
    ties = spark.createDataFrame([(0, i, v) for i, v in enumerate([5.0, 2.0, 2.0, 1.0])], "user_id int, track_id int, prediction double")
    assert [r["percent_rank"] for r in ranks.percent_rank(ties).orderBy("track_id").collect()] == pytest.approx([0, 1 / 3, 1 / 3, 1])


def test_rating_errors(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0)], "playcount bigint, prediction double")
    row = rating.rating_errors(df).first()
    assert row["rmse"] == pytest.approx(math.sqrt(2)) and row["mae"] == 1.0


def test_summary_and_series(spark, plays):
    recs = lists(spark, {0: [1, 2, 3], 1: [4, 5, 6]})
    metrics = report.metrics_by_k(recs, plays, plays, [1, 3])
    rows = report.summary([report.summary_rows("b", metrics, plays), report.summary_rows("a", None, plays, [1, 3])])
    found = rows.collect()
    assert [(r["algo"], r["k"]) for r in found] == [("a", 1), ("a", 3), ("b", 1), ("b", 3)]
    assert found[0]["novelty"] is None and found[0]["data"] == plays.count()
    series = report.algo_k_series(rows, "novelty", [1, 3]).orderBy("algo").collect()
    assert series[1]["k1"] == pytest.approx(found[2]["novelty"]) and series[0]["k3"] is None


def test_bundle_equals_row_of_metrics_by_k(spark, plays):
    recs = lists(spark, {0: [1, 2, 3], 1: [4, 5, 6]})
    many = {r["k"]: r.asDict() for r in report.metrics_by_k(recs, plays, plays, [2, 3]).collect()}
    one = report.metric_bundle(recs, plays, plays, 2).first().asDict()
    assert one == pytest.approx({k: v for k, v in many[2].items() if k != "k"})


def test_pieces_beyond_the_limit_are_not_broadcast(spark, plays, monkeypatch, capsys):
    monkeypatch.setattr(diversity, "BROADCAST_BYTES", 0)
    pairs = spark.createDataFrame([(0, 2, 1.0), (1, 3, 1.0)], "track_id int, other int, k5 double")
    counted = diversity.count_in_pieces(pairs, plays, ["k5"])
    assert counted.count()
    counted.explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out


@pytest.mark.parametrize("at_a_time", [2_000_000, 40, 1])
def test_diversity_in_cells_forms_no_pair(spark, plays, monkeypatch, at_a_time):
    """Beyond a broadcast, few listeners a pair: cells of lists and listeners, long matches in parts, one listener in several rows."""
    recs = ranks.topk_per_user(plays.select("user_id", "track_id", F.col("playcount").cast("double").alias("prediction")), 6)
    near = sorted(diversity.collaborative_diversity(recs, plays, [3, 6]).collect())
    monkeypatch.setattr(diversity, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(diversity, "MATCHES_PER_PAIR", 1e9)
    monkeypatch.setattr(diversity, "HEARD_BITS", 4)
    monkeypatch.setattr(diversity, "CELL_MATCHES", at_a_time)
    monkeypatch.setattr(diversity, "list_pairs", None)
    for a, b in zip(near, sorted(diversity.collaborative_diversity(recs, plays, [3, 6]).collect()), strict=True):
        assert a.k == b.k and a.diversity == pytest.approx(b.diversity)
