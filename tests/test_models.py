"""Scoring against brute force; trained models by their properties on data with a planted structure."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklight.metrics import rating
from tracklight.models import als, baseline, bpr, cells, classifiers, content, factorization, network, reconstruction, softmax
from tracklight.operators import pruned, scoring, splits
from tracklight.plans import model_queries
from tracklight.sources import io

from tests.test_prepare import TOY_10X5


def vectors_of(spark, key, n, width, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [round(float(x), 1) for x in rng.normal(size=width)]) for i in range(n)]
    rows[0] = (0, [0.0] * width)
    return rows, spark.createDataFrame(rows, f"{key} int, vector array<double>").repartition(3)


@pytest.fixture(scope="module")
def sides(spark):
    return vectors_of(spark, "user_id", 25, 4, 1), vectors_of(spark, "track_id", 60, 4, 2)


def cosines(users, tracks):
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    return np.round(unit(np.array([v for _, v in users])) @ unit(np.array([v for _, v in tracks])).T, 9)


def expected_lists(scores, seen, k, high_first=False):
    found = set()
    for u in range(scores.shape[0]):
        order = sorted((-scores[u, t], -t if high_first else t, t) for t in range(scores.shape[1]) if (u, t) not in seen)
        found |= {(u, t, rank + 1) for rank, (_, _, t) in enumerate(order[:k])}
    return found


def as_set(df):
    return {(r["user_id"], r["track_id"], r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("rows_per_block", [None, 16])
@pytest.mark.parametrize("high_first", [False, True])
def test_block_scoring_equals_brute_force(spark, sides, rows_per_block, high_first):
    (users, udf), (tracks, tdf) = sides
    seen = {(u, (u * 3 + j) % 60) for u in range(25) for j in range(u * 2)}
    sdf = spark.createDataFrame(sorted(seen), "user_id int, track_id int")
    options = dict(score=scoring.cosine_scores, rows_per_block=rows_per_block, high_track_first=high_first)
    ours = scoring.best_unseen(udf, tdf, 7, seen=sdf, **options)
    assert as_set(ours) == expected_lists(cosines(users, tracks), seen, 7, high_first)
    everything = scoring.best_unseen(udf, tdf, 100, seen=sdf, **options)
    assert everything.count() == 25 * 60 - len(seen)


@pytest.mark.parametrize("rows_per_block", [None, 16])
def test_softmax_sums_to_one(spark, sides, rows_per_block):
    (users, udf), (tracks, tdf) = sides
    whole = scoring.best_unseen(udf, tdf, 60, softmax=True, rows_per_block=rows_per_block)
    sums = whole.groupBy("user_id").agg(F.sum("prediction").alias("s")).collect()
    assert len(sums) == 25 and all(r["s"] == pytest.approx(1.0) for r in sums)
    seen = spark.createDataFrame([(3, t) for t in range(60)], "user_id int, track_id int")
    assert scoring.best_unseen(udf, tdf, 5, seen=seen, softmax=True).where("user_id = 3").count() == 0


def test_band(spark, sides):
    (users, udf), (tracks, tdf) = sides
    scores = cosines(users, tracks)
    for r in content.similar_in_range(udf, tdf, 5, 0.2, 0.6).collect():
        assert 0.2 < r["prediction"] < 0.6 and scores[r["user_id"], r["track_id"]] == r["prediction"]


def greedy(scores, similarity, n):
    found = set()
    for u in range(scores.shape[0]):
        chosen, largest = [], np.full(scores.shape[1], -np.inf)
        for rank in range(1, n + 1):
            best = min((t for t in range(scores.shape[1]) if t not in chosen), key=lambda t: (round(largest[t], 9), -scores[u, t], -t))
            chosen.append(best)
            found.add((u, best, rank))
            largest = np.maximum(largest, similarity[best])
    return found


@pytest.mark.parametrize("rows_per_block", [None, 25])
def test_spread_out_equals_brute_force(spark, sides, rows_per_block):
    (users, udf), (tracks, tdf) = sides
    ours = content.spread_out(udf, tdf, 4, rows_per_block=rows_per_block)
    assert as_set(ours) == greedy(cosines(users, tracks), cosines(tracks, tracks), 4)


def test_spread_out_in_range_reorders_the_shortlist(spark, sides):
    (_, udf), (_, tdf) = sides
    short = content.similar_in_range(udf, tdf, 6, 0.1, 0.9)
    varied = content.spread_out(udf, tdf, 6, band=(0.1, 0.9))
    key = lambda df: {(r["user_id"], r["track_id"]) for r in df.collect()}
    assert key(short) == key(varied)
    assert {t for t in as_set(short) if t[2] == 1} == {t for t in as_set(varied) if t[2] == 1}


def test_truncated_lists_equal_brute_force(spark, sides):
    (users, udf), (tracks, tdf) = sides
    train_rows = [(u, (u * 5 + j) % 60, 1) for u in range(25) for j in range(6)]
    test_rows = [(u, (u * 11 + 1) % 60, 1) for u in range(25)]
    schema = "user_id int, track_id int, playcount bigint"
    train, test = spark.createDataFrame(train_rows, schema), spark.createDataFrame(test_rows, schema)
    known = {t for _, t, _ in train_rows + test_rows}
    scores, expected = cosines(users, tracks), set()
    for u in range(25):
        order = sorted(range(60), key=lambda t: (-scores[u, t], -t))[: 4 + 6]
        kept = [t for t in order if (u, t, 1) not in train_rows and t in known][:4]
        expected |= {(u, t, i + 1) for i, t in enumerate(kept)}
    assert as_set(content.recommend_similar(udf, tdf, train, test, 4, reference_truncation=True)) == expected


def test_random_lists(spark, plays):
    recs = baseline.recommend(plays, 8)
    assert recs.join(plays, ["user_id", "track_id"]).count() == 0
    sizes = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.max("rank").alias("last")).collect()
    assert all(r["n"] == r["last"] == 8 for r in sizes)
    assert baseline.recommend(plays, 8).exceptAll(recs).count() == 0


def test_als_seeded_variants_and_blocked_scoring(spark, plays):
    model = als.fit(plays, rank=4, maxIter=3)
    users, tracks = als.factors(model)
    again = als.factors(als.fit(plays, rank=4, maxIter=3))[0]
    assert sorted(map(tuple, ((r[0], tuple(r[1])) for r in users.collect()))) == sorted((r[0], tuple(r[1])) for r in again.collect())
    recs = als.recommend(model, plays, 5)
    assert recs.join(plays, ["user_id", "track_id"]).count() == 0
    by_transform = model.transform(recs.select("user_id", "track_id", F.col("prediction").alias("ours")))
    assert all(r["ours"] == pytest.approx(r["prediction"], abs=1e-5) for r in by_transform.collect())
    for name, (_, tracks) in als.fit_variants(plays, rank=3, maxIter=2).items():
        smallest = tracks.agg(F.min(F.array_min("vector"))).first()[0]
        assert smallest >= 0 or "NN" not in name


def test_als_grid_and_selection(spark, plays):
    assert len(als.grid(als.estimator())) == 192
    chosen = als.select(plays, {"rank": [2, 4]}, n_folds=2, maxIter=2)
    scores = als.grid_scores(chosen)
    best = min(scores, key=lambda r: r["roem"])
    assert chosen.bestModel.rank == best["rank"] and all(0 <= r["roem"] <= 1 for r in scores)


def group_share(recs):
    own = recs.where(F.col("user_id") != 3).select(((F.col("user_id") - F.col("track_id")) % 2 == 0).cast("int").alias("own"))
    return own.agg(F.avg("own")).first()[0]


def test_models_find_the_planted_groups(spark, plays):
    random_share = group_share(baseline.recommend(plays, 5))
    assert group_share(als.recommend(als.fit(plays, rank=4, maxIter=5), plays, 5)) > max(0.8, random_share)
    users, tracks = bpr.fit(plays, width=4, epochs=8)
    recs = bpr.recommend(users, tracks, plays, 5)
    assert group_share(recs) > max(0.8, random_share)
    assert recs.join(plays, ["user_id", "track_id"]).count() == 0
    binary = splits.add_negatives(plays.withColumn("playcount", F.lit(1).cast("bigint")), 20)
    users, tracks = cells.fit_nonnegative(factorization.as_ratings(binary), 4, 10)
    assert tracks.agg(F.min(F.array_min("vector"))).first()[0] >= 0
    assert group_share(als.recommend_factors(users, tracks, plays, 5)) > 0.8


@pytest.mark.parametrize("cosine, band, high", [(False, None, False), (True, None, True), (True, (0.2, 0.6), True)])
def test_pruned_lists_skip_cells_and_lose_nothing(spark, cosine, band, high):
    """Planted directions and lengths, zero vectors, ties and seen tracks; lists as from the whole product."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(12, 6)) * 4
    tracks = [(i, (centres[i % 12] * rng.uniform(0.2, 2) + rng.normal(size=6) * 0.2).round(2).tolist()) for i in range(600)]
    tracks += [(600 + i, [0.0] * 6) for i in range(5)] + [(700 + i, tracks[i][1]) for i in range(10)]
    users = [(i, ((centres[i % 12] + rng.normal(size=6) * 0.2) * (0.05 if i % 2 else 3)).round(3).tolist()) for i in range(40)] + [(99, [0.0] * 6)]
    seen = [(u, t) for u, _ in users for t in rng.integers(0, 600, 25).tolist()]
    u, v = (np.array([x for _, x in rows]) for rows in (users, tracks))
    if cosine:
        u, v = scoring.unit_rows(u), scoring.unit_rows(v)
    scores, want = np.round(u @ v.T, 9), set()
    masked = set(seen)
    for row, (user, _) in enumerate(users):
        own = [(scores[row, c], t) for c, (t, _) in enumerate(tracks) if (user, t) not in masked and (band is None or band[0] < scores[row, c] < band[1])]
        own.sort(key=lambda x: (-x[0], -x[1] if high else x[1]))
        want |= {(user, t, s, r + 1) for r, (s, t) in enumerate(own[:7])}
    frames = [spark.createDataFrame(rows, f"{key} int, vector array<double>").repartition(3) for rows, key in ((users, "user_id"), (tracks, "track_id"))]
    found, cells = pruned.pruned_lists(
        *frames, 7, seen=spark.createDataFrame(seen, "user_id int, track_id int"), cosine=cosine, band=band, high_track_first=high, rows_per_block=40
    )
    assert {(r.user_id, r.track_id, r.prediction, r.rank) for r in found.collect()} == want
    assert cells["visited"] < 0.9 * cells["possible"]


def test_block_returns_only_what_reaches_the_list_so_far():
    """Ties at the floor stay, masked cells never return, a row without a list so far gets its best k."""
    rng = np.random.default_rng(3)
    scores = np.round(rng.normal(size=(30, 50)), 1)
    scores[rng.random(scores.shape) < 0.2] = -np.inf
    floor = np.where(np.arange(30) % 3 == 0, -np.inf, np.round(rng.normal(size=30), 1))
    rows, cols, values, position = scoring._best(scores, 7, True, floor)
    want = []
    for row, least in enumerate(floor):
        best = sorted(((s, c) for c, s in enumerate(scores[row]) if np.isfinite(s)), key=lambda x: (-x[0], -x[1]))[:7]
        want += [(row, c, s, n + 1) for n, (s, c) in enumerate(best) if s >= least]
    assert list(zip(rows, cols, values, position)) == want
    assert len(want) < 30 * 7


def test_pairwise_gradients_of_a_cell_by_loops():
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(7, 4)), rng.normal(size=(9, 4))
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 6, 30), rng.integers(0, 9, 30))})
    user, heard = (np.array(x) for x in zip(*pairs))
    draw = rng.integers(0, 1 << 40, len(pairs))
    gu, gv, has_u, has_v = bpr.cell_gradients(u, v, user, heard, draw, 0.01)
    want_u, want_v, met_u, met_v = np.zeros_like(u), np.zeros_like(v), set(), set()
    for a, i, d in zip(user, heard, draw):
        j = d % len(v)
        if (a, j) in pairs:
            continue
        pull = 1 / (1 + np.exp(u[a] @ (v[i] - v[j])))
        want_u[a] += pull * (v[i] - v[j]) - 0.01 * u[a]
        want_v[i] += pull * u[a] - 0.01 * v[i]
        want_v[j] += -pull * u[a] - 0.01 * v[j]
        met_u.add(a)
        met_v |= {i, j}
    assert np.allclose(gu, want_u) and np.allclose(gv, want_v)
    assert set(np.flatnonzero(has_u)) == met_u and set(np.flatnonzero(has_v)) == met_v


@pytest.mark.parametrize("width, rows", [(4, 7), (40, None), (40, 9)])
def test_pairwise_ranking_in_many_cells_finds_the_groups(plays, width, rows):
    """Small blocks, each with its own draws, and wide factors, which move outside generated code."""
    users, tracks = bpr.fit(plays, width=width, epochs=8, rows_per_block=rows)
    assert users.count() == 40 and {len(r.vector) for r in users.collect()} == {width + 1}
    assert group_share(bpr.recommend(users, tracks, plays, 5)) > 0.8


def test_draws_from_all_tracks_do_not_need_them_in_one_cell(plays):
    """Cells of small blocks of users and tracks give the factors of cells that hold every track."""
    whole, parts = (bpr.fit(plays, width=4, epochs=3, rows_per_block=rows, track_blocks=1) for rows in (None, 16))
    for one, other in zip(whole, parts):
        key = one.columns[0]
        want, got = ({r[key]: r.vector for r in side.collect()} for side in (one, other))
        assert want.keys() == got.keys()
        for k in want:
            assert got[k] == pytest.approx(want[k], abs=1e-9)
    users, track_blocks = bpr.draw_shape(*parts, plays, 16)
    assert users * 16 >= 40 and track_blocks == 4  # 60 tracks


def test_wide_steps_equal_narrow_ones(spark):
    """The step outside generated code gives what the expressions give."""
    state = spark.createDataFrame([(i, [0.5 * i, -1.0, 2.0], float(i)) for i in range(4)], "user_id int, vector array<double>, power double")
    gradient = spark.createDataFrame([(i, [1.0, i * 0.1, 0.0]) for i in (0, 2, 3)], "user_id int, g array<double>")
    narrow = sorted(bpr._moved(state, gradient, "user_id", 2, 0.5).collect())
    limit, bpr.UNROLLED = bpr.UNROLLED, 2
    try:
        wide = sorted(bpr._moved(state, gradient, "user_id", 2, 0.5).collect())
    finally:
        bpr.UNROLLED = limit
    for a, b in zip(narrow, wide, strict=True):
        assert a.user_id == b.user_id and np.allclose(a.vector, b.vector) and np.isclose(a.power, b.power)


@pytest.fixture(scope="module")
def toy(spark):
    return io.literal_ratings(spark, TOY_10X5)


def test_explicit_factorization_rebuilds_the_toy(spark, toy):
    model = factorization.fit_explicit(toy, 3, 10)
    scored = model.transform(toy)
    assert rating.rating_errors(scored, "rating").first()["rmse"] < 0.2


def observed(ratings):
    """Ratings by user and track, and start factors as dictionaries."""
    users, tracks = factorization.start_factors(ratings, 3)
    cells_ = sorted((r["user_id"], r["track_id"], r["rating"]) for r in ratings.collect())
    return cells_, {r[0]: np.array(r[1]) for r in users.collect()}, {r[0]: np.array(r[1]) for r in tracks.collect()}


@pytest.mark.parametrize("rows", [None, 3])
def test_multiplicative_updates_by_loops(toy, rows):
    from collections import defaultdict

    rated, u, v = observed(toy)
    losses = [cells.penalised_error(toy, *factorization.start_factors(toy, 3), 0.06)]
    for epoch in (1, 2, 3):
        for own, other, at, to in ((u, v, 0, 1), (v, u, 1, 0)):
            up, down = defaultdict(lambda: np.zeros(3)), defaultdict(lambda: np.zeros(3))
            for row in rated:
                x, y = own[row[at]], other[row[to]]
                up[row[at]] += row[2] * y
                down[row[at]] += x @ y * y + 0.06 * x
            for key, x in list(own.items()):
                own[key] = x * up[key] / (down[key] + 1e-9)
        ours = cells.fit_nonnegative(toy, 3, epoch, rows=rows)
        for side, expected in zip(ours, (u, v)):
            found = {r[0]: np.array(r[1]) for r in side.collect()}
            assert found.keys() == expected.keys() and all((found[k] >= 0).all() and np.allclose(found[k], expected[k]) for k in found)
        losses.append(cells.penalised_error(toy, *ours, 0.06))
    assert losses == sorted(losses, reverse=True)


@pytest.mark.parametrize("blocks", [1, 3])
def test_stochastic_steps_equal_a_loop_over_ratings(spark, toy, blocks):
    rated, u, v = observed(toy)
    keyed = toy.select("user_id", "track_id", scoring.block_of("user_id", blocks).alias("a"), scoring.block_of("track_id", blocks).alias("b"))
    block = {(r["user_id"], r["track_id"]): ((r["b"] - r["a"]) % blocks, r["a"]) for r in keyed.collect()}
    for _ in range(2):
        for i, j, r in sorted(rated, key=lambda row: (*block[row[:2]], *row[:2])):
            error = r - u[i] @ v[j]
            u[i] = u[i] + 0.01 * (2 * error * v[j] - 0.04 * u[i])
            v[j] = v[j] + 0.01 * (2 * error * u[i] - 0.04 * v[j])
    for side, expected in zip(cells.fit_stochastic(toy, 3, 2, rate=0.01, blocks=blocks), (u, v)):
        found = {r[0]: np.array(r[1]) for r in side.collect()}
        assert found.keys() == expected.keys() and all(np.allclose(found[k], expected[k]) for k in found)


def test_cell_factorizations_of_nothing_and_block_numbers(spark, toy, monkeypatch):
    none = toy.where("false")
    for users, tracks in (cells.fit_nonnegative(none, 3, 1), cells.fit_stochastic(none, 3, 1)):
        assert users.count() == tracks.count() == 0
    assert cells.blocks_of(none, 3) == 1 and cells.blocks_of(toy, 3) == 1 and cells.blocks_of(toy, 3, rows=4) == 3
    monkeypatch.setattr(cells, "CELL_RATINGS", 2)
    assert cells.blocks_of(toy, 3) == int(np.ceil(np.sqrt(toy.count() / 2)))


def test_blocks_follow_the_bytes_of_their_factors(spark):
    """Narrow factors make few blocks: a factor is copied once per block of the other side."""
    wide = spark.range(140_000).select(F.lit(1).alias("user_id"), F.col("id").alias("track_id"), F.lit(1.0).alias("rating"))
    assert cells.blocks_of(wide, 8) == 1 and cells.blocks_of(wide, 64) == 3


def test_gradient_steps_lower_the_loss(spark, toy):
    users, tracks = factorization.start_factors(toy, 3)
    losses = []
    for _ in range(3):
        losses.append(factorization.penalised_rmse(toy, users, tracks).first()[0])
        users, tracks = (spark.createDataFrame(df.collect(), df.schema) for df in factorization.gradient_step(toy, users, tracks, 3, rate=0.01))
    assert losses == sorted(losses, reverse=True)


@pytest.mark.parametrize("rows", [None, 4])
def test_spread_step_equals_brute_force(spark, sides, rows):
    _, (tracks, tdf) = sides
    v = np.array([x for _, x in tracks])
    expected = v.copy()
    for a in range(len(v)):
        for b in range(len(v)):
            similarity = v[a] @ v[b] / (np.linalg.norm(v[a]) * np.linalg.norm(v[b]) + 1e-10)
            expected[a] += np.clip(0.5 * 0.4 * (1 - similarity) / 4 * (v[a] - v[b]), -0.01, 0.01)
    moved = {r[0]: r[1] for r in factorization.spread_step(tdf, 4, 0.5, 0.4, rows=rows).collect()}
    assert all(moved[i] == pytest.approx(list(expected[i])) for i in range(len(v)))


def test_weighted_factorization(spark, toy):
    losses = []
    for n in (1, 3, 8):
        users, tracks = factorization.fit_weighted(toy, 3, n)
        losses.append(factorization.weighted_loss(toy, users, tracks, 3))
    assert losses == sorted(losses, reverse=True)
    scored = factorization.predict(toy, users, tracks)
    assert rating.rating_errors(scored, "rating").first()["rmse"] < 1.0
    u = np.array([r["vector"] for r in users.orderBy("user_id").collect()])
    v = np.array([r["vector"] for r in tracks.orderBy("track_id").collect()])
    r = np.array(TOY_10X5, dtype=float)
    w = np.where(r > 0, 1, 0.01)
    dense = (w * (r - u @ v.T) ** 2).sum() + 0.02 * (5 * (u**2).sum() + 10 * (v**2).sum())
    assert losses[-1] == pytest.approx(dense)
    whole = {x["user_id"]: x["row_sum"] for x in factorization.reconstructed_rows(users, tracks, 3).collect()}
    assert all(whole[i] == pytest.approx((u @ v.T)[i].sum()) for i in whole)


def test_recommend_clips_after_ordering(spark, toy):
    users, tracks = factorization.start_factors(toy, 3)
    recs = factorization.recommend(users, tracks, toy, 5)
    assert recs.join(toy, ["user_id", "track_id"]).count() == 0
    assert recs.agg(F.min("prediction")).first()[0] >= 1.0


def test_autoencoder_and_low_rank(spark, sides):
    _, (tracks, tdf) = sides
    scaled = tdf.withColumn("vector", F.transform("vector", lambda x: 1.0 / (1.0 + F.exp(-x))))
    model = reconstruction.Autoencoder(4, 8).fit(scaled, epochs=30, rate=0.05)
    assert model.losses[-1] < model.losses[0]
    errors = reconstruction.reconstruction_errors(scaled, model.reconstruct(scaled))
    assert errors.count() == 60 and errors.agg(F.avg("error")).first()[0] < model.losses[0]
    full = reconstruction.reconstruction_errors(tdf, reconstruction.reconstruct_linear(tdf, 4))
    assert full.agg(F.max("error")).first()[0] < 1e-12
    part = reconstruction.reconstruction_errors(tdf, reconstruction.reconstruct_linear(tdf, 2))
    assert part.agg(F.max("error")).first()[0] > 1e-3


@pytest.mark.parametrize("loss", ["squares", "entropy"])
def test_network_gradient_by_differences(loss):
    rng = np.random.default_rng(4)
    net = network.Network([5, 4, 3, 2], loss)
    net.set_flat(net.flat() + rng.normal(size=net.flat().size) * 0.3)
    x, y, w = rng.normal(size=(9, 5)), rng.integers(0, 2, (9, 2)).astype(float), rng.uniform(0.5, 4, 9)
    flat = net.flat()
    gradient, _ = net.gradient(x, y, w)
    for i in range(flat.size):
        sides = []
        for sign in (1, -1):
            moved = flat.copy()
            moved[i] += sign * 1e-6
            sides.append(net.set_flat(moved).gradient(x, y, w)[1])
        assert gradient[i] == pytest.approx((sides[0] - sides[1]) / 2e-6, abs=1e-7)


@pytest.mark.parametrize("shard_bytes", [1 << 26, 20_000])
def test_autoencoder_learns_a_planted_rank(spark, shard_bytes):
    """In one shard and in averaged ones: below the column mean, near the linear rebuild of the same rank."""
    rng = np.random.default_rng(8)
    x = 1 / (1 + np.exp(-(rng.normal(size=(800, 3)) @ rng.normal(size=(3, 12)))))
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "track_id int, vector array<double>").repartition(3)
    model = reconstruction.Autoencoder(12, 8).fit(vectors, epochs=60, batch=32, rate=0.01, shard_bytes=shard_bytes)
    error = reconstruction.reconstruction_errors(vectors, model.reconstruct(vectors)).agg(F.avg("error")).first()[0]
    linear = reconstruction.reconstruction_errors(vectors, reconstruction.reconstruct_linear(vectors, 3)).agg(F.avg("error")).first()[0]
    mean = ((x - x.mean(axis=0)) ** 2).mean()
    assert len(model.losses) == 60 and model.losses[-1] < model.losses[0]
    assert error < 0.1 * mean and error < 1.5 * linear


@pytest.mark.parametrize("shard_bytes", [1 << 26, 60_000])
def test_pair_network_uses_weights_and_finds_the_groups(spark, shard_bytes):
    """Users hear tracks of their group; drawn unheard pairs stand for many."""
    rng = np.random.default_rng(6)
    rows = []
    for user in range(60):
        for track in range(60):
            same = user % 2 == track % 2
            heard = same and rng.random() < 0.7
            if heard or rng.random() < 0.25:
                features = [float(user % 2), 1.0 - user % 2, float(track % 2), 1.0 - track % 2]
                rows.append((user, track, int(heard), 1.0 if heard else 4.0, features))
    pairs = spark.createDataFrame(rows, "user_id int, track_id int, label int, weight double, features array<double>").repartition(3)
    model = classifiers.fit_pair_network(pairs, 2, epochs=40, batch=64, rate=0.01, shard_bytes=shard_bytes)
    scored = classifiers.pair_probabilities(model, pairs).join(pairs.select("user_id", "track_id", "weight"), ["user_id", "track_id"]).toPandas()
    share = (scored.label * scored.weight).sum() / scored.weight.sum()
    assert (scored.prediction * scored.weight).sum() / scored.weight.sum() == pytest.approx(share, abs=0.03)
    ranks_ = scored.prediction.rank()
    ones = scored.label == 1
    auc = (ranks_[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert auc > 0.8


def test_softmax_gradients_by_differences():
    rng = np.random.default_rng(9)
    x, layer, v = rng.normal(size=(6, 3)), rng.normal(size=(4, 5)), rng.normal(size=(7, 5))
    layer[:, -1] = 0
    user, track = np.array([0, 0, 1, 3, 3, 3, 5]), np.array([1, 4, 4, 0, 2, 6, 6])
    gl, gv, _ = softmax.cell_gradients(x, layer, v, user, track, 7.0)
    loss = lambda l, t: softmax.cell_gradients(x, l, t, user, track, 7.0)[2]
    for which, gradient in ((0, gl), (1, gv)):
        for at in np.ndindex(gradient.shape):
            if which == 0 and at[1] == layer.shape[1] - 1:
                assert gradient[at] == 0
                continue
            sides = []
            for sign in (1, -1):
                moved = [layer.copy(), v.copy()]
                moved[which][at] += sign * 1e-6
                sides.append(loss(*moved))
            assert -gradient[at] == pytest.approx((sides[0] - sides[1]) / 2e-6, abs=1e-7)


@pytest.mark.parametrize("rows", [None, 20])
def test_trained_softmax_finds_the_groups(spark, plays, rows):
    """Also where a block of tracks is a sample of them; lists have different scores and sum to less than one."""
    profiles = spark.createDataFrame([(u, [float(u % 2), 1.0 - u % 2, 1.0]) for u in range(40)], "user_id int, vector array<double>")
    model = softmax.fit(plays, profiles, units=8, epochs=25, rate=0.5, rows_per_block=rows)
    assert len(model.losses) == 25 and model.losses[-1] < 0.95 * model.losses[0]
    recs = model.recommend(profiles, plays, 5)
    assert group_share(recs) > 0.9 and recs.join(plays, ["user_id", "track_id"]).count() == 0
    spread = recs.groupBy("user_id").agg(F.count_distinct("prediction").alias("n"), F.sum("prediction").alias("p"))
    assert spread.agg(F.min("n")).first()[0] > 1 and spread.agg(F.max("p")).first()[0] < 1


def test_pair_network_scores_in_blocks_like_its_transform(spark, sides, plays):
    (_, udf), (_, tdf) = sides
    train = plays.where("user_id < 25")
    pairs = classifiers.pair_training_set(train, udf, tdf, 10)
    assert pairs.where("label = 1").count() == train.count()
    model = classifiers.fit_pair_network(pairs, 4, epochs=2)
    recs = classifiers.recommend_by_pairs(model, udf, tdf, train, 5)
    assert recs.join(train, ["user_id", "track_id"]).count() == 0
    joined = recs.join(udf.select("user_id", F.col("vector").alias("u")), "user_id").join(tdf.select("track_id", F.col("vector").alias("v")), "track_id")
    checked = classifiers.pair_probabilities(model, joined.select("user_id", "track_id", F.lit(0).alias("label"), F.concat("u", "v").alias("features")))
    both = recs.withColumnRenamed("prediction", "ours").join(checked, ["user_id", "track_id"]).collect()
    assert len(both) == 125 and all(r["ours"] == pytest.approx(r["prediction"], abs=1e-8) for r in both)


def test_genre_network(spark, sides, plays):
    (_, udf), (tracks, tdf) = sides
    labels = spark.createDataFrame([(t, int(v[0] > 0)) for t, v in tracks], "track_id int, idx int")
    model = classifiers.fit_genre_network(tdf, labels, 4, 2, iterations=20)
    recs = classifiers.recommend_by_genre(model, udf, labels, 2, plays, 5)
    assert recs.join(plays, ["user_id", "track_id"]).count() == 0 and recs.agg(F.max("rank")).first()[0] == 5


def test_playlist_has_names(spark, plays):
    recs = baseline.recommend(plays, 3)
    songs = spark.createDataFrame([(t, f"song {t}", "band") for t in range(60)], "track_id int, name string, artist string")
    ids = spark.createDataFrame([(f"T{t}", t) for t in range(60)], "key string, idx int")
    rows = baseline.playlist(recs, songs, ids).collect()
    assert len(rows) == recs.count() and all(r["original_id"] == f"T{r['track_id']}" and r["name"] == f"song {r['track_id']}" for r in rows)


def implicit_loss(rows, users, tracks, reg, alpha):
    u = {r["user_id"]: np.array(r["vector"]) for r in users.collect()}
    v = {r["track_id"]: np.array(r["vector"]) for r in tracks.collect()}
    plays, loss = {(a, b): c for a, b, c in rows}, 0.0
    for a in u:
        for b in v:
            r = plays.get((a, b), 0)
            loss += (1 + alpha * r) * ((r > 0) - u[a] @ v[b]) ** 2
    for a, b in plays:
        loss += reg * (u[a] @ u[a] + v[b] @ v[b])
    return loss


@pytest.mark.parametrize("nonnegative", [False, True])
def test_als_by_sums_reaches_the_loss_of_spark_ml(spark, plays, history_rows, nonnegative):
    settings = dict(rank=4, maxIter=8, regParam=0.05, alpha=2.0, nonnegative=nonnegative)
    ours = als.fit_by_sums(plays, **settings)
    theirs = als.factors(als.fit(plays, **settings))
    assert implicit_loss(history_rows, *ours, 0.05, 2.0) <= 1.1 * implicit_loss(history_rows, *theirs, 0.05, 2.0)
    if nonnegative:
        assert ours[1].agg(F.min(F.array_min("vector"))).first()[0] >= 0
    spread = als.fit_by_sums(plays, **{**settings, "maxIter": 1}, hot_rows=5)
    whole = als.fit_by_sums(plays, **{**settings, "maxIter": 1})
    for a, b in zip(spread, whole):
        left, right = ({r[0]: r[1] for r in df.collect()} for df in (a, b))
        assert left.keys() == right.keys() and all(left[i] == pytest.approx(right[i], abs=1e-6) for i in left)


def test_explicit_als_by_sums(spark, toy):
    ratings = toy.withColumn("playcount", F.col("rating").cast("bigint"))
    users, tracks = als.fit_by_sums(ratings, rank=3, maxIter=10, regParam=0.02, implicitPrefs=False, nonnegative=False)
    assert rating.rating_errors(factorization.predict(ratings, users, tracks)).first()["rmse"] < 0.2


def test_blocks_follow_the_ratings(spark, plays):
    assert als.blocks(plays) == {"numUserBlocks": 10, "numItemBlocks": 10}
    assert als.blocks(plays, block_rows=20)["numUserBlocks"] == -(-plays.count() // 20)


def test_users_with_only_zero_plays_are_listed(spark):
    ratings = spark.createDataFrame([(0, 1, 0), (1, 1, 3), (1, 2, 0)], "user_id int, track_id int, playcount bigint")
    users, tracks = als.fit_by_sums(ratings, rank=2, maxIter=2)
    assert users.count() == 2 and tracks.count() == 2


def test_merge_sorted_adds_across_batches():
    from tracklight.models.solver import merge_sorted

    batches = [(np.array([1, 1, 2]), np.ones((3, 2))), (np.array([2, 2]), np.ones((2, 2))), (np.array([], dtype=int), np.ones((0, 2))), (np.array([3]), np.ones((1, 2)))]
    merged = [(k, s[0]) for keys, sums in merge_sorted(iter(batches)) for k, s in zip(keys, sums.tolist())]
    assert merged == [(1, 2.0), (2, 3.0), (3, 1.0)]


def test_names_beyond_the_limit_are_not_broadcast(spark, plays, monkeypatch, capsys):
    monkeypatch.setattr(baseline, "BROADCAST_BYTES", 0)
    songs = spark.createDataFrame([(t, f"song {t}", "artist") for t in range(60)], "track_id int, name string, artist string")
    ids = spark.createDataFrame([(f"T{t}", t) for t in range(60)], "key string, idx int")
    recs = spark.createDataFrame([(u, t, 1, 0.5) for u in range(3) for t in range(5)], "user_id int, track_id int, rank int, prediction double")
    named = baseline.playlist(recs, songs, ids)
    assert named.count() == 15 and {"name", "original_id"} < set(named.columns)
    named.explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out


def test_als_grid_fits_every_point_of_the_grid(spark, folder, monkeypatch):
    """The query takes the whole grid with its ranks and iterations, not a few points of its own."""
    fitted, plain = [], als.fit
    monkeypatch.setattr(als, "GRID", {"rank": [2, 3], "maxIter": [1, 2], "regParam": [0.1], "alpha": [20.0]})
    monkeypatch.setattr(als, "fit", lambda train, **settings: fitted.append(settings) or plain(train, **settings))
    rows = model_queries.als_grid(spark, folder).collect()
    assert {(r.rank, r.maxIter) for r in rows} == {(f["rank"], f["maxIter"]) for f in fitted} == {(a, b) for a in (2, 3) for b in (1, 2)}
    assert all(0 < r.roem < 1 for r in rows)


def test_als_variants_take_the_chosen_settings(spark, folder, monkeypatch):
    seen, plain = [], als.estimator
    monkeypatch.setattr(als, "CHOSEN", {**als.CHOSEN, "maxIter": 1, "rank": 3})
    monkeypatch.setattr(als, "estimator", lambda *given, **settings: seen.append(plain(*given, **settings)) or seen[-1])
    rows = model_queries.als_variants(spark, folder).collect()
    assert {(e.getRank(), e.getMaxIter()) for e in seen} == {(3, 1)} and len(seen) == 4
    assert {r.algo for r in rows} == set(als.VARIANTS)


def test_bpr_trains_with_the_published_settings(spark, folder, monkeypatch):
    import inspect

    asked, plain = [], bpr.fit
    monkeypatch.setattr(bpr, "fit", lambda train, **settings: asked.append(settings) or plain(train, width=3, epochs=1))
    assert model_queries.bpr_lists(spark, folder).count()
    defaults = {n: p.default for n, p in inspect.signature(plain).parameters.items()}
    assert [({**defaults, **a}["width"], {**defaults, **a}["epochs"]) for a in asked] == [(200, 100)]


def test_nmf_trains_with_the_published_settings(spark, folder, monkeypatch):
    import inspect

    asked, plain = [], cells.fit_nonnegative
    monkeypatch.setattr(cells, "fit_nonnegative", lambda ratings, *given, **settings: asked.append((ratings, *given)) or plain(ratings, 3, 1))
    assert model_queries.nmf(spark, folder).count()
    taken = inspect.signature(plain).bind(*asked[0])
    taken.apply_defaults()
    assert (taken.arguments["width"], taken.arguments["epochs"]) == (200, 100)


@pytest.mark.parametrize("far", [0, 3, 30])
def test_spread_step_sums_what_no_limit_touches(spark, monkeypatch, far):
    """Pairs are formed only for tracks that may reach the limit or have almost no length."""
    rng = np.random.default_rng(5)
    v = rng.uniform(size=(40, 4))
    v[0], v[1] = 0.0, [0.002, 0.0, 0.0, 0.0]
    v[40 - far :] *= 300.0
    if far:
        v[2] = 1e-6
    tdf = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "track_id int, vector array<double>").repartition(3)
    asked, plain = [], factorization._cell_pushes
    monkeypatch.setattr(factorization, "_cell_pushes", lambda mine, theirs, *rest: asked.append((mine.count(), theirs.count())) or plain(mine, theirs, *rest))
    lengths = np.linalg.norm(v, axis=1)
    similarity = (v @ v.T) / (lengths[:, None] * lengths[None, :] + 1e-10)
    push = 0.01 * 0.04 * (1 - similarity)[:, :, None] / 4 * (v[:, None, :] - v[None, :, :])
    assert far == 0 or (np.abs(push) > 0.01).any()
    expected = v + np.clip(push, -0.01, 0.01).sum(axis=1)
    moved = {r[0]: r[1] for r in factorization.spread_step(tdf, 4, 0.01, 0.04).collect()}
    assert all(moved[i] == pytest.approx(list(expected[i]), abs=1e-12) for i in range(len(v)))
    assert asked == ([] if not far else [(far + 1, 40), (39 - far, far + 1)])


def test_truncated_lists_count_seen_and_unknown_tracks_only(spark):
    """Ties, a track of no length, users with few tracks left and tracks nobody knows; scores of known unheard tracks are never counted."""
    rng = np.random.default_rng(9)
    v = rng.integers(0, 3, size=(40, 3)).astype(float)
    u = rng.integers(0, 3, size=(9, 3)).astype(float) + 0.5
    frame = lambda m, key: spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], f"{key} int, vector array<double>")
    heard = {(a, (a * 5 + 3 * j) % 28) for a in range(9) for j in range(2 + 2 * a)}
    train = spark.createDataFrame([(a, t, 1) for a, t in sorted(heard)], "user_id int, track_id int, playcount bigint")
    test = spark.createDataFrame([(0, t, 1) for t in range(28)], "user_id int, track_id int, playcount bigint")
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    scores, expected = np.round(unit(u) @ unit(v).T, 9), set()
    for a in range(9):
        n = sum(x == a for x, _ in heard)
        order = sorted(range(40), key=lambda t: (-scores[a, t], -t))[: 5 + n]
        expected |= {(a, t, i + 1) for i, t in enumerate([t for t in order if (a, t) not in heard and t < 28][:5])}
    assert as_set(content.recommend_similar(frame(u, "user_id"), frame(v, "track_id"), train, test, 5, reference_truncation=True)) == expected
    others = content._others_before(frame(u, "user_id"), frame(v, "track_id"), content.recommend_similar(frame(u, "user_id"), frame(v, "track_id"), train, test, 5), train, test)
    assert others.select(F.explode("others.n").alias("n")).agg(F.sum("n")).first()[0] <= len(heard) + 9 * 12


@pytest.mark.parametrize("copies", [1, 3])
def test_spread_out_goes_by_chosen_sets(spark, monkeypatch, copies):
    """Users share sets; equal tracks, in several blocks, are one; a user's own match decides among different ones."""
    rng = np.random.default_rng(11)
    v = np.repeat(np.vstack([rng.uniform(0.1, 1.0, size=(14, 3)), np.eye(3)]), copies, axis=0)
    u = rng.uniform(0.1, 1.0, size=(30, 3)).round(1)
    users, tracks = ([(i, [float(x) for x in row]) for i, row in enumerate(m)] for m in (u, v))
    frame = lambda rows, key: spark.createDataFrame(rows, f"{key} int, vector array<double>").repartition(3)
    told, plain = [], content._picked_by_set
    monkeypatch.setattr(content, "_picked_by_set", lambda *given: told.append(plain(*given)) or told[-1])
    ours = content.spread_out(frame(users, "user_id"), frame(tracks, "track_id"), 5, rows_per_block=9)
    assert as_set(ours) == greedy(cosines(users, tracks), cosines(tracks, tracks), 5)
    assert len(told) == 4 and sum(picks.count() for picks, _ in told) > 0


@pytest.mark.parametrize("width, k", [(1000, 7), (30, 7), (5, 7)])
def test_best_cells_need_no_partition_of_the_rows(width, k):
    """Ties, masked cells, floors and rows without a score, whatever the threshold is taken from."""
    rng = np.random.default_rng(4)
    scores = rng.normal(size=(20, width)).round(1)
    scores[rng.uniform(size=scores.shape) < 0.2] = -np.inf
    scores[3], scores[4], scores[5, 2:] = -np.inf, 0.5, -np.inf
    for high in (False, True):
        for floor in (None, np.full(20, 0.4)):
            rows, cols, values, place = scoring._best(scores.copy(), k, high, floor)
            expected = []
            for r in range(20):
                some = [c for c in range(width) if np.isfinite(scores[r, c]) and (floor is None or scores[r, c] >= floor[r])]
                some.sort(key=lambda c: (-scores[r, c], -c if high else c))
                expected += [(r, c, scores[r, c], i + 1) for i, c in enumerate(some[:k])]
            assert list(zip(rows.tolist(), cols.tolist(), values.tolist(), place.tolist())) == expected
    if width // (4 * k) > 1:  # bounds come from maxima, many fewer than the cells
        seen, plain = [], np.partition
        try:
            np.partition = lambda a, *rest, **more: seen.append(a.shape) or plain(a, *rest, **more)
            scoring._reached(scores, k)
        finally:
            np.partition = plain
        assert seen and all(s[1] <= width // 8 for s in seen)
