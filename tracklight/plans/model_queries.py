"""Queries that fit recommenders and rank unseen tracks with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.metrics import diversity, ranking, report
from tracklight.metrics.rating import rating_errors
from tracklight.models import als, baseline, bpr, cells, classifiers, content, factorization, reconstruction, softmax
from tracklight.operators import features, splits
from tracklight.operators.skew import union_all
from tracklight.plans import shared
from tracklight.plans.checks import hash48, sql, uniform, vector_rows
from tracklight.plans.metric_queries import rounded
from tracklight.runtime import stage
from tracklight.schema import PLAYS, PREDICTION, RANK, TRACK, USER
from tracklight.sources.tables import catalogue, history, train_test

QUERIES: dict[str, tuple] = {}
# Small model sizes: the queries show that a model trains and ranks on whole tables.
ALS_SMALL = {"rank": 8, "maxIter": 3}


def query(name: str, check: str | None = None):
    def register(build):
        QUERIES[name] = (build, check)
        return build

    return register


LIST = f"{USER}, {TRACK}, {PREDICTION}, {RANK}"


@query("random_rec", sql(f"SELECT {LIST} FROM recs", "recs"))
def random_rec(spark, folder):
    return baseline.recommend(train_test(spark, folder)[0], shared.TOP)


# --- collaborative ----------------------------------------------------------------------------


@query("als_fit")
def als_fit(spark, folder):
    users, tracks = als.factors(als.fit(train_test(spark, folder)[0], **ALS_SMALL))
    sides = [users.select(F.lit("user").alias("side"), F.col(USER).alias("id"), "vector"), tracks.select(F.lit("track"), TRACK, "vector")]
    both = sides[0].union(sides[1])
    return both.select("side", "id", F.posexplode("vector").alias("factor", "value"))


@query("als_score_all")
def als_score_all(spark, folder):
    train, _ = train_test(spark, folder)
    users, tracks = als.fit_factors(train, **ALS_SMALL)
    return als.recommend_factors(users, tracks, train, shared.TOP)


@query("als_by_sums")
def als_by_sums(spark, folder):
    """The solver for histories with very long users or tracks, on the same objective."""
    train, _ = train_test(spark, folder)
    users, tracks = als.fit_by_sums(train, rank=8, maxIter=2)
    return als.recommend_factors(users, tracks, train, shared.TOP)


@query("als_variants")
def als_variants(spark, folder):
    train, test = train_test(spark, folder)
    fitted = als.fit_variants(train)
    rows = [
        ranking.ranking_at_k(als.recommend_factors(*sides, train, shared.TOP), test, report.KS).withColumn("algo", F.lit(n))
        for n, sides in fitted.items()
    ]
    return union_all(rows)


@query("als_cv_select")
def als_cv_select(spark, folder):
    """A grid of two ranks over two folds, scored by ROEM."""
    train, _ = train_test(spark, folder)
    chosen = als.select(train, {"rank": [4, 8]}, n_folds=2, maxIter=2)
    scores = spark.createDataFrame([(int(r["rank"]), r["roem"], r["std"]) for r in als.grid_scores(chosen)], "rank int, roem double, std double")
    best = chosen.bestModel.rank
    return scores.withColumn("chosen", F.col("rank") == best)


@query("als_grid")
def als_grid(spark, folder):
    """All points of the published grid, each fitted on train and scored on test by ROEM."""
    train, test = train_test(spark, folder)
    scores = als.grid_roems(train, test)
    names = ["rank", "maxIter", "regParam", "alpha", "roem"]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in scores], "rank int, maxIter int, regParam double, alpha double, roem double")


@query("bpr")
def bpr_lists(spark, folder):
    train, _ = train_test(spark, folder)
    users, tracks = bpr.fit(train)
    return bpr.recommend(users, tracks, train, shared.TOP)


def _bpr_rows(key: str, salt: str, last: str) -> str:
    values = ", ".join(f"({uniform(f"'{salt}-' || {key} || '-42-{f}'")} - 0.5) * 0.25" for f in range(4))
    return f"SELECT {key}, [{values}, {last}] AS vec FROM (SELECT DISTINCT {key} FROM train)"


EPOCH = hash48("t.user_id || '-' || t.track_id || '-42-epoch0'")


@query(
    "bpr_step",
    sql(
        """SELECT 'user' AS side, b.user_id AS id, CAST(f.f AS INTEGER) AS factor, round(b.vec[f.f + 1] + coalesce(0.5 / sqrt(power + 1e-8) * g, 0), 6) AS value
             FROM ub b CROSS JOIN (SELECT unnest(range(5)) AS f) f
             LEFT JOIN s ON s.side = 'user' AND s.id = b.user_id AND s.f = f.f LEFT JOIN p ON p.side = 'user' AND p.id = b.user_id
           UNION ALL SELECT 'track', b.track_id, CAST(f.f AS INTEGER), round(b.vec[f.f + 1] + coalesce(0.5 / sqrt(power + 1e-8) * g, 0), 6)
             FROM ib b CROSS JOIN (SELECT unnest(range(5)) AS f) f
             LEFT JOIN s ON s.side = 'track' AND s.id = b.track_id AND s.f = f.f LEFT JOIN p ON p.side = 'track' AND p.id = b.track_id""",
        "prime",
        ub=_bpr_rows("user_id", "u", "1.0"),
        ib=_bpr_rows("track_id", "i", "0.0"),
        d=f"""SELECT t.user_id, t.track_id, n.track_id AS other FROM train t CROSS JOIN prime JOIN numbered n ON n.idx = {EPOCH} % n_tracks
              WHERE NOT EXISTS (SELECT 1 FROM train x WHERE x.user_id = t.user_id AND x.track_id = n.track_id)""",
        r="""SELECT d.*, u.vec AS u, i.vec AS i, j.vec AS j, 1 / (1 + exp(list_dot_product(u.vec, i.vec) - list_dot_product(u.vec, j.vec))) AS pull
             FROM d JOIN ub u ON u.user_id = d.user_id JOIN ib i ON i.track_id = d.track_id JOIN ib j ON j.track_id = d.other""",
        g="""SELECT 'user' AS side, user_id AS id, f, pull * (i[f + 1] - j[f + 1]) - 0.001 * u[f + 1] AS g FROM r CROSS JOIN (SELECT unnest(range(4)) AS f)
             UNION ALL SELECT 'track', track_id, f, pull * u[f + 1] - 0.001 * i[f + 1] FROM r CROSS JOIN (SELECT unnest(range(5)) AS f)
             UNION ALL SELECT 'track', other, f, -pull * u[f + 1] - 0.001 * j[f + 1] FROM r CROSS JOIN (SELECT unnest(range(5)) AS f)""",
        s="SELECT side, id, f, sum(g) AS g FROM g GROUP BY 1, 2, 3",
        p="SELECT side, id, sum(g * g) AS power FROM s GROUP BY 1, 2",
    ),
)
def bpr_step(spark, folder):
    """All factors after one epoch."""
    users, tracks = bpr.fit(train_test(spark, folder)[0], width=4, epochs=1, track_blocks=1)
    return flat_factors(users, tracks)


def flat_factors(users: DataFrame, tracks: DataFrame) -> DataFrame:
    sides = [df.select(F.lit(side).alias("side"), F.col(key).alias("id"), F.posexplode("vector").alias("factor", "value")) for df, side, key in ((users, "user", USER), (tracks, "track", TRACK))]
    return union_all(sides).withColumn("value", F.round("value", 6))


@query("nmf")
def nmf(spark, folder):
    train, _ = train_test(spark, folder)
    users, tracks = cells.fit_nonnegative(factorization.as_ratings(train))
    return als.recommend_factors(users, tracks, train, shared.TOP)


MULTIPLIED = """SELECT {key}, list(x ORDER BY f) AS vec FROM (
    SELECT t.{key}, f, any_value({own}.vec[f + 1]) * sum(t.playcount * {other}.vec[f + 1])
      / (sum(list_dot_product(u.vec, i.vec) * {other}.vec[f + 1]) + 0.06 * count(*) * any_value({own}.vec[f + 1]) + 1e-9) AS x
    FROM train t JOIN {users} u ON u.user_id = t.user_id JOIN ifac i ON i.track_id = t.track_id CROSS JOIN (SELECT unnest(range(8)) AS f) GROUP BY 1, 2) GROUP BY 1"""


@query(
    "nmf_step",
    sql(
        """SELECT 'user' AS side, user_id AS id, f::INTEGER AS factor, round(vec[f + 1], 6) AS value FROM uu CROSS JOIN (SELECT unnest(range(8)) AS f)
           UNION ALL SELECT 'track', track_id, f::INTEGER, round(vec[f + 1], 6) FROM ii CROSS JOIN (SELECT unnest(range(8)) AS f)""",
        "ufac",
        "ifac",
        uu=MULTIPLIED.format(key="user_id", own="u", other="i", users="ufac"),
        ii=MULTIPLIED.format(key="track_id", own="i", other="u", users="uu"),
    ),
)
def nmf_step(spark, folder):
    """All factors after one multiplicative update of users and of tracks."""
    ratings = factorization.as_ratings(train_test(spark, folder)[0])
    return flat_factors(*cells.fit_nonnegative(ratings, 8, 1, start=shared.start_factors(spark, folder)))


@query("nmf_negatives")
def nmf_negatives(spark, folder):
    """Binary plays plus sampled zeros; only heard tracks count as seen and as popularity."""
    train, test = train_test(spark, folder)
    binary = train.withColumn(PLAYS, F.lit(1).cast("bigint"))
    rows = []
    for n in (10, 25, 50):
        sides = cells.fit_nonnegative(factorization.as_ratings(splits.add_negatives(binary, n)), 4, 2)
        metrics = ranking.ranking_at_k(als.recommend_factors(*sides, train, shared.TOP), test, report.KS)
        rows.append(metrics.withColumn("negatives", F.lit(n)))
    return union_all(rows)


@query("mf_sgd")
def mf_sgd(spark, folder):
    ratings = factorization.as_ratings(train_test(spark, folder)[0])
    fitted = factorization.predict(ratings, *cells.fit_stochastic(ratings, 3, 3))
    return fitted.agg(F.sqrt(F.avg((F.col("rating") - F.col(PREDICTION)) ** 2)).alias("rmse"))


STEP = """SELECT {key}, f AS factor, round(any_value({own}.vec[f + 1]) + 0.001 * (sum(2 * e * {other}.vec[f + 1]) - 0.04 * count(*) * any_value({own}.vec[f + 1])), 6) AS value
  FROM (SELECT t.user_id, t.track_id, t.playcount - list_dot_product(u.vec, i.vec) AS e FROM train t JOIN ufac u USING (user_id) JOIN ifac i USING (track_id)) x
  JOIN ufac u USING (user_id) JOIN ifac i USING (track_id) CROSS JOIN (SELECT unnest(range(8)) AS f) GROUP BY {key}, f"""


@query(
    "mf_gradient_step",
    sql(
        f"SELECT 'user' AS side, user_id AS id, factor::INTEGER AS factor, value FROM ({STEP.format(key='user_id', own='u', other='i')}) UNION ALL SELECT 'track', track_id, factor::INTEGER, value FROM ({STEP.format(key='track_id', own='i', other='u')})",
        "ufac",
        "ifac",
    ),
)
def mf_gradient_step(spark, folder):
    train, _ = train_test(spark, folder)
    users, tracks = shared.start_factors(spark, folder)
    users, tracks = factorization.gradient_step(factorization.as_ratings(train), users, tracks, 8)
    return flat_factors(users, tracks)


@query(
    "mf_loss",
    sql(
        "SELECT round(sqrt(avg((t.playcount - list_dot_product(u.vec, i.vec)) ** 2 + 0.02 * (list_dot_product(u.vec, u.vec) + list_dot_product(i.vec, i.vec)))), 6) AS rmse FROM train t JOIN ufac u ON u.user_id = t.user_id JOIN ifac i ON i.track_id = t.track_id",
        "ufac",
        "ifac",
    ),
)
def mf_loss(spark, folder):
    users, tracks = shared.start_factors(spark, folder)
    return rounded(factorization.penalised_rmse(factorization.as_ratings(train_test(spark, folder)[0]), users, tracks))


@query(
    "mf_diversity",
    sql(
        """SELECT a.track_id, f::INTEGER AS factor, round(any_value(a.vec[f + 1]) + sum(greatest(-0.01, least(0.01,
             0.01 * 0.04 * (1 - list_dot_product(a.vec, b.vec) / (sqrt(list_dot_product(a.vec, a.vec)) * sqrt(list_dot_product(b.vec, b.vec)) + 1e-10)) / 8 * (a.vec[f + 1] - b.vec[f + 1])))), 6) AS value
           FROM ifac a CROSS JOIN ifac b CROSS JOIN (SELECT unnest(range(8)) AS f) GROUP BY a.track_id, f""",
        "ifac",
    ),
)
def mf_diversity(spark, folder):
    """One spread step over all pairs of tracks."""
    _, tracks = shared.start_factors(spark, folder)
    moved = factorization.spread_step(tracks, 8, 0.01, 0.04)
    return moved.select(TRACK, F.posexplode("vector").alias("factor", "value")).withColumn("value", F.round("value", 6))


@query("mf_diversity_fit")
def mf_diversity_fit(spark, folder):
    train, _ = train_test(spark, folder)
    users, tracks = factorization.fit_gradient(factorization.as_ratings(train), 3, 2, rate=1e-5, diversity_weight=0.04)
    return factorization.recommend(users, tracks, train, 10)


@query("mf_recommend", sql("SELECT user_id, track_id, least(greatest(prediction, 1.0), 5.0)::DOUBLE AS prediction, rank FROM mfrecs", "mfrecs"))
def mf_recommend(spark, folder):
    users, tracks = shared.start_factors(spark, folder)
    return factorization.recommend(users, tracks, train_test(spark, folder)[0], shared.TOP)


@query("wmf")
def wmf(spark, folder):
    train, _ = train_test(spark, folder)
    users, tracks = factorization.fit_weighted(factorization.as_ratings(train), 3, 2)
    return factorization.best_unseen(users, tracks, shared.TOP, seen=train)


@query(
    "wmf_loss",
    sql(
        """SELECT round(sum(CASE WHEN t.playcount IS NULL THEN 0.01 ELSE 1 END * (coalesce(t.playcount, 0) - list_dot_product(u.vec, i.vec)) ** 2
                  + 0.02 * (list_dot_product(u.vec, u.vec) + list_dot_product(i.vec, i.vec))), 3) AS loss
           FROM ufac u CROSS JOIN ifac i LEFT JOIN train t ON t.user_id = u.user_id AND t.track_id = i.track_id""",
        "ufac",
        "ifac",
    ),
)
def wmf_loss(spark, folder):
    """The loss over all cells of the matrix, of which only the observed ones are read."""
    users, tracks = shared.start_factors(spark, folder)
    loss = factorization.weighted_loss(factorization.as_ratings(train_test(spark, folder)[0]), users, tracks, 8)
    return train_test(spark, folder)[0].agg(F.round(F.lit(loss), 3).alias("loss"))


DET = "({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"
FULL = DET.format(a="a11", b="a12", c="a13", d="a12", e="a22", f="a23", g="a13", h="a23", i="a33")
SOLVED = [
    DET.format(a="b1", b="a12", c="a13", d="b2", e="a22", f="a23", g="b3", h="a23", i="a33"),
    DET.format(a="a11", b="b1", c="a13", d="a12", e="b2", f="a23", g="a13", h="b3", i="a33"),
    DET.format(a="a11", b="a12", c="b1", d="a12", e="a22", f="b2", g="a13", h="a23", i="b3"),
]
CELLS = [(1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 3)]


@query(
    "wmf_step",
    sql(
        f"SELECT user_id, round({SOLVED[0]} / {FULL}, 6) AS u1, round({SOLVED[1]} / {FULL}, 6) AS u2, round({SOLVED[2]} / {FULL}, 6) AS u3 FROM m",
        "train",
        v=vector_rows(3, "train", "track_id", "i"),
        g="SELECT count(*) AS n, " + ", ".join(f"sum(vec[{i}] * vec[{j}]) AS g{i}{j}" for i, j in CELLS) + " FROM v",
        m="SELECT user_id, "
        + ", ".join(f"0.01 * any_value(g{i}{j}) + 0.99 * sum(vec[{i}] * vec[{j}])" + (" + 0.02 * any_value(n)" if i == j else "") + f" AS a{i}{j}" for i, j in CELLS)
        + ", "
        + ", ".join(f"sum(playcount * vec[{i}]) AS b{i}" for i in (1, 2, 3))
        + " FROM train JOIN v ON v.track_id = train.track_id CROSS JOIN g GROUP BY user_id",
    ),
)
def wmf_step(spark, folder):
    """User factors of the weighted least squares for given track factors."""
    ratings = factorization.as_ratings(train_test(spark, folder)[0])
    _, tracks = shared.start_factors(spark, folder, 3)
    users = factorization.solve_side(ratings, USER, TRACK, tracks, 3, 0.01, 0.02 * tracks.count())
    return users.select(USER, *[F.round(F.col("vector")[i], 6).alias(f"u{i + 1}") for i in range(3)])


@query("wmf_rmse", sql("SELECT round(sqrt(avg((t.playcount - list_dot_product(u.vec, i.vec)) ** 2)), 6) AS rmse FROM train t JOIN ufac u ON u.user_id = t.user_id JOIN ifac i ON i.track_id = t.track_id", "ufac", "ifac"))
def wmf_rmse(spark, folder):
    users, tracks = shared.start_factors(spark, folder)
    scored = factorization.predict(train_test(spark, folder)[0], users, tracks)
    return rounded(rating_errors(scored)).select("rmse")


@query("reconstruct_matrix", sql("SELECT user_id, count(*) AS n, round(sum(list_dot_product(u.vec, i.vec)), 6) AS row_sum, round(sum(list_dot_product(u.vec, i.vec) ** 2), 4) AS row_squares FROM ufac u CROSS JOIN ifac i GROUP BY 1", "ufac", "ifac"))
def reconstruct_matrix(spark, folder):
    users, tracks = shared.start_factors(spark, folder)
    rows = factorization.reconstructed_rows(users, tracks, 8)
    return rows.withColumn("row_sum", F.round("row_sum", 6)).withColumn("row_squares", F.round("row_squares", 4))


@query("playlist", sql("SELECT r.user_id, r.rank, r.track_id, r.prediction, c.name, c.artist FROM mfrecs r JOIN cat c ON c.track_id = r.track_id WHERE r.rank <= 10", "mfrecs", "cat"))
def playlist(spark, folder):
    lists = shared.factor_lists(spark, folder).where(F.col(RANK) <= 10)
    return baseline.playlist(lists, catalogue(spark, folder))


@query("experiment_metrics")
def experiment_metrics(spark, folder):
    """Non-negative factorization after a ratio split: rating errors and list metrics averaged per user."""
    split = splits.split_ratio(history(spark, folder).select(USER, TRACK, PLAYS))
    train, test = (split.where(F.col("split") == s).select(USER, TRACK, PLAYS) for s in ("train", "test"))
    users, tracks = cells.fit_nonnegative(factorization.as_ratings(train), 8, 3)
    scored = factorization.predict(test, users, tracks)
    gap = F.col(PLAYS) - F.col(PREDICTION)
    errors = scored.groupBy(USER).agg(F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"))
    means = errors.agg(F.avg("mae").alias("mae"), F.avg("rmse").alias("rmse"))
    listed = ranking.ranking_at_k(als.recommend_factors(users, tracks, train, 10), test, [10])
    return listed.select("*", means.select("mae").scalar().alias("mae"), means.select("rmse").scalar().alias("rmse"))


# --- content based ----------------------------------------------------------------------------


@query("cosine_rec", sql(f"SELECT {LIST} FROM cosrecs", "cosrecs"))
def cosine_rec(spark, folder):
    train, test = train_test(spark, folder)
    return content.recommend_similar(shared.mean_profiles(spark, folder), shared.encoded(spark, folder)[1], train, test, 25)


@query(
    "cosine_rec_truncated",
    sql(
        f"""SELECT c.user_id, c.track_id, c.prediction, c.rank FROM cosrecs c
           JOIN (SELECT user_id, track_id, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id DESC) AS place FROM cosscores) p
             ON p.user_id = c.user_id AND p.track_id = c.track_id
           JOIN (SELECT user_id, count(*) AS n FROM train GROUP BY 1) s ON s.user_id = c.user_id WHERE place <= 25 + n""",
        "cosrecs",
    ),
)
def cosine_rec_truncated(spark, folder):
    train, test = train_test(spark, folder)
    return content.recommend_similar(shared.mean_profiles(spark, folder), shared.encoded(spark, folder)[1], train, test, 25, True)


@query(
    "similar_in_range",
    sql(
        f"""SELECT {LIST} FROM (SELECT user_id, track_id, prediction, CAST(row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id DESC) AS INTEGER) AS rank
             FROM cosscores WHERE prediction > 0.5 AND prediction < 0.7) WHERE rank <= 25""",
        "cosscores",
    ),
)
def similar_in_range(spark, folder):
    return content.similar_in_range(shared.mean_profiles(spark, folder), shared.encoded(spark, folder)[1], 25)


@query("diversity_rerank")
def diversity_rerank(spark, folder):
    return content.spread_out(shared.mean_profiles(spark, folder), shared.encoded(spark, folder)[1], 10)


@query("diversity_rerank_in_range")
def diversity_rerank_in_range(spark, folder):
    return content.spread_out(shared.mean_profiles(spark, folder), shared.encoded(spark, folder)[1], 10, band=(0.5, 0.7))


@query("autoencode_rec")
def autoencode_rec(spark, folder):
    train, test = train_test(spark, folder)
    _, vectors, width = shared.encoded(spark, folder)
    rebuilt = reconstruction.Autoencoder(width).fit(vectors).reconstruct(vectors)
    return content.recommend_similar(shared.mean_profiles(spark, folder), rebuilt, train, test, 25)


@query("low_rank_rec")
def low_rank_rec(spark, folder):
    train, test = train_test(spark, folder)
    _, vectors, _ = shared.encoded(spark, folder)
    rebuilt = reconstruction.reconstruct_linear(vectors, 12)
    return content.recommend_similar(shared.mean_profiles(spark, folder), rebuilt, train, test, 25)


@query(
    "reconstruction_error",
    sql(
        "SELECT a.vec_id, round(list_sum(list_transform(range(1, 65), lambda i: (a.embedding[i]::DOUBLE - b.m[i]) ** 2)) / 64, 6) AS error FROM embeddings a JOIN m b ON b.label = a.label",
        m="SELECT label, list(v ORDER BY pos) AS m FROM (SELECT label, pos, avg(v::DOUBLE) AS v FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1",
    ),
)
def reconstruction_error(spark, folder):
    """Embeddings rebuilt as the mean of their label."""
    from tracklight.functions.vectors import mean_squared_gap, sum_of
    from tracklight.sources.tables import table

    vecs = table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    sums = vecs.groupBy("label").agg(sum_of("x", 64).alias("s"), F.count(F.lit(1)).alias("n"))
    means = sums.select("label", F.transform("s", lambda v: v / F.col("n")).alias("y"))
    return vecs.join(means, "label").select("vec_id", F.round(mean_squared_gap("x", "y"), 6).alias("error"))


@query(
    "softmax_rec",
    sql(
        """SELECT user_id, track_id, round(exp(z - total), 9) AS prediction, CAST(rank AS INTEGER) AS rank FROM (
             SELECT c.*, n.total, row_number() OVER (PARTITION BY c.user_id ORDER BY z DESC, c.track_id DESC) AS rank
             FROM logits c JOIN (SELECT user_id, any_value(top) + ln(sum(exp(raw - top))) AS total
                                 FROM (SELECT *, max(raw) OVER (PARTITION BY user_id) AS top FROM logits) GROUP BY 1) n ON n.user_id = c.user_id
             WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = c.user_id AND t.track_id = c.track_id)) WHERE rank <= 25""",
        "pvec",
        "tvec",
        logits="SELECT p.user_id, t.track_id, list_dot_product(p.vec, t.vec) AS raw, round(raw, 9) AS z FROM pvec p CROSS JOIN tvec t",
    ),
)
def softmax_rec(spark, folder):
    lists = content.softmax_lists(shared.mean_profiles(spark, folder), shared.encoded(spark, folder)[1], train_test(spark, folder)[0], 25)
    return lists.withColumn(PREDICTION, F.round(PREDICTION, 9))


@query("softmax_trained_rec")
def softmax_trained_rec(spark, folder):
    """Lists of the network from profiles to tracks, trained on the history."""
    train, _ = train_test(spark, folder)
    profiles = shared.mean_profiles(spark, folder)
    return softmax.fit(train, profiles, epochs=5).recommend(profiles, train, 25)


def genre_labels(spark, folder) -> tuple[DataFrame, int]:
    labels = features.genre_features(catalogue(spark, folder)).select(TRACK, "idx")
    return labels, labels.agg(F.countDistinct("idx")).first()[0]


@query("softmax_genre_rec")
def softmax_genre_rec(spark, folder):
    _, vectors, width = shared.encoded(spark, folder)
    labels, classes = genre_labels(spark, folder)
    model = classifiers.fit_genre_network(vectors, labels, width, classes, iterations=5)
    return classifiers.recommend_by_genre(model, shared.mean_profiles(spark, folder), labels, classes, train_test(spark, folder)[0], 25)


def training_pairs(spark, folder) -> DataFrame:
    """Written once: both classifiers read the pairs for fitting and for scoring."""
    train, _ = train_test(spark, folder)
    users, (_, vectors, _) = shared.mean_profiles(spark, folder), shared.encoded(spark, folder)
    build = lambda: stage(classifiers.pair_training_set(train, users, vectors, shared.TOP), "pairs")
    return shared.once(spark, folder, "pairs", build)


@query(
    "pair_training_set",
    sql(
        """SELECT x.user_id, x.track_id, x.label, round(x.weight, 6) AS weight, round(list_sum(p.vec), 6) AS user_sum, round(list_sum(t.vec), 6) AS track_sum FROM (
             SELECT user_id, track_id, CASE WHEN playcount > 0 THEN 1 ELSE 0 END AS label, 1.0::DOUBLE AS weight FROM train
             UNION ALL SELECT d.user_id, d.track_id, 0, greatest(1.0, (p.n_tracks - s.n) / 50.0::DOUBLE) FROM drawn d CROSS JOIN prime p
               JOIN (SELECT user_id, count(*) AS n FROM train GROUP BY 1) s ON s.user_id = d.user_id) x
           JOIN pvec p ON p.user_id = x.user_id JOIN tvec t ON t.track_id = x.track_id""",
        "drawn",
        "pvec",
        "tvec",
    ),
)
def pair_training_set(spark, folder):
    width = shared.encoded(spark, folder)[2]
    part = lambda start: F.aggregate(F.slice("features", start, width), F.lit(0.0), lambda s, x: s + x)
    return training_pairs(spark, folder).select(
        USER, TRACK, "label", F.round("weight", 6).alias("weight"),
        F.round(part(1), 6).alias("user_sum"), F.round(part(width + 1), 6).alias("track_sum"),
    )


@query("pair_classifier")
def pair_classifier(spark, folder):
    _, vectors, width = shared.encoded(spark, folder)
    model = classifiers.fit_pair_network(training_pairs(spark, folder), width)
    return classifiers.recommend_by_pairs(model, shared.mean_profiles(spark, folder), vectors, train_test(spark, folder)[0], 10)


@query("pair_logistic")
def pair_logistic(spark, folder):
    pairs = training_pairs(spark, folder)
    scored = classifiers.pair_probabilities(classifiers.fit_pair_logistic(pairs, 5), pairs)
    return scored.select(USER, TRACK, "label", PREDICTION)


@query(
    "content_evaluation",
    sql(
        """SELECT round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall, round(avg(hit), 6) AS hit, round(avg(ap), 6) AS map,
                  (SELECT round(avg(d), 6) FROM (SELECT a.user_id, avg(list_cosine_distance(x.vec, y.vec)) AS d FROM cosrecs a JOIN cosrecs b ON a.user_id = b.user_id AND a.track_id < b.track_id
                     JOIN tvec x ON x.track_id = a.track_id JOIN tvec y ON y.track_id = b.track_id GROUP BY 1)) AS diversity
           FROM (SELECT l.user_id, coalesce(h, 0) / n::DOUBLE AS precision, coalesce(h, 0) / n_truth::DOUBLE AS recall, CASE WHEN h > 0 THEN 1.0 ELSE 0.0 END AS hit, coalesce(s, 0) / n_truth AS ap
                 FROM (SELECT user_id, count(*) AS n FROM cosrecs GROUP BY 1) l JOIN truthn USING (user_id)
                 LEFT JOIN (SELECT user_id, count(*) AS h, sum(no / rank::DOUBLE) AS s FROM (SELECT r.user_id, r.rank, row_number() OVER (PARTITION BY r.user_id ORDER BY r.rank) AS no
                    FROM cosrecs r JOIN test t ON t.user_id = r.user_id AND t.track_id = r.track_id) GROUP BY 1) USING (user_id))""",
        "cosrecs",
        "truthn",
    ),
)
def content_evaluation(spark, folder):
    """Profiles, cosine lists, ranking means and list distance for all users in one plan."""
    lists = shared.cosine_lists(spark, folder)
    means = ranking.ranking_summary(lists, train_test(spark, folder)[1], [25])
    spread = diversity.mean_list_distance(lists, shared.encoded(spark, folder)[1]).scalar()
    return rounded(means.select("precision", "recall", "hit", "map", spread.alias("diversity")))
