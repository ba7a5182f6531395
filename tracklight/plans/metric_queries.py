"""Queries over ranking, rating and diversity metrics and reports, on the random lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.metrics import diversity, ranking, rating, report
from tracklight.models import factorization
from tracklight.plans import shared
from tracklight.plans.checks import sql
from tracklight.plans.prepare_queries import SCORED, scored_history
from tracklight.runtime import new_path
from tracklight.schema import USER
from tracklight.sources import io
from tracklight.sources.tables import history, train_test

QUERIES: dict[str, tuple] = {}
KS = report.KS


def query(name: str, check: str | None = None):
    def register(build):
        QUERIES[name] = (build, check)
        return build

    return register


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def per_user(spark, folder) -> DataFrame:
    return ranking.user_metrics(shared.random_lists(spark, folder), train_test(spark, folder)[1], KS)


def _user_metric(name: str, column: str) -> None:
    build = lambda spark, folder: per_user(spark, folder).select(USER, "k", F.round(column, 6).alias("value"))
    QUERIES[name] = (build, sql(f"SELECT user_id, k, round(CAST({column} AS DOUBLE), 6) AS value FROM per_k", "per_k"))


for _name, _column in {
    "user_precision": "precision_list",
    "user_recall": "recall",
    "user_ndcg_graded": "ndcg_graded",
    "user_hit": "hit",
    "user_ap": "ap",
}.items():
    _user_metric(_name, _column)


def _at_k(name: str, column: str) -> None:
    def build(spark, folder):
        lists, (_, test) = shared.random_lists(spark, folder), train_test(spark, folder)
        return ranking.ranking_at_k(lists, test, KS).select("k", F.round(column, 6).alias(column))

    QUERIES[name] = (build, sql(f"SELECT k, round({column}, 6) AS {column} FROM atk", "atk"))


for _name in ["precision_at_k", "recall_at_k", "ndcg_at_k", "map", "map_at_k"]:
    _at_k(_name, _name)


@query(
    "hit_at_k",
    sql(
        "SELECT round((SELECT count(DISTINCT r.user_id) FROM recs r JOIN test t ON t.user_id = r.user_id AND t.track_id = r.track_id WHERE r.rank <= 25)::DOUBLE / (SELECT count(DISTINCT user_id) FROM test), 6) AS hit_at_k",
        "recs",
        "test",
    ),
)
def hit_at_k(spark, folder):
    return rounded(ranking.hit_at_k(shared.random_lists(spark, folder), train_test(spark, folder)[1], 25))


MEANS = "avg(precision_list) AS precision, avg(recall) AS recall, avg({ndcg}) AS ndcg, avg(hit) AS hit"
ROUND_MEANS = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(ndcg, 6) AS ndcg, round(hit, 6) AS hit"


@query("ranking_summary", sql(f"SELECT k, {ROUND_MEANS}, round(map, 6) AS map FROM (SELECT k, {MEANS.format(ndcg='ndcg_graded')}, avg(ap) AS map FROM per_k GROUP BY 1)", "per_k"))
def ranking_summary(spark, folder):
    return rounded(ranking.ranking_summary(shared.random_lists(spark, folder), train_test(spark, folder)[1], KS))


@query("metric_mean", sql("SELECT k, count(*) AS users, round(avg(ndcg), 6) AS ndcg, round(avg(ap_at_k), 6) AS ap_at_k FROM per_k GROUP BY 1", "per_k"))
def metric_mean(spark, folder):
    means = per_user(spark, folder).groupBy("k").agg(F.count(F.lit(1)).alias("users"), F.avg("ndcg").alias("ndcg"), F.avg("ap_at_k").alias("ap_at_k"))
    return rounded(means)


@query("list_analysis", sql(f"SELECT k, {ROUND_MEANS} FROM (SELECT k, {MEANS.format(ndcg='ndcg_flat')} FROM per_k GROUP BY 1)", "per_k"))
def list_analysis(spark, folder):
    return rounded(ranking.list_analysis(shared.random_lists(spark, folder), train_test(spark, folder)[1], KS))


@query(
    "precision_recall_lists",
    sql(
        """SELECT round(avg(coalesce(h / n::DOUBLE, 0)), 6) AS precision, round(avg(coalesce(h, 0) / n_truth::DOUBLE), 6) AS recall
           FROM truthn t LEFT JOIN (SELECT user_id, count(*) AS n FROM recs GROUP BY 1) USING (user_id)
           LEFT JOIN (SELECT r.user_id, count(*) AS h FROM recs r JOIN test x ON x.user_id = r.user_id AND x.track_id = r.track_id GROUP BY 1) USING (user_id)
           WHERE user_id IN (SELECT user_id FROM train)""",
        "truthn",
        "recs",
        "train",
    ),
)
def precision_recall_lists(spark, folder):
    train, test = train_test(spark, folder)
    return rounded(ranking.precision_recall(shared.random_lists(spark, folder), test, train, shared.TOP))


@query(
    "roem",
    sql(
        "SELECT round(sum(playcount * pr) / sum(playcount), 6) AS roem FROM (SELECT playcount, percent_rank() OVER (PARTITION BY user_id ORDER BY prediction DESC) AS pr FROM s)",
        "splits",
        s=SCORED,
    ),
)
def roem(spark, folder):
    return rounded(rating.roem(scored_history(spark, folder)))


PAIRED = "FROM test t JOIN ufac u ON u.user_id = t.user_id JOIN ifac i ON i.track_id = t.track_id"


@query("rating_errors", sql(f"SELECT round(sqrt(avg(g * g)), 6) AS rmse, round(avg(abs(g)), 6) AS mae FROM (SELECT t.playcount - list_dot_product(u.vec, i.vec) AS g {PAIRED})", "test", "ufac", "ifac"))
def rating_errors(spark, folder):
    users, tracks = shared.start_factors(spark, folder)
    return rounded(rating.rating_errors(factorization.predict(train_test(spark, folder)[1], users, tracks)))


def _rating_error(name: str, text: str) -> None:
    build = lambda spark, folder: rating_errors(spark, folder).select(name)
    QUERIES[name] = (build, sql(f"SELECT round({text}, 6) AS {name} FROM (SELECT t.playcount - list_dot_product(u.vec, i.vec) AS g {PAIRED})", "test", "ufac", "ifac"))


_rating_error("rmse", "sqrt(avg(g * g))")
_rating_error("mae", "avg(abs(g))")


@query("novelty", sql("SELECT k, round(novelty, 6) AS novelty FROM nov", "nov"))
def novelty(spark, folder):
    return rounded(diversity.novelty(shared.random_lists(spark, folder), train_test(spark, folder)[0], KS))


@query("collab_diversity", sql("SELECT k, round(diversity, 6) AS diversity FROM coll", "coll"))
def collab_diversity(spark, folder):
    return rounded(diversity.collaborative_diversity(shared.random_lists(spark, folder), train_test(spark, folder)[0], KS))


def _distance_sql(vectors: str, kernel: str) -> str:
    return f"""SELECT user_id, round(avg({kernel}(a.vec, b.vec)), 6) AS distance FROM listpairs
      JOIN {vectors} a ON a.track_id = track_a JOIN {vectors} b ON b.track_id = track_b GROUP BY 1"""


@query("aild", sql(_distance_sql("tvec", "list_cosine_distance"), "listpairs", "tvec"))
def aild(spark, folder):
    return rounded(diversity.list_distance(shared.random_lists(spark, folder), shared.encoded(spark, folder)[1]))


@query("aild_euclidean", sql(_distance_sql("tvec", "list_distance"), "listpairs", "tvec"))
def aild_euclidean(spark, folder):
    return rounded(diversity.list_distance(shared.random_lists(spark, folder), shared.encoded(spark, folder)[1], "euclidean"))


@query("factor_diversity", sql(_distance_sql("ifac", "list_cosine_distance"), "listpairs", "ifac"))
def factor_diversity(spark, folder):
    return rounded(diversity.list_distance(shared.random_lists(spark, folder), shared.start_factors(spark, folder)[1]))


# --- reports ----------------------------------------------------------------------------------

METRICS = ["precision_at_k", "recall_at_k", "hit_at_k", "ndcg_at_k", "map", "map_at_k", "novelty", "diversity"]
ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in METRICS)


def by_k(spark, folder) -> DataFrame:
    train, test = train_test(spark, folder)
    return report.metrics_by_k(shared.random_lists(spark, folder), test, train, KS)


@query("metrics_by_k", sql(f"SELECT k, {ROUNDED} FROM bundle", "bundle"))
def metrics_by_k(spark, folder):
    return rounded(by_k(spark, folder))


@query("metric_bundle", sql(f"SELECT {ROUNDED} FROM bundle WHERE k = 10", "bundle"))
def metric_bundle(spark, folder):
    train, test = train_test(spark, folder)
    return rounded(report.metric_bundle(shared.random_lists(spark, folder), test, train, 10))


SUMMARY = f"SELECT (SELECT count(*) FROM splits) AS data, 'random' AS algo, k, {ROUNDED} FROM bundle"
UNRATED = "SELECT (SELECT count(*) FROM splits) AS data, 'unrated' AS algo, k, " + ", ".join(f"NULL::DOUBLE AS {m}" for m in METRICS) + " FROM ks"


def summary(spark, folder) -> DataFrame:
    data = history(spark, folder)
    rows = [report.summary_rows("random", rounded(by_k(spark, folder)), data), report.summary_rows("unrated", None, data)]
    return report.summary(rows)


QUERIES["summary_row"] = (summary, sql(f"{SUMMARY} UNION ALL {UNRATED}", "bundle", "splits"))


@query("report_sort", sql(f"SELECT * FROM ({SUMMARY} UNION ALL {UNRATED}) ORDER BY algo, k", "bundle", "splits"))
def report_sort(spark, folder):
    return summary(spark, folder)


@query("sink_summary", sql("SELECT 'random' AS algo, k, round(novelty, 6) AS novelty FROM nov", "nov"))
def sink_summary(spark, folder):
    path = new_path(spark, "summary")
    values = rounded(diversity.novelty(shared.random_lists(spark, folder), train_test(spark, folder)[0], KS))
    io.write_summary(values.select(F.lit("random").alias("algo"), "k", "novelty"), path)
    return io.read_summary(spark, path)


@query("scan_results_csv", sql(f"SELECT k, {ROUNDED} FROM bundle", "bundle"))
def scan_results_csv(spark, folder):
    path = new_path(spark, "results")
    io.write_summary(rounded(by_k(spark, folder)), path)
    return io.read_summary(spark, path)


@query(
    "algo_k_series",
    sql(
        """SELECT 'random' AS algo, max(CASE WHEN k = 10 THEN round(novelty, 6) END) AS k10,
             max(CASE WHEN k = 25 THEN round(novelty, 6) END) AS k25, max(CASE WHEN k = 50 THEN round(novelty, 6) END) AS k50 FROM nov""",
        "nov",
    ),
)
def algo_k_series(spark, folder):
    rows = diversity.novelty(shared.random_lists(spark, folder), train_test(spark, folder)[0], KS)
    return report.algo_k_series(rounded(report.summary_rows("random", rows, history(spark, folder))), "novelty")
