"""Common table expressions of the equivalent SQL that a second engine runs on the same tables."""

from __future__ import annotations


def hash48(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 12) AS BIGINT)"


def uniform(text: str) -> str:
    return f"({hash48(text)} / 281474976710656.0::DOUBLE)"


def dictionary(source: str, column: str) -> str:
    return f"""SELECT v AS key, CAST(row_number() OVER (ORDER BY coalesce(substr(md5(v), 1, 3), ''), v) - 1 AS INTEGER) AS idx
        FROM (SELECT DISTINCT CAST({column} AS VARCHAR) AS v FROM {source})"""


def draws(n: int, train: str = "train") -> str:
    """Body of the unseen-track draw: n tracks per user in draw order."""
    return f"""SELECT user_id, track_id, draw FROM (
          SELECT d.user_id, t.track_id, d.draw, row_number() OVER (PARTITION BY d.user_id ORDER BY d.draw) AS rn
          FROM (
            SELECT user_id, j AS draw, (start + stride * j) % p AS idx FROM (
              SELECT user_id, stride, start, p, unnest(range(CAST(steps AS BIGINT))) AS j FROM (
                SELECT s.user_id, p, 1 + {hash48("s.user_id || '-stride-42'")} % greatest(1, p - 1) AS stride,
                       {hash48("s.user_id || '-start-42'")} % p AS start,
                       least(p, s.n_seen + {n} + (p - n_tracks)) AS steps
                FROM (SELECT user_id, count(*) AS n_seen FROM {train} GROUP BY 1) s CROSS JOIN prime)))
          d JOIN numbered t ON t.idx = d.idx
          WHERE NOT EXISTS (SELECT 1 FROM {train} x WHERE x.user_id = d.user_id AND x.track_id = t.track_id))
        WHERE rn <= {n}"""


def vector_rows(width: int, source: str, key: str, salt: str) -> str:
    values = ", ".join(uniform(f"'{salt}-' || {key} || '-42-{f}'") for f in range(width))
    return f"SELECT {key}, [{values}] AS vec FROM (SELECT DISTINCT {key} FROM {source})"


PARTS: dict[str, tuple[list[str], str]] = {
    "inter": (
        [],
        """SELECT CAST(o_custkey AS INTEGER) AS user_id, CAST(l_partkey AS INTEGER) AS track_id,
                  CAST(sum(l_quantity) AS BIGINT) AS playcount
           FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""",
    ),
    "active": (
        ["inter"],
        """SELECT * FROM inter
           WHERE user_id IN (SELECT user_id FROM inter GROUP BY 1 HAVING count(*) >= 50)
             AND track_id IN (SELECT track_id FROM inter GROUP BY 1 HAVING count(*) > 1)""",
    ),
    "splits": (
        ["active"],
        """SELECT user_id, track_id, playcount, CASE WHEN n > 1 AND rn <= (n + 4) // 5 THEN 'test' ELSE 'train' END AS split
           FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n,
                        row_number() OVER (PARTITION BY user_id ORDER BY md5(user_id || '-' || track_id || '-42'), track_id) AS rn
                 FROM active)""",
    ),
    "train": (["splits"], "SELECT user_id, track_id, playcount FROM splits WHERE split = 'train'"),
    "test": (["splits"], "SELECT user_id, track_id, playcount FROM splits WHERE split = 'test'"),
    "shares": (["test"], "SELECT *, playcount::DOUBLE / sum(playcount) OVER (PARTITION BY user_id) AS score FROM test"),
    "cat": (
        [],
        """SELECT CAST(p_partkey AS INTEGER) AS track_id, p_name AS name, p_brand AS artist, p_type AS genre,
                  replace(p_name, ' ', ', ') AS tags, p_size::DOUBLE AS size, p_retailprice AS price FROM part""",
    ),
    "tagrows": (
        ["cat"],
        "SELECT track_id, trim(tag) AS tag FROM (SELECT track_id, unnest(string_split(tags, ',')) AS tag FROM cat) WHERE trim(tag) <> ''",
    ),
    "genres": (["cat"], dictionary("cat WHERE genre IS NOT NULL", "genre")),
    "tagdict": (["tagrows"], dictionary("tagrows", "tag")),
    "scaled": (
        ["cat"],
        """SELECT track_id,
             CASE WHEN max(size) OVER () = min(size) OVER () THEN 0 ELSE (size - min(size) OVER ()) / (max(size) OVER () - min(size) OVER ()) END AS size,
             CASE WHEN max(price) OVER () = min(price) OVER () THEN 0 ELSE (price - min(price) OVER ()) / (max(price) OVER () - min(price) OVER ()) END AS price
           FROM cat""",
    ),
    "feat": (
        ["scaled", "genres", "tagdict", "tagrows"],
        """SELECT track_id, 0 AS feature_idx, size AS value FROM scaled WHERE size <> 0
           UNION ALL SELECT track_id, 1, price FROM scaled WHERE price <> 0
           UNION ALL SELECT c.track_id, 2 + g.idx, 1.0 FROM cat c JOIN genres g ON g.key = c.genre
           UNION ALL SELECT DISTINCT r.track_id, 2 + (SELECT count(*) FROM genres) + d.idx, 1.0
                     FROM tagrows r JOIN tagdict d ON d.key = r.tag""",
    ),
    "slots": (
        ["genres", "tagdict"],
        "SELECT unnest(range(2 + (SELECT count(*) FROM genres) + (SELECT count(*) FROM tagdict))) AS feature_idx",
    ),
    "tcells": (
        ["feat", "slots"],
        """SELECT c.track_id, s.feature_idx, coalesce(f.value, 0)::DOUBLE AS value
           FROM cat c CROSS JOIN slots s LEFT JOIN feat f ON f.track_id = c.track_id AND f.feature_idx = s.feature_idx""",
    ),
    "tvec": (["tcells"], "SELECT track_id, list(value ORDER BY feature_idx) AS vec FROM tcells GROUP BY 1"),
    "pcells": (
        ["train", "tcells"],
        "SELECT t.user_id, c.feature_idx, avg(c.value) AS value FROM train t JOIN tcells c ON c.track_id = t.track_id GROUP BY 1, 2",
    ),
    "pvec": (["pcells"], "SELECT user_id, list(value ORDER BY feature_idx) AS vec FROM pcells GROUP BY 1"),
    "known": (["splits"], "SELECT DISTINCT track_id FROM splits"),
    "numbered": (
        ["train"],
        "SELECT CAST(key AS INTEGER) AS track_id, idx FROM (" + dictionary("train", "track_id") + ")",
    ),
    "prime": (
        ["numbered"],
        """SELECT n AS n_tracks, (SELECT min(p) FROM (SELECT unnest(range(greatest(2, n), n + 1000)) AS p) c
             WHERE NOT EXISTS (SELECT 1 FROM (SELECT unnest(range(2, 5000)) AS d) f WHERE d * d <= c.p AND c.p % d = 0)) AS p
           FROM (SELECT count(*) AS n FROM numbered)""",
    ),
    "drawn": (["prime"], draws(50)),
    "recs": (
        ["drawn"],
        f"""SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id) AS INTEGER) AS rank
            FROM (SELECT user_id, track_id, {uniform("user_id || '-' || track_id || '-score-42'")} AS prediction FROM drawn)""",
    ),
    "ufac": (["train"], vector_rows(8, "train", "user_id", "u")),
    "ifac": (["train"], vector_rows(8, "train", "track_id", "i")),
    "allscores": (
        ["ufac", "ifac"],
        """SELECT u.user_id, i.track_id, round(list_dot_product(u.vec, i.vec), 9) AS prediction,
                  EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.track_id = i.track_id) AS seen
           FROM ufac u CROSS JOIN ifac i""",
    ),
    "mfrecs": (
        ["allscores"],
        """SELECT user_id, track_id, prediction, CAST(rank AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id) AS rank FROM allscores WHERE NOT seen)
           WHERE rank <= 50""",
    ),
    "cosscores": (
        ["pvec", "tvec", "known"],
        """SELECT p.user_id, t.track_id, round(list_cosine_similarity(p.vec, t.vec), 9) AS prediction,
                  EXISTS (SELECT 1 FROM train s WHERE s.user_id = p.user_id AND s.track_id = t.track_id) AS seen,
                  t.track_id IN (SELECT track_id FROM known) AS known
           FROM pvec p CROSS JOIN tvec t""",
    ),
    "cosrecs": (
        ["cosscores"],
        """SELECT user_id, track_id, prediction, CAST(rank AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, track_id DESC) AS rank
             FROM cosscores WHERE NOT seen AND known) WHERE rank <= 25""",
    ),
    "ks": ([], "SELECT unnest([10, 25, 50]) AS k"),
    "truthn": (["test"], "SELECT user_id, count(*) AS n_truth FROM test GROUP BY 1"),
    "hits": (
        ["recs", "shares"],
        """SELECT r.user_id, r.track_id, r.rank, s.score, row_number() OVER (PARTITION BY r.user_id ORDER BY r.rank) AS hit_no
           FROM recs r JOIN shares s ON s.user_id = r.user_id AND s.track_id = r.track_id""",
    ),
    "users_k": (
        ["recs", "truthn", "ks"],
        """SELECT l.user_id, k, least(n_recs, k) AS n_list, n_truth FROM
             (SELECT user_id, count(*) AS n_recs FROM recs GROUP BY 1) l JOIN truthn t ON t.user_id = l.user_id CROSS JOIN ks""",
    ),
    "places": (
        ["shares"],
        "SELECT user_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, track_id) AS place FROM shares",
    ),
    "ideal": (
        ["users_k", "places"],
        """SELECT u.user_id, u.k, sum(p.score / log2(p.place + 1)) AS graded FROM users_k u JOIN places p
             ON p.user_id = u.user_id AND p.place <= u.n_list GROUP BY 1, 2""",
    ),
    "ideal_binary": (
        ["ks"],
        """SELECT n, (SELECT sum(1 / log2(i + 1)) FROM (SELECT unnest(range(1, 51)) AS i) WHERE i <= n) AS dcg,
             (SELECT sum(1 / greatest(log2(i), 1)) FROM (SELECT unnest(range(1, 1001)) AS i) WHERE i <= n) AS dcg_flat
           FROM (SELECT unnest(range(1, 1001)) AS n)""",
    ),
    "per_k": (
        ["users_k", "hits", "ideal", "ideal_binary"],
        """SELECT u.user_id, u.k, u.n_list, u.n_truth, count(h.rank) AS hits,
             count(h.rank) / u.n_list::DOUBLE AS precision_list, count(h.rank) / u.k::DOUBLE AS precision_at_k,
             count(h.rank) / u.n_truth::DOUBLE AS recall, CASE WHEN count(h.rank) > 0 THEN 1.0 ELSE 0.0 END AS hit,
             coalesce(sum(1 / log2(h.rank + 1)), 0) / any_value(b.dcg) AS ndcg,
             coalesce(sum(h.score / log2(h.rank + 1)), 0) / any_value(i.graded) AS ndcg_graded,
             sum(CASE WHEN h.rank IS NULL THEN 0 ELSE 1 / greatest(log2(h.rank), 1) END) / any_value(f.dcg_flat) AS ndcg_flat,
             coalesce(sum(h.hit_no / h.rank::DOUBLE), 0) / u.n_truth AS ap,
             coalesce(sum(h.hit_no / h.rank::DOUBLE), 0) / least(u.n_truth, u.k) AS ap_at_k
           FROM users_k u LEFT JOIN hits h ON h.user_id = u.user_id AND h.rank <= u.k
             JOIN ideal i ON i.user_id = u.user_id AND i.k = u.k
             JOIN ideal_binary b ON b.n = least(u.n_truth, u.k) JOIN ideal_binary f ON f.n = u.n_truth
           GROUP BY u.user_id, u.k, u.n_list, u.n_truth""",
    ),
    "listpairs": (
        ["recs"],
        """SELECT a.user_id, a.track_id AS track_a, b.track_id AS track_b, greatest(a.rank, b.rank) AS rank
           FROM recs a JOIN recs b ON a.user_id = b.user_id AND a.track_id < b.track_id""",
    ),
    "paircos": (
        ["listpairs", "train"],
        """SELECT p.track_a, p.track_b, count(*) / sqrt(any_value(a.n)::DOUBLE * any_value(b.n)) AS cosine
           FROM (SELECT DISTINCT track_a, track_b FROM listpairs) p
             JOIN train x ON x.track_id = p.track_a JOIN train y ON y.track_id = p.track_b AND y.user_id = x.user_id
             JOIN (SELECT track_id, count(*) AS n FROM train GROUP BY 1) a ON a.track_id = p.track_a
             JOIN (SELECT track_id, count(*) AS n FROM train GROUP BY 1) b ON b.track_id = p.track_b
           GROUP BY 1, 2""",
    ),
    "coll": (
        ["listpairs", "paircos", "ks"],
        """SELECT k, 1 - avg(m) AS diversity FROM (
             SELECT l.user_id, k, avg(coalesce(c.cosine, 0)) AS m FROM listpairs l JOIN ks ON l.rank <= k
             LEFT JOIN paircos c ON c.track_a = l.track_a AND c.track_b = l.track_b GROUP BY 1, 2) GROUP BY 1""",
    ),
    "nov": (
        ["recs", "train", "ks"],
        """SELECT k, avg(-log2(n / total)) AS novelty FROM recs r JOIN ks ON r.rank <= k
             JOIN (SELECT track_id, count(*)::DOUBLE AS n FROM train GROUP BY 1) t ON t.track_id = r.track_id
             CROSS JOIN (SELECT count(*) AS total FROM train) GROUP BY 1""",
    ),
    "atk": (
        ["per_k", "test"],
        """SELECT k, avg(precision_at_k) AS precision_at_k, avg(recall) AS recall_at_k,
             sum(hit) / (SELECT count(DISTINCT user_id) FROM test) AS hit_at_k, avg(ndcg) AS ndcg_at_k,
             avg(ap) AS map, avg(ap_at_k) AS map_at_k FROM per_k GROUP BY 1""",
    ),
    "bundle": (["atk", "nov", "coll"], "SELECT * FROM atk JOIN nov USING (k) JOIN coll USING (k)"),
}


def sql(body: str, *needs: str, **extra: str) -> str:
    """``body`` behind the expressions it needs, each once and after those it builds on."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for need in PARTS[name][0]:
                add(need)
            order.append(name)

    for name in needs:
        add(name)
    parts = [f"{n} AS ({PARTS[n][1]})" for n in order] + [f"{n} AS ({text})" for n, text in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
