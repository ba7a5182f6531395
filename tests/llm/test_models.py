"""Line classifier, context-tree scoring, trie join, components and the pipeline against brute force."""

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tracklight.llm import ctw, jaccard_trie, quality_crf
from tracklight.llm.common import held_out
from tracklight.llm.components import connected
from tracklight.runtime import stage


def test_marginals_by_enumeration():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5):
        model = quality_crf.Model(np.zeros(1), np.ones(1), np.zeros(1), 0.0, rng.normal(size=(2, 2)))
        evidence = rng.normal(size=n) * 2
        weight, good = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=n):
            score = sum(e for e, label in zip(evidence, labels) if label) + sum(model.transition[a, b] for a, b in zip(labels, labels[1:]))
            weight += math.exp(score)
            good += math.exp(score) * np.array(labels)
        assert np.allclose(model.marginals(evidence.tolist()), good / weight)


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_crf.fit(docs, labels.where(~held_out(5)))
    rows = quality_crf.score(docs, model).join(labels.where(held_out(5)), "doc_id").select("quality_score", "quality").toPandas()
    good, bad = rows[rows.quality == 1].quality_score, rows[rows.quality == 0].quality_score
    assert len(bad) > 3 and np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert (good >= 0.3).mean() > 0.98 and (bad < 0.3).mean() > 0.9
    again = quality_crf.fit(docs.repartition(7), labels.where(~held_out(5)).repartition(3))
    assert np.array_equal(model.weight, again.weight)


def test_quality_learns_from_all_lines(spark):
    """Texts that differ by label after many equal lines only."""
    begin = [f"the same line of every text, number {k}" for k in range(40)]
    tails = {0: "$$$ 100% 99 !!! BUY", 1: "a calm sentence with words in it"}
    rows = [(k, "\n".join([*begin, *[f"{tails[k % 2]} {k}"] * 40])) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(16)], "doc_id long, quality int")
    found = quality_crf.score(docs, quality_crf.fit(docs, labels)).where("doc_id >= 16").collect()
    assert min(r["quality_score"] for r in found if r["doc_id"] % 2) > max(r["quality_score"] for r in found if not r["doc_id"] % 2) + 0.1


def test_quality_of_edge_rows(edge_docs, no_docs, spark):
    labels = spark.createDataFrame([(1, 1), (7, 0), (3, 1), (9, 0), (9, 0), (None, 1), (12, None)], "doc_id long, quality int")
    scored = quality_crf.score(edge_docs, quality_crf.fit(edge_docs, labels))
    rows = scored.collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["quality_score"] <= 1 for r in rows)
    assert len({r["quality_score"] for r in rows if r["doc_id"] == 10}) == 1
    none = quality_crf.fit(edge_docs, labels.limit(0))
    assert {r["quality_score"] for r in quality_crf.score(edge_docs, none).collect()} == {0.5}
    assert quality_crf.score(no_docs, none).count() == 0 and quality_crf.fit(no_docs, labels).bias == 0


def tree_log10(train, text, depth):
    """Context-tree weighting by plain recursion over dictionaries."""
    counts = defaultdict(lambda: [0, 0])

    def decisions(data):
        padded = b"\n" * depth + data
        for i in range(depth, len(padded)):
            path = 1
            for k in range(8):
                bit = padded[i] >> (7 - k) & 1
                yield padded[i - depth : i], path, bit
                path = path << 1 | bit

    for data in train:
        for context, path, bit in decisions(data):
            for d in range(depth + 1):
                counts[context[depth - d :], path][bit] += 1
    children = defaultdict(set)
    for context, path in list(counts):
        if context:
            children[context[1:], path].add(context)

    def log_kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(context, path):
        own = log_kt(*counts[context, path])
        if len(context) == depth:
            return own
        below = sum(weighted(c, path) for c in children[context, path])
        return np.logaddexp(own, below) - math.log(2)

    def one(context, path):
        known, left, mixed = 0.5, 1.0, 0.0
        for d in range(depth + 1):
            node = context[depth - d :], path
            a, b = counts[node] if node in counts else (0, 0)
            if a + b:
                known = (b + 0.5) / (a + b + 1)
            if d == depth:
                return mixed + left * known
            below = sum(weighted(c, path) for c in children[node]) if node in children else 0.0
            share = 1 / (1 + math.exp(-(log_kt(a, b) - below)))
            mixed, left = mixed + left * share * known, left * (1 - share)

    return sum(math.log10(p if bit else 1 - p) for context, path, bit in decisions(text) for p in [one(context, path)])


def normal(text):
    return b" ".join((text or "").encode().lower().split()) + b"\n"


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_context_tree_by_recursion(spark, most):
    rows = [(1, "abab abba\nAB é"), (2, "abc ab"), (3, None), (4, "zz top"), (4, "zz top"), (5, ""), (None, "ab"), (6, "abab abba ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rest", F.lit("clash")).withColumn("learn", F.lit(1)).repartition(3)
    learned = {1, 2, 3, 4}
    found = ctw.score(docs, F.col("doc_id").isin(*learned), 3, most, most).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    train = [normal(t) for i, t in rows if i in learned]
    counts = Counter(w for i, t in rows if i in learned for w in [*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    for r in found:
        text = texts[r["doc_id"]]
        words = [*(text or "").encode().lower().split(), None]
        assert r["score"] == pytest.approx(tree_log10(train, normal(text), 3), rel=1e-9)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r["bits_per_byte"] == pytest.approx(-r["score"] * math.log2(10) / len(normal(text)))


def test_context_tree_is_a_distribution(spark):
    """The probabilities of all bytes after one context sum to 1."""
    contexts = [b"\n\n\n", b"aba", b"zzz"]
    keys = [int.from_bytes(c + bytes([b]), "big") for c in contexts for b in range(256)]
    seen = {int.from_bytes(g, "big"): n for g, n in ((b"\n\n\na", 5), (b"abab", 3), (b"abac", 1), (b"xbab", 4))}
    rows = [(0, k, seen.get(k, 0), 1) for k in {*keys, *seen}]
    model = ctw.gram_probabilities(spark.createDataFrame(rows, "kind int, key long, seen long, total long"), 3).toPandas().set_index("key")["logp"]
    for context in contexts:
        assert sum(10 ** model[int.from_bytes(context + bytes([b]), "big")] for b in range(256)) == pytest.approx(1)


def test_context_tree_of_nothing(no_docs, edge_docs):
    assert ctw.score(no_docs, F.lit(True)).count() == 0
    rows = ctw.score(edge_docs, F.lit(False)).collect()
    assert all(r["bits_per_byte"] == pytest.approx(8) and r["train_tokens"] == 0 and r["n_known"] == 0 for r in rows)


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def expected_components(rows, n, t):
    sets = [shingles(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) * t.denominator >= t.numerator * len(sets[a] | sets[b]):
            parent[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return sorted(((doc_id, len(sets[k]), least.get(find(k))) for k, (doc_id, _) in enumerate(rows)), key=str)


def families(seed, n_families, members, edits):
    """Texts in families of near copies, some chained, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(12))
    texts = []
    for _ in range(n_families):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([4, 20, 60, 110]))]
        for _ in range(members):
            changed = list(words)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(changed))
                kind = rng.random()
                if kind < 0.4:
                    changed[at] = rng.choice(vocabulary)
                elif kind < 0.7 and len(changed) > 3:
                    del changed[at]
                else:
                    changed.insert(at, rng.choice(vocabulary))
            if rng.random() < 0.3:
                words = changed  # the next copy starts from here
            texts.append((" ".join(changed) + " " + passage) if rng.random() < 0.5 else " ".join(changed))
    rng.shuffle(texts)
    return list(enumerate(texts, 1))


@pytest.mark.parametrize("n, t, seed", [(3, Fraction(9, 10), 1), (5, Fraction(8, 10), 2), (2, Fraction(1, 2), 3), (3, Fraction(1), 4)])
def test_components_by_brute_force(spark, n, t, seed):
    rows = families(seed, 14, 14, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = jaccard_trie.near_components(docs, n, t).select("doc_id", "n_shingles", "component_id").collect()
    expected = expected_components(rows, n, t)
    assert sorted((tuple(r) for r in found), key=str) == expected
    assert t == 1 or sum(i != c for i, _, c in expected) > 20


def test_components_of_a_large_family_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(jaccard_trie, "CELL", 7)
    monkeypatch.setattr(jaccard_trie, "HELD_TOKENS", 100)
    monkeypatch.setattr(jaccard_trie, "fits", lambda df, row_bytes: False)
    rows = families(9, 2, 120, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_trie.near_components(docs, 3, Fraction(9, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_components(rows, 3, Fraction(9, 10))


@pytest.mark.parametrize("n, t, seed, edits, cell", [(2, Fraction(1, 2), 12, 3, 7)])
def test_link_counts_by_brute_force(spark, monkeypatch, n, t, seed, edits, cell):
    monkeypatch.setattr(jaccard_trie, "CELL", cell)
    monkeypatch.setattr(jaccard_trie, "COLUMNS", 16, raising=False)
    rows = families(seed, 5, 25, edits)
    rows += [(1000 + k, text) for k, (_, text) in enumerate(rows[:5])] + [(2000, ""), (2001, None), (1, rows[1][1])]
    sets = [shingles(text, n) for _, text in rows]
    expected = []
    for (doc_id, _), own in zip(rows, sets):
        links = sum(bool(own) and len(own & s) * t.denominator >= t.numerator * len(own | s) for s in set(sets) - {own})
        expected.append((doc_id, links, sets.count(own) if own else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard_trie.near_components(docs, n, t).select("doc_id", "n_links", "class_size").collect()
    assert sorted(tuple(r) for r in found) == sorted(expected)
    assert max(e[1] for e in expected) > 5


def test_components_of_edge_rows(edge_docs, no_docs, edge_texts):
    found = jaccard_trie.near_components(edge_docs, 3, Fraction(9, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_components(edge_texts, 3, Fraction(9, 10))
    assert jaccard_trie.near_components(no_docs).count() == 0


def test_parities_never_differ_by_more_than_the_sets():
    sets = [jaccard_trie.ngram_set(text, 3) for _, text in families(5, 6, 8, 4)] + [jaccard_trie.ngram_set("", 3)]
    odd = [jaccard_trie.parities(s).tolist() for s in sets]
    for a, b in itertools.combinations(range(len(sets)), 2):
        bits = sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(odd[a], odd[b]))
        apart = len(np.setxor1d(sets[a], sets[b]))
        assert bits <= apart and bits % 2 == apart % 2


def test_prefix_tree_matches_brute_force():
    rng = random.Random(8)
    for t in (Fraction(9, 10), Fraction(1, 2), Fraction(1), Fraction(1, 10)):
        for _ in range(60):
            base = rng.sample(range(60), 20)
            order = {token: rng.random() for token in range(80)}
            sets = []
            for k in range(25):
                own = (set(base) - set(rng.sample(base, rng.randint(0, 6)))) | set(rng.sample(range(60, 80), rng.randint(0, 4)))
                sets.append((sorted(own, key=order.get), k))
            probe = sorted(set(base[:18]) | {61}, key=order.get)
            found = sorted(jaccard_trie.tree_matches(probe, sets + [([], 99)], t))
            assert found == [(k, len(set(s) & set(probe))) for s, k in sets if len(set(s) & set(probe)) >= t * len(set(s) | set(probe))]
    deep = list(range(20_000))
    found = jaccard_trie.tree_matches(deep, [(deep[:k], k) for k in range(19_900, 20_001, 20)], Fraction(9, 10))
    assert sorted(found) == [(k, k) for k in range(19_900, 20_001, 20)]


def test_connected_components_of_random_graphs(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: least[x] for x in linked}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_stage_judges_each_row_of_a_repeated_id(spark):
    one = " ".join(f"w{i}" for i in range(60))
    close, other, third = one + " tail", " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(1, one), (2, close), (2, other), (3, third), (3, third + " end"), (4, other + " last"), (None, one), (5, ""), (5, "z"), (6, close + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near(spark, docs, "").collect())
    assert [k for k in kept if k[0] != 3] == [(0, one), (1, one), (2, other), (5, ""), (5, "z")]
    assert len([k for k in kept if k[0] == 3]) == 1


def test_stages_hand_small_batches_to_python(spark, folder):
    """Spark's batches of 64 MB would be held several times over by an executor."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    corpus_pipeline.tokens(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert spark.conf.get(name, None) == str(4 << 20)
    spark.conf.set(name, "1000000")
    corpus_pipeline.quality(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert spark.conf.get(name) == "1000000"  # a size that the session names stays
    spark.conf.unset(name)


def test_pipeline_by_brute_force(spark, folder):
    import duckdb
    import public_tokenizers
    import sentencepiece

    from tracklight.llm import checks

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    frame = docs.toPandas()
    learn = spark.createDataFrame(labels[[zlib.crc32(str(i).encode()) % 5 != 0 for i in labels["doc_id"]]])
    model = quality_crf.fit(docs, learn)
    frame = frame[np.array(model.scores([t or "" for t in frame["text"]])[0]) >= 0.3]
    lowered = frame["text"].str.encode("utf-8").map(lambda b: b.lower())
    frame = frame[frame["doc_id"] == frame.groupby(lowered)["doc_id"].transform("max")]
    component = {i: c for i, _, c in expected_components(list(zip(frame["doc_id"], frame["text"])), 5, Fraction(8, 10))}
    frame = frame[[component[i] == i for i in frame["doc_id"]]]
    connection = duckdb.connect()
    connection.register("kept", frame)
    frame = connection.execute(checks.mixing(0.98, 2.0, None, documents="kept", tail="doc_id, text")).df()
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = sorted((i, library.encode(t)) for i, t in zip(frame["doc_id"], frame["text"]))
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in found) == expected
    assert all(r["n_tokens"] == len(r["ids"]) for r in found)


def test_stages_on_edge_rows(spark, edge_docs, no_docs, folder):
    for docs in (edge_docs, no_docs):
        kept = docs
        for name, step in corpus_pipeline.STAGES:
            out = stage(step(spark, kept, folder), f"test-{name}")
            if name != "tokens":
                assert out.columns == docs.columns
            assert name == "mixture" or out.count() <= kept.count()
            kept = out
    again = corpus_pipeline.exact(spark, edge_docs, folder)
    assert again.where("doc_id = 10").count() == 1 and again.where("doc_id is null").count() == 0


def test_entry_registers_all_operators():
    import __spark_entry__ as driver

    names = driver.queries()
    assert all(any(name.startswith(f"op{k}_") for name in names) for k in range(1, 11)) and "pipeline" in names


def below_threshold(members, words=400, own=7):
    """Texts of one family: ``own`` single words of each are its own, so that two of them stay below 0.8 over five-word shingles."""
    rng = random.Random(31)
    base = [f"b{k}" for k in range(words)]
    texts = []
    for member in range(members):
        changed = list(base)
        for at in rng.sample(range(words), own):
            changed[at] = f"m{member}x{at}"
        texts.append((member + 1, " ".join(changed)))
    return texts


def test_families_below_the_threshold_do_not_pass_in_pairs(spark):
    rows = below_threshold(24)
    sets = [jaccard_trie.ngram_set(text, 5) for _, text in rows]
    odd = [np.array(jaccard_trie.parities(s)).view(np.uint64) for s in sets]
    pairs = list(itertools.combinations(range(len(sets)), 2))
    apart = [len(np.setxor1d(sets[a], sets[b])) for a, b in pairs]
    differ = [int(np.bitwise_count(odd[a] ^ odd[b]).sum()) for a, b in pairs]
    reach = lambda a, b, gap: (len(sets[a]) + len(sets[b]) - gap) * 9 >= (len(sets[a]) + len(sets[b])) * 8
    assert not any(reach(a, b, gap) for (a, b), gap in zip(pairs, apart))
    assert sum(reach(a, b, gap) for (a, b), gap in zip(pairs, differ)) <= len(pairs) // 10
