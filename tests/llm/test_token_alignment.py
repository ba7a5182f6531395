"""Token alignment beside a plain version that looks at every token of every document."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracklight.llm import queries, token_alignment as ta
from tracklight.runtime import stage

A_PATH, B_PATH = (public_tokenizers.path(n) for n in (queries.BYTE_PAIRS, queries.PIECES))


def plain(rows):
    """What the query must return, by loops over tokens."""
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    letters = ta.byte_letters()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items() if all(c in letters for c in t)}
    made, holders = [], Counter()
    for doc, text in rows:
        groups = []
        if text:
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            pieces = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
            if b"".join(a_bytes[i] for i in a_ids) == b"".join(pieces) == (" " + text).encode():
                i = j = x = y = 0
                own = ([], [])
                while i < len(a_ids) or j < len(b_ids):
                    if x <= y:
                        own[0].append(a_ids[i])
                        x += len(a_bytes[a_ids[i]])
                        i += 1
                    else:
                        own[1].append(b_ids[j])
                        y += len(pieces[j])
                        j += 1
                    if x == y:
                        groups.append(own)
                        own = ([], [])
        pairs = Counter(p for g in groups for p in ((m, n) for m in g[0] for n in g[1]))
        holders.update(set(pairs))
        made.append((doc, groups, pairs))
    highest = defaultdict(int)
    for (m, _), n in holders.items():
        highest[m] = max(highest[m], n)
    out = []
    for doc, groups, pairs in made:
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append(
            (doc, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(pairs.values()),
             sum(n for p, n in pairs.items() if holders[p] == highest[p[0]]), sum(n * holders[p] for p, n in pairs.items()),
             hashlib.sha256(text.encode()).hexdigest() if text else "")
        )
    return sorted(out, key=str)


def whole(docs):
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    aligned = ta.align(docs, A_PATH, B_PATH).select("doc_id", *ta.SIZES, digest, "pairs", "pair_links")
    found = ta.with_corpus_counts(stage(aligned, "test-align"), queries.PIECES_SIZE)
    return sorted((tuple(r) for r in found.select("doc_id", *ta.SIZES, "n_best", "count_sum", "groups_sha256").collect()), key=str)


@pytest.fixture(scope="module")
def rows(edge_texts):
    rng = random.Random(9)
    strange = ["▁", "<|endoftext|>", "<s>", "</s> x", "<0x41>", "  two", "\n\n\n", "\t\x00\x01", "日本語のテキスト", "😀👍🏽", "é", " ", "　", "ﬁ", "a" * 50, " ", "'s don't", "12345678"]
    made = [(100 + i, "".join(rng.choice(strange + [" ", "word ", "Word"]) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    return [*edge_texts, *made, (300, "a" * 30_000), (301, "日" * 5_000), (302, " " * 3_000)]


@pytest.fixture(scope="module")
def aligner():
    with open(A_PATH, encoding="utf-8") as a_file, open(B_PATH, "rb") as b_file:
        return ta.Aligner(a_file.read(), b_file.read())


def test_chunks_give_the_ids_of_whole_texts(aligner, rows):
    """Also with a table so small that chunks are forgotten, and with spaces of all kinds around the cuts."""
    rng = random.Random(4)
    spaces = [" ", "  ", "\n", " \n", "\n ", "\xa0", " \xa0", "\xa0 ", "\x1c ", " \x1c", "\u3000 ", "\x85 ", "\t", "\u200b ", " \u200b"]
    texts = [t for _, t in rows if t] + ["".join(rng.choice(["it's", "a", "B2", "...", "é", "12", "▁", "'ll", "日本"]) + rng.choice(spaces) for _ in range(9)) for _ in range(3000)]
    small = ta.ChunkTable(3, aligner._solve, 50)
    for table in (aligner.known, small):
        aligner.known = table
        for begin in range(0, len(texts), 500):
            own = texts[begin : begin + 500]
            every, counts = ta.joined(aligner.chunks(t) for t in own)
            places = table.places(every)
            (a, n), (b, m) = ((ids, ta.per_text(n, counts)) for ids, n in (table.gather(side, places) for side in (0, 1)))
            assert a.tolist() == [i for e in aligner.a.encode_batch([" " + t for t in own], add_special_tokens=False) for i in e.ids]
            assert b.tolist() == [i for ids in aligner.b.encode(own) for i in ids]
            assert n.sum() == len(a) and m.sum() == len(b)


@pytest.mark.parametrize("listed", [ta.LISTED, 20])
def test_beside_plain_version(spark, rows, monkeypatch, listed):
    monkeypatch.setattr(ta, "LISTED", listed)
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, groups string, n_a int, pairs string").repartition(3)
    assert whole(docs) == plain(rows)


def test_large_groups_are_counted_by_distinct_ids(aligner, monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 300), rng.integers(0, 5, 300)
    ag, bg = np.sort(rng.integers(0, 6, 300)), np.sort(rng.integers(0, 6, 300))
    docs = np.array([0, 0, 1, 1, 2, 2], dtype=np.int64)
    all_at_once = aligner.links(a, b, ag, bg, docs)
    monkeypatch.setattr(ta, "LINKS", 2400)
    for one, two in zip(all_at_once, aligner.links(a, b, ag, bg, docs)):
        assert one.tolist() == two.tolist()


def test_no_documents(spark):
    assert whole(spark.createDataFrame([], "doc_id long, text string")) == []


def test_query_over_the_whole_table(spark, folder):
    found = queries.op11_token_alignment(spark, folder)
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)
