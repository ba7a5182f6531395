"""Alignment of two tokenizers over the same text, and how often their ids go together in a corpus.

Side A is a byte-level BPE (tokenizers library, JSON file) over a space and the text, side B a SentencePiece model over the text, which puts
the space there itself. Special tokens are not added and their strings are plain text. Both sides spell the same bytes.

1. In an Arrow batch the tokens of all texts become two tables (document, first byte, token). ``pandas.merge_asof``, keyed by
   document, finds for each token start of A the token of B that covers it, and the other way round; the union of both
   directions is the list of overlaps.
2. Overlaps with equal ends cut the tokens into groups; all tokens of A and of B in a group are linked.
3. A pair of ids is one number. Its links in a document are counted; tasks add up documents per pair, a shuffle sums them.
4. The ``LISTED`` most frequent pairs travel with the tasks that sum counts per document; links of all other pairs, each of
   which is rarer, meet their counts by a join. Texts are encoded once; pairs are written to the shared folder.

Links of a group are made in pieces of ``LINKS``; a group with more is counted by its distinct ids on each side. Texts are cut
at single spaces before a visible character, which no token of either side spans (A's pattern starts a token there; for B
the loader proves it from the vocabulary, and takes whole texts where it does not hold). Both libraries encode each cut
chunk when it is new to a bounded table.

Null and empty texts, and texts whose bytes one side does not give back (such as those with U+2581), have no tokens:
zeros and empty columns. Every row counts as a document, also where it repeats another or has no doc_id. An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklight.llm.chunk_table import ChunkTable, Ids, flat_ids, joined, per_text
from tracklight.llm.common import give_back, held, slices
from tracklight.runtime import stage

LISTED, LINKS, WINDOW = 1 << 20, 1 << 21, 4_000_000
TOGETHER = 64
SPACE = "▁"
#: A single space between a character and a visible one, and spaces that are not such.
CUT, RUN = re.compile(rf"(?<=[^ {SPACE}]) (?=[^\s{SPACE}])"), re.compile(rf" (?=\s|$)|^ |{SPACE}")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow from
    U+0100 on in their order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers with the bytes of their ids."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(a_json), sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a.encode_special_tokens = True
        letters, vocabulary = byte_letters(), json.loads(a_json)["model"]["vocab"]
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        if len(self.a_bytes) * len(self.b_bytes) >= 1 << 31:
            raise ValueError("pairs of ids are kept in 31 bits")
        self.cuts_allowed = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.spelling = (self.a_bytes, self.b_bytes)
        self.lengths = [np.array([len(x) for x in t], dtype=np.int64) for t in self.spelling]
        self.known = ChunkTable(3, self._solve)
        # Each id as text with what may follow it.
        ends = [[f"{i}{e}" for i in range(len(t))] for t, es in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for e in es]
        self.digits = pa.array([x for t in ends for x in t], pa.string())
        self.digit_base = np.cumsum([0] + [len(t) for t in ends])

    def chunks(self, text: str) -> list[str]:
        """The text cut at single spaces before a visible character (the spaces are left out); no token spans such a place."""
        if not self.cuts_allowed or not text:
            return [text] if text else []
        return CUT.split(text) if RUN.search(text) else text.split(" ")

    def _solve(self, chunks: list[str]) -> list[Ids]:
        """Ids of A and B of new chunks, and whether both spell the chunk.

        The chunks are encoded ``TOGETHER`` as one text, since no token spans the space between two; where the tokens of a side do
        not end with the chunks, each chunk is encoded by itself.
        """
        texts = [" ".join(chunks[i : i + TOGETHER]) for i in range(0, len(chunks), TOGETHER)]
        text = " ".join(texts)
        sizes = np.fromiter((len(c.encode()) + 1 for c in chunks), np.int64, len(chunks))
        found = []
        if self.cuts_allowed and SPACE not in text:
            both = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)], self.b.encode(texts, num_threads=1)
            for side, lists in enumerate(both):
                ids, _ = flat_ids(lists)
                if self._spelled(side, ids.tolist()) == (" " + text).encode():
                    ends, borders = np.cumsum(self.lengths[side][ids]), np.cumsum(sizes)
                    at = np.searchsorted(ends, borders)
                    if (ends[at] == borders).all():
                        found.append((ids, np.diff(at + 1, prepend=0)))
        ones = np.ones(len(chunks), dtype=np.int64)
        if len(found) == 2:
            return [*found, (ones, ones)]
        a = [e.ids for e in self.a.encode_batch([" " + c for c in chunks], add_special_tokens=False)]
        b = self.b.encode(chunks, num_threads=1)
        good = [self._spelled(0, x) == (" " + c).encode() == self._spelled(1, y) for c, x, y in zip(chunks, a, b)]
        return [flat_ids(a), flat_ids(b), (np.array(good, dtype=np.int64), ones)]

    def _spelled(self, side: int, ids) -> bytes:
        return b"".join(map(self.spelling[side].__getitem__, ids))

    def encode(self, texts: list[str | None]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray], np.ndarray]:
        """Ids and numbers of tokens per text of both sides, and which texts both sides give back; others have no tokens."""
        every, counts = joined(self.chunks(t or "") for t in texts)
        places = self.known.places(every)
        sides = [(ids, per_text(n, counts)) for ids, n in (self.known.gather(side, places) for side in (0, 1))]
        spelled, _ = self.known.gather(2, places)
        bad = per_text(1 - spelled, counts)
        good = (bad == 0) & (counts > 0)
        starts = [np.concatenate([[0], np.cumsum(n)]) for _, n in sides]
        for row in np.flatnonzero(bad):  # chunks that one side does not give back: the whole text decides
            own = [self._spelled(i, ids[at[row] : at[row + 1]]) for i, ((ids, _), at) in enumerate(zip(sides, starts))]
            good[row] = own[0] == own[1] == (" " + texts[row]).encode()
        sides = [(ids[np.repeat(good, n)], np.where(good, n, 0)) for ids, n in sides]
        return sides[0], sides[1], good

    def groups(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The group of each token of A and of B, numbered through the batch."""
        tokens, ends = [], []
        for (ids, n), lengths in zip((a, b), self.lengths):
            end = np.cumsum(lengths[ids])
            ends.append(end)
            tokens.append(pd.DataFrame({"start": end - lengths[ids], "doc": np.repeat(np.arange(len(n)), n), "token": np.arange(len(ids))}))
        one = pd.merge_asof(tokens[0], tokens[1], on="start", by="doc", suffixes=("_a", "_b"))
        two = pd.merge_asof(tokens[1], tokens[0], on="start", by="doc", suffixes=("_b", "_a"))
        overlaps = pd.concat([one, two], ignore_index=True)
        in_a, in_b = overlaps["token_a"].to_numpy(np.int64), overlaps["token_b"].to_numpy(np.int64)
        equal = ends[0][in_a] == ends[1][in_b]
        out = []
        for side, at in ((0, in_a), (1, in_b)):
            closes = np.zeros(len(ends[side]), dtype=np.int64)
            closes[at[equal]] = 1
            out.append(np.cumsum(closes) - closes)
        return out[0], out[1]

    def spelled_groups(self, a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, docs: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each of the texts; ``docs`` has how many groups each has."""
        order = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        lasts = [np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (a_group, b_group)]
        index = np.concatenate([a_ids + self.digit_base[lasts[0].astype(int)], b_ids + self.digit_base[2 + lasts[1].astype(int)]])[order]
        written = self.digits.take(pa.array(index))
        text = (written.buffers()[2] or pa.py_buffer(b"")).to_pybytes().decode("ascii")
        at = np.frombuffer(written.buffers()[1], np.int32)[: len(index) + 1] if len(index) else np.zeros(1, np.int32)
        tokens = np.bincount(a_group, minlength=docs.sum()) + np.bincount(b_group, minlength=docs.sum())
        borders = at[np.concatenate([[0], np.cumsum(tokens)])[np.concatenate([[0], np.cumsum(docs)])]]
        return [text[x : max(x, y - 1)] for x, y in zip(borders, borders[1:])]

    def pair(self, a_ids: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        return a_ids.astype(np.int64) * len(self.b_bytes) + b_ids

    def links(self, a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, group_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document << 31 | pair), sorted and distinct, with the number of links of each."""
        n = len(group_doc)
        na, nb = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
        first_b = np.concatenate([[0], np.cumsum(nb)])
        first_a = np.concatenate([[0], np.cumsum(na)])
        found, many = [], na * nb > LINKS
        each = np.where(many, 0, nb)[a_group]
        ends = np.cumsum(each)
        begin = 0
        while begin < len(each):
            stop = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + LINKS, side="right")))
            sizes = each[begin:stop]
            of = np.repeat(np.arange(begin, stop), sizes)
            within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            group = a_group[of]
            keys = group_doc[group] << 31 | self.pair(a_ids[of], b_ids[first_b[group] + within])
            found.append(np.unique(keys, return_counts=True))
            begin = stop
        for group in np.flatnonzero(many):
            ids, ids_n = np.unique(a_ids[first_a[group] : first_a[group + 1]], return_counts=True)
            others, others_n = np.unique(b_ids[first_b[group] : first_b[group + 1]], return_counts=True)
            for i, times in zip(ids, ids_n):
                found.append((group_doc[group] << 31 | self.pair(np.array([i]), others), others_n * times))
        if len(found) == 1:
            return found[0]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
        return keys, np.bincount(at, weights=np.concatenate([c for _, c in found])).astype(np.int64)


SIZES = ["n_a", "n_b", "n_groups", "n_links"]


def align(docs: DataFrame, a_path: str, b_path: str, column: str = "text") -> DataFrame:
    """For each row doc_id, n_a, n_b (tokens), n_groups, n_links, groups (ids of A and B per group, as ``a1,a2|b1;a3|b2,b3``),
    pairs and pair_links (distinct linked pairs as a * |B| + b, and how many links each has)."""
    with open(a_path, encoding="utf-8") as a_file, open(b_path, "rb") as b_file:
        files = docs.sparkSession.sparkContext.broadcast((a_file.read(), b_file.read()))
    key = (a_path, b_path)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = held("aligner", *key, make=lambda: Aligner(*files.value))
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                a, b, _ = aligner.encode(batch.column("text").to_pylist())
                rows = batch.num_rows
                a_group, b_group = aligner.groups(a, b)
                a_doc = np.repeat(np.arange(rows), a[1])
                total = int(a_group[-1]) + 1 if len(a_group) else 0
                group_doc = np.zeros(total, dtype=np.int64)
                group_doc[a_group] = a_doc
                groups = np.bincount(group_doc, minlength=rows)
                product = np.bincount(a_group, minlength=total) * np.bincount(b_group, minlength=total)
                links = np.zeros(rows, dtype=np.int64)
                np.add.at(links, group_doc, product)
                keys, amount = aligner.links(a[0], b[0], a_group, b_group, group_doc)
                borders = pa.array(np.searchsorted(keys, np.arange(rows + 1) << 31), pa.int32())
                lists = [pa.ListArray.from_arrays(borders, pa.array(v, t)) for v, t in (((keys & 0x7FFFFFFF), pa.int32()), (amount, pa.int64()))]
                counts = [pa.array(c, pa.int64()) for c in (a[1], b[1], groups, links)]
                text = pa.array(aligner.spelled_groups(a[0], b[0], a_group, b_group, groups), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, text, *lists], ["doc_id", *SIZES, "groups", "pairs", "pair_links"])
            give_back()

    return docs.select(F.col("doc_id").cast("long"), F.col(f"`{column}`").alias("text")).mapInArrow(
        tasks, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<int>, pair_links array<long>"
    )


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): documents that hold a pair linked, and whether no pair with the same id of A is in more."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, amount = [], 0

        def summed() -> pa.RecordBatch:
            pairs, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs, pa.int32()), pa.array(counts, pa.int64())], ["pair", "count"])

        for batch in batches:
            held.append(batch.column(0).flatten().to_numpy(zero_copy_only=False))
            amount += len(held[-1])
            if amount > WINDOW:
                yield summed()
                held, amount = [], 0
                give_back()
        if held:
            yield summed()

    counts = aligned.select("pairs").mapInArrow(tasks, "pair int, count long").groupBy("pair").agg(F.sum("count").alias("count"))
    counts = stage(counts, "align-counts").withColumn("a", F.floor(F.col("pair") / width))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def with_corpus_counts(aligned: DataFrame, width: int) -> DataFrame:
    """Adds to the rows of a written ``align`` table n_best (links whose pair is its id's most frequent one, ties included) and
    count_sum (documents that hold the pair, summed over links)."""
    spark = aligned.sparkSession
    counts = stage(pair_counts(aligned, width), "align-pairs")
    top = counts.orderBy(F.desc("count"), "pair").limit(LISTED).toArrow()
    pairs = top["pair"].to_numpy().astype(np.int32)
    order = np.argsort(pairs)
    listed = spark.sparkContext.broadcast((pairs[order], top["count"].to_numpy()[order], top["best"].to_numpy()[order]))
    whole = counts.count() <= LISTED
    kept = [c for c in aligned.columns if c not in ("pairs", "pair_links")]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = listed.value
        for batch in batches:
            own, links = (batch.column(c) for c in ("pairs", "pair_links"))
            row = np.repeat(np.arange(batch.num_rows), own.value_lengths().to_numpy())
            own, links = own.flatten().to_numpy(), links.flatten().to_numpy()
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            known = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            sums = [np.zeros(batch.num_rows, dtype=np.int64) for _ in range(2)]
            np.add.at(sums[0], row[known], links[known] * best[at[known]])
            np.add.at(sums[1], row[known], links[known] * counts[at[known]])
            borders = pa.array(np.searchsorted(row[~known], np.arange(batch.num_rows + 1)), pa.int32())
            rest = [pa.ListArray.from_arrays(borders, pa.array(v[~known], t)) for v, t in ((own, pa.int32()), (links, pa.int64()))]
            arrays = [*(batch.column(c) for c in kept), *(pa.array(s, pa.int64()) for s in sums), *rest]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "n_best", "count_sum", "rest", "rest_links"])
            give_back()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name in kept)
    out = aligned.mapInArrow(tasks, f"{schema}, n_best long, count_sum long, rest array<int>, rest_links array<long>")
    if whole:
        return out.drop("rest", "rest_links")
    out = stage(out.withColumn("row_id", F.monotonically_increasing_id()), "align-summed")
    rare = out.select("row_id", F.explode(F.arrays_zip("rest", "rest_links")).alias("own")).select("row_id", F.col("own.rest").alias("pair"), F.col("own.rest_links").alias("links"))
    rare = rare.join(counts, "pair").groupBy("row_id").agg(F.sum(F.col("links") * F.col("best").cast("int")).alias("more_best"), F.sum(F.col("links") * F.col("count")).alias("more_sum"))
    out = out.join(rare, "row_id", "left")
    return out.select(
        *kept, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")
    )
