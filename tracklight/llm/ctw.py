"""Language-model scoring by context-tree weighting over bytes.

A text is the sequence of its lower-cased (A-Z) words, one space between them and a line end after the last; a
line end occurs nowhere else. Each byte is eight binary decisions. A decision's node is a context (the
last d bytes, d from 0 to ``DEPTH``) and the bits of the byte decided so far; it holds the counts of both
outcomes in the training texts. A node's Krichevsky-Trofimov block probability is weighted half and half with the product
of its children's weighted probabilities, children being contexts one byte longer, up from the deepest.
On the way down the weights become a mixture of the estimates at all depths; a context
never seen in training passes its weight to the longest one that was. The mixture is frozen and summed over
a text; ``bits_per_byte`` is its code length per byte.

All counts are exact and cover every training text: tasks sort the n-grams of their slices and emit counts, a
shuffle adds them up. Trees are built per last two context bytes (a shard holds distinct n-grams, not rows); the
two top levels have at most 65,535 nodes and are made from shard sums. N-grams of the
texts to be scored that training lacks are carried along with count 0, so every n-gram finds its probability.
Lookups of frequent n-grams and words go to sorted arrays of at most ``MOST_GRAMS`` and ``MOST_WORDS`` entries that
travel with the tasks; all others are joined with the full table. Both ways give the same sums.

Words are told apart by a 64-bit hash. Null and empty texts have the end token only. Rows that repeat are
scored each and, if they are training rows, counted each. An empty table gives no rows; with no training
rows every estimate is 1/2 per bit, and the base has V = N = 0. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklight.llm.common import give_back, slices
from tracklight.llm.jaccard_trie import KEPT_WORDS, WORDS
from tracklight.runtime import stage

DEPTH = 5
MOST_GRAMS, MOST_WORDS = 1 << 21, 1 << 20
END = b"\n"
GRAM, WORD, END_TOKEN, FIGURES = 0, 1, 2, 3
SLICE, MERGED = 2 << 20, 2_000_000
SMALL = 4096
HALF_TABLE = np.concatenate([[0.0], np.cumsum(np.log(np.arange(SMALL) + 0.5))])
FULL_TABLE = np.concatenate([[0.0], np.cumsum(np.log(np.arange(SMALL) + 1.0))])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, for arguments of at least ``SMALL``."""
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a block with so many zeros and ones."""

    def half(n):
        large = _log_gamma(np.maximum(n, SMALL) + 0.5) - 0.5 * np.log(np.pi)
        return np.where(n < SMALL, HALF_TABLE[np.minimum(n, SMALL).astype(np.int64)], large)

    total = zeros + ones
    full = np.where(total < SMALL, FULL_TABLE[np.minimum(total, SMALL).astype(np.int64)], _log_gamma(np.maximum(total, SMALL) + 1.0))
    return half(zeros) + half(ones) - full


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(keys), dtype=np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ordered[new], inverse


def prepare(texts: list[str | None], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """n-grams of all positions (context bytes, oldest first, then the byte) and the text each is in; word hashes and the text each is in."""
    bodies, hashes, counts = [], [], []
    pad = END * depth
    if len(WORDS) > KEPT_WORDS:
        WORDS.clear()
    for text in texts:
        words = (text or "").encode(errors="surrogatepass").lower().split()
        hashes.extend(map(WORDS.__getitem__, words))
        counts.append(len(words))
        bodies.append(b"".join((pad, b" ".join(words), END)))
    data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    grams = np.zeros(max(len(data) - depth, 0), dtype=np.uint64)
    for k in range(depth + 1):
        grams = (grams << np.uint64(8)) | data[k : len(data) - depth + k]
    owner = np.repeat(np.arange(len(texts)), sizes)[depth:]
    begin = np.cumsum(sizes) - sizes
    inside = np.ones(len(grams), bool)
    for k in range(depth):  # positions whose byte is padding of the next text
        at = begin[1:] - depth + k
        inside[at] = False
    return grams[inside], owner[inside], np.array(hashes, dtype=np.uint64), np.repeat(np.arange(len(texts)), counts)


class Counts:
    """Counts of keys in training and in all texts, kept merged."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, train: np.ndarray) -> None:
        for some, learned in ((keys[train], True), (keys[~train], False)):
            if len(some):
                found, total = np.unique(some, return_counts=True)
                self.parts.append((found, total if learned else np.zeros_like(total), total))
                self.held += len(found)

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        keys, inverse = _unique(np.concatenate([p[0] for p in self.parts]))
        seen = np.bincount(inverse, np.concatenate([p[1] for p in self.parts]), len(keys)).astype(np.int64)
        total = np.bincount(inverse, np.concatenate([p[2] for p in self.parts]), len(keys)).astype(np.int64)
        self.parts, self.held = [(keys, seen, total)], len(keys)
        return keys, seen, total


def _rows(kind: int, keys, seen, total) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(keys), kind, np.int32)), pa.array(np.asarray(keys, dtype=np.uint64).view(np.int64)), pa.array(seen, pa.int64()), pa.array(total, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["kind", "key", "seen", "total"])


def corpus_counts(docs: DataFrame, learn: Column, depth: int = DEPTH) -> DataFrame:
    """kind, key, seen (in rows where ``learn`` holds), total (in all rows), added up over all tasks."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words, ends, rows = Counts(), Counts(), 0, 0
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                train = np.array(batch.column("learn").to_pylist(), dtype=bool)
                gram, owner, word, home = prepare(batch.column("text").to_pylist(), depth)
                grams.add(gram, train[owner])
                words.add(word, train[home])
                ends, rows = ends + int(train.sum()), rows + len(train)
                for kind, held in ((GRAM, grams), (WORD, words)):
                    if held.held > MERGED:
                        merged = held.merge()
                        if held.held > MERGED // 2:
                            yield from _in_pieces(kind, *merged)
                            held.parts, held.held = [], 0
                        del merged
            give_back()
        for kind, held in ((GRAM, grams), (WORD, words)):
            yield from _in_pieces(kind, *held.merge())
        if rows:
            yield _rows(END_TOKEN, [0], [ends], [rows])

    rows = docs.select("text", learn.alias("learn")).mapInArrow(tasks, "kind int, key long, seen long, total long")
    return rows.groupBy("kind", "key").agg(F.sum("seen").alias("seen"), F.sum("total").alias("total"))


def _in_pieces(kind: int, keys, seen, total, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(keys), rows):
        yield _rows(kind, keys[at : at + rows], seen[at : at + rows], total[at : at + rows])


def _climb(grams: np.ndarray, seen: np.ndarray, depth: int, stop: int) -> list[dict]:
    """Levels of nodes from ``depth`` up to ``stop``; ``up`` leads from a level's nodes to those of the next in the list."""
    byte, context = (grams & np.uint64(255)).astype(np.int64), (grams >> np.uint64(8)).astype(np.int64)
    step = np.arange(8)
    path, bit = (256 | byte[:, None]) >> (8 - step), (byte[:, None] >> (7 - step)) & 1
    keys, place = _unique(((context[:, None] << 8) | path).ravel())
    times = np.repeat(seen.astype(np.float64), 8)
    ones = np.bincount(place, times * bit.ravel(), len(keys))
    zeros = np.bincount(place, times * (1 - bit.ravel()), len(keys))
    weighted = log_kt(zeros, ones)
    levels = [{"keys": keys, "zeros": zeros, "ones": ones, "weighted": weighted, "ratio": None, "place": place, "bit": bit}]
    for d in range(depth - 1, stop - 1, -1):
        below = levels[-1]
        keys, up = _unique((((below["keys"] >> 8) & ((1 << (8 * d)) - 1)) << 8) | (below["keys"] & 255))
        below["up"] = up
        levels.append(_joined(keys, *(np.bincount(up, below[c], len(keys)) for c in ("zeros", "ones", "weighted"))))
    return levels


def _joined(keys, zeros, ones, children) -> dict:
    own = log_kt(zeros, ones)
    return {"keys": keys, "zeros": zeros, "ones": ones, "weighted": np.logaddexp(own, children) - np.log(2), "ratio": own - children}


def _mix(level: dict, above: tuple[np.ndarray, np.ndarray, np.ndarray], deepest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixture so far, weight left, and estimate of the longest context seen, for the nodes of a level."""
    mixed, left, known = above
    total = level["zeros"] + level["ones"]
    known = np.where(total > 0, (level["ones"] + 0.5) / (total + 1), known)
    if deepest:
        return mixed + left * known, left, known
    share = 1 / (1 + np.exp(-np.clip(level["ratio"], -500, 500)))
    return mixed + left * share * known, left * (1 - share), known


def _descend(levels: list[dict], above: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each n-gram's byte, from the values that reach the last level of ``levels``."""
    for at in range(len(levels) - 1, -1, -1):
        above = _mix(levels[at], above, at == 0)
        if at:
            above = tuple(v[levels[at - 1]["up"]] for v in above)
    one = np.clip(above[0][levels[0]["place"]], 1e-12, 1 - 1e-12).reshape(-1, 8)
    return np.log10(np.where(levels[0]["bit"] == 1, one, 1 - one)).sum(1)


def gram_probabilities(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """key, total, logp for every n-gram row of the counts."""
    if depth < 2:
        raise ValueError("trees are sharded by two context bytes")
    spark = counts.sparkSession
    grams = counts.where(F.col("kind") == GRAM).select("key", "seen", "total", F.shiftright("key", 8).bitwiseAND(0xFFFF).cast("int").alias("shard"))

    def sums(table: pa.Table) -> pa.Table:
        top = _climb(table["key"].to_numpy().view(np.uint64), table["seen"].to_numpy(), depth, 2)[-1]
        return pa.table({"node": top["keys"] & 0xFFFF, "zeros": top["zeros"], "ones": top["ones"], "weighted": top["weighted"]})

    tops = grams.groupBy("shard").applyInArrow(sums, "node long, zeros double, ones double, weighted double")
    # (last byte, bits so far): at most 256 x 255 rows.
    first = tops.groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).toArrow()
    order = np.argsort(first["node"].to_numpy())
    columns = [np.asarray(c.to_numpy())[order] for c in first.columns]
    one_byte = _joined(*columns)
    keys, up = _unique(one_byte["keys"] & 255)
    root = _joined(keys, *(np.bincount(up, one_byte[c], len(keys)) for c in ("zeros", "ones", "weighted")))
    start = (np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), 0.5))
    above = tuple(v[up] for v in _mix(root, start, False))
    reach = spark.sparkContext.broadcast((one_byte["keys"], *_mix(one_byte, above, False)))

    def probabilities(table: pa.Table) -> pa.Table:
        levels = _climb(table["key"].to_numpy().view(np.uint64), table["seen"].to_numpy(), depth, 2)
        nodes, *values = reach.value
        at = np.searchsorted(nodes, levels[-1]["keys"] & 0xFFFF)
        return pa.table({"key": table["key"], "total": table["total"], "logp": _descend(levels, tuple(v[at] for v in values))})

    return grams.groupBy("shard").applyInArrow(probabilities, "key long, total long, logp double")


def _frequent(rows: DataFrame, value: str, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (sorted) and values of the rows with the highest totals: all above the least power of two that leaves at most ``most``."""
    by_size = rows.groupBy(F.floor(F.log2(F.greatest(F.col("total"), F.lit(1)).cast("double"))).alias("power")).count().collect()
    sizes = {r["power"]: r["count"] for r in by_size}
    held, least = 0, max(sizes, default=0) + 1
    for power in sorted(sizes, reverse=True):
        if held + sizes[power] > most:
            break
        held, least = held + sizes[power], power
    found = rows.where(F.col("total") >= 2**least).select("key", value).toArrow()
    keys = np.asarray(found["key"].to_numpy()).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.asarray(found[value].to_numpy())[order]


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of sorted keys and whether they are listed."""
    if not len(table[0]):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    listed = table[0][at] == keys
    return np.where(listed, table[1][at], 0), listed


def _sum_by_text(keys: np.ndarray, owner: np.ndarray, texts: int, values_of) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``values_of`` per text, number of listed keys per text, and the unlisted keys with their texts."""
    order = np.argsort(keys)
    ordered, home = keys[order], owner[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    values, listed = values_of(ordered[new])
    group = np.cumsum(new) - 1
    sums = np.bincount(home, values[group], texts)
    known = listed[group]
    return sums, np.bincount(home[known], minlength=texts), ordered[~known], home[~known]


def score(docs: DataFrame, learn: Column, depth: int = DEPTH, most_grams: int = MOST_GRAMS, most_words: int = MOST_WORDS) -> DataFrame:
    """One row per document: doc_id, learned (whether it was a training row), n_bytes, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    learn = F.coalesce(learn, F.lit(False))
    counts = stage(corpus_counts(docs, learn, depth), "ctw-counts")
    model = stage(gram_probabilities(counts, depth), "ctw-model")
    words = counts.where(F.col("kind") == WORD)
    known = counts.where((F.col("kind").isin(WORD, END_TOKEN)) & (F.col("seen") > 0)).agg(F.sum("seen").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = counts.where(F.col("kind") == END_TOKEN).agg(F.sum("seen")).first()[0] or 0
    n, v = known["n"] or 0, known["v"]
    scale = np.log10(n + 0.1 * (v + 1))
    lists = spark.sparkContext.broadcast((_frequent(model, "logp", most_grams), _frequent(words, "seen", most_words)))
    end_score = float(np.log10(ends + 0.1) - scale)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, seen = lists.value

        def base(keys):
            count, listed = _found(seen, keys)
            return np.where(listed, np.log10(count + 0.1) - scale, 0.0), listed

        def known_words(keys):
            count, listed = _found(seen, keys)
            return np.where(listed & (count > 0), 1.0, 0.0), listed

        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                texts = batch.num_rows
                gram, owner, word, home = prepare(batch.column("text").to_pylist(), depth)
                sums, _, other, other_in = _sum_by_text(gram, owner, texts, lambda k: _found(grams, k))
                base_sums, _, rare, rare_in = _sum_by_text(word, home, texts, base)
                n_known, _, _, _ = _sum_by_text(word, home, texts, known_words)
                # Keys without an entry, as lists beside their text.
                where = np.concatenate([other_in, rare_in])
                order = np.argsort(where, kind="stable")
                offsets = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=texts))])
                kinds = np.concatenate([np.full(len(other), GRAM), np.full(len(rare), WORD)])[order]
                keys = np.concatenate([other, rare])[order].view(np.int64)
                rest = pa.StructArray.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.int64())], ["kind", "key"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("learn"), pa.array(np.bincount(owner, minlength=texts), pa.int64()),
                        pa.array(np.bincount(home, minlength=texts) + 1, pa.int64()), pa.array(n_known.astype(np.int64) + (ends > 0)),
                        pa.array(base_sums + end_score), pa.array(sums), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rest),
                    ],
                    ["doc_id", "learned", "n_bytes", "n_tokens", "n_known", "base_score", "score", "rest"],
                )
            give_back()

    schema = "doc_id long, learned boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double, rest array<struct<kind:int,key:long>>"
    parts = docs.select(F.col("doc_id").cast("long"), "text", learn.alias("learn")).mapInArrow(tasks, schema)
    parts = stage(parts.withColumn("row", F.monotonically_increasing_id()), "ctw-parts")
    rest = parts.select("row", F.explode("rest").alias("r")).select("row", "r.kind", "r.key")
    base_of = F.log10(F.col("seen") + 0.1) - F.lit(float(scale))
    values = model.select(F.lit(GRAM).alias("kind"), "key", "logp", F.lit(0.0).alias("base"), F.lit(0).alias("known")).unionByName(
        words.select("kind", "key", F.lit(0.0).alias("logp"), base_of.alias("base"), (F.col("seen") > 0).cast("int").alias("known"))
    )
    more = rest.join(values, ["kind", "key"]).groupBy("row").agg(F.sum("logp").alias("more_score"), F.sum("base").alias("more_base"), F.sum("known").alias("more_known"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = parts.drop("rest").join(more, "row", "left")
    total = F.col("score") + zero("more_score")
    return out.select(
        "doc_id", "learned", "n_bytes", "n_tokens", (F.col("n_known") + zero("more_known")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + zero("more_base")).alias("base_score"), total.alias("score"), (-total * F.log2(F.lit(10.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
