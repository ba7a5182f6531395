"""N-gram Jaccard join over prefix trees, and the components that its links form.

A document's set holds the 64-bit hashes of its distinct word n-grams. Documents with equal sets are one
class, so copies cost nothing. All sets follow one global order: n-grams that occur often in some task come
last, by their count, the others first, by their hash (the order only steers the work, any order is exact).

1. Sets that reach the threshold share one of their first n - ceil(t * n) + 1 n-grams. These are the rows
   (token, class, size, place) that a shuffle brings together.
2. Star round: in the group of a token every class is compared with the group's leader, the class that has the
   token at the earliest place. Work is linear in the group, whatever its size. Pairs whose sizes, places or
   parities (see below) exclude the threshold are dropped before any set is sent.
3. Rest round: links so far give components. Only classes outside their leader's component meet the others
   of the group, on (token, size band), and only across components. Pairs whose positions, sizes, parities or number of
   common first n-grams exclude the threshold are dropped; nothing is capped. Parities are those of the n-grams in each of
   512 slots: every slot in which two sets differ costs an n-gram that they do not share. With fewer slots large families of
   texts a little below the threshold pass in nearly all their pairs.
4. Every comparison runs in a cell: one probing set and at most ``CELL`` stored ones, in several trees where the sets
   are long (``HELD_TOKENS``). The stored sets form a prefix tree
   (frequent n-grams first, so that near copies share long paths); the probe walks it once, carries the
   overlap of shared paths along, and leaves a subtree when what is left of either side cannot reach
   the threshold.

These rounds list links that connect all that the threshold connects, not every link. ``link_counts`` then counts all
links: inside a component the classes are dealt, by size band and hash, to chunks of about ``CELL`` sets, and every two chunks
whose sizes can reach the threshold meet in a cell that counts each set's links by overlaps from a matrix product.
Every pair of a component is compared there, so that work grows with the square of a component; no pair is written out.

Lower-cases A-Z; words are runs without ASCII white space; a text with fewer words than n is one n-gram; null and
empty texts have an empty set and link with nothing. Rows that repeat a doc_id share its component; a null
doc_id is listed with the component of its set. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklight.llm.common import fits, give_back, hinted, slices
from tracklight.llm.components import connected
from tracklight.runtime import stage

#: n-grams listed as frequent: those in this many different sets of a task's window, the most frequent so many of them.
OFTEN, LISTED, WINDOW = 2, 1 << 20, 6_000_000
CELL = 512
#: What a task holds: hashes of so many words, stored sets of so many n-grams in one tree.
KEPT_WORDS, HELD_TOKENS = 1 << 16, 1 << 19
#: n-grams of a cell that are multiplied at a time.
COLUMNS = 2048
#: Words of 64 slots whose parities stand for a set.
PARITIES = [f"odd{k}" for k in range(8)]
#: Size bands of the rest round are this many times as wide as the sizes apart that reach the threshold.
BAND_STEPS = 4
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


WORDS = WordHashes()


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted hashes of the distinct word n-grams."""
    words = (text or "").encode(errors="surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    if len(WORDS) > KEPT_WORDS:
        WORDS.clear()
    with np.errstate(over="ignore"):
        width = min(n, len(words))
        mixed = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            mixed += hashes[k : len(words) - width + 1 + k] * (ODD[k % 5] + np.uint64(2 * (k // 5)))
        mixed ^= mixed >> np.uint64(32)
        mixed *= ODD[1]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def class_of(tokens: np.ndarray) -> int:
    """A signed 64-bit identifier of a set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def parities(tokens: np.ndarray) -> np.ndarray:
    """For each slot, a bit that tells whether an odd number of the set's n-grams fall into it."""
    slots = 64 * len(PARITIES)
    odd = np.bincount((tokens % np.uint64(slots)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def needed_overlap(a: int, b: int, t: Fraction) -> int:
    """Least overlap of sets with a and b elements whose Jaccard coefficient reaches t."""
    return -(-t.numerator * (a + b) // (t.numerator + t.denominator))


def global_order(tokens: np.ndarray, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A sorted set in the global order: rare n-grams by hash, then frequent ones by count and hash."""
    if not len(often) or not len(tokens):
        return tokens
    place = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
    listed = often[place] == tokens
    if not listed.any():
        return tokens
    last = tokens[listed]
    return np.concatenate([tokens[~listed], last[np.argsort(counts[place[listed]], kind="stable")]])


class PrefixTree:
    """Radix tree over ordered sets: a node has the tokens of its edge, its children, the sets that end in it and
    the least and largest length below."""

    __slots__ = ("label", "children", "ends", "least", "most")

    def __init__(self, sets: list[tuple[list[int], int]], depth: int = 0, end: int | None = None):
        """``sets``: (tokens, identifier) sorted by tokens, equal up to ``end``; the edge covers depth to end."""
        end = depth if end is None else end
        self.label = sets[0][0][depth:end]
        self.least = min(len(s) for s, _ in sets)
        self.most = max(len(s) for s, _ in sets)
        self.ends, self.children = [], []
        work = [(self, sets, end)]
        while work:  # a loop, since a path may be longer than Python's stack
            node, own, at = work.pop()
            first = 0
            while first < len(own) and len(own[first][0]) == at:
                node.ends.append(own[first][1])
                first += 1
            while first < len(own):
                token = own[first][0][at]
                last = first + 1
                while last < len(own) and own[last][0][at] == token:
                    last += 1
                group = own[first:last]
                stop = _common(group[0][0], group[-1][0], at + 1)
                child = PrefixTree.__new__(PrefixTree)
                child.label, child.ends, child.children = group[0][0][at:stop], [], []
                child.least, child.most = min(len(s) for s, _ in group), max(len(s) for s, _ in group)
                node.children.append(child)
                work.append((child, group, stop))
                first = last


def _common(a: list[int], b: list[int], at: int) -> int:
    """Length of the common prefix of two sorted neighbours' range, known to be at least ``at``."""
    stop = min(len(a), len(b))
    while at < stop and a[at] == b[at]:
        at += 1
    return at


def tree_matches(probe: list[int], stored: list[tuple[list[int], int]], t: Fraction) -> list[tuple[int, int]]:
    """(identifier, overlap) of the stored sets whose Jaccard coefficient with the probe reaches t.

    All lists follow one order; stored sets may repeat. Empty sets match nothing.
    """
    stored = sorted((s for s in stored if s[0]), key=lambda s: s[0])
    if not probe or not stored:
        return []
    size, place = len(probe), {token: i for i, token in enumerate(probe)}
    least_size, most_size = math.ceil(t * size), math.floor(size / t)
    found = []
    walk = [(PrefixTree(stored), 0, 0, 0)]
    while walk:
        node, depth, overlap, used = walk.pop()
        low, high = max(node.least, least_size), min(node.most, most_size)
        if low > high:
            continue
        for token in node.label:
            at = place.get(token)
            if at is not None:
                overlap, used = overlap + 1, at + 1
        depth += len(node.label)
        if overlap + min(high - depth, size - used) < needed_overlap(size, low, t):
            continue
        if node.ends and least_size <= depth <= most_size and overlap >= needed_overlap(size, depth, t):
            found.extend((end, overlap) for end in node.ends)
        walk.extend((child, depth, overlap, used) for child in node.children)
    return found


def _classes(docs: DataFrame, n: int) -> DataFrame:
    """Rows of two kinds: (doc_id, size, class, parities) per document, (token, seen) per frequent n-gram of a window."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, amount = [], 0
        met: set[int] = set()

        def frequent() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            tokens, counts = tokens[counts >= OFTEN], counts[counts >= OFTEN]
            none = pa.nulls(len(tokens), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.array(tokens.view(np.int64)), pa.array(counts, pa.int64()), *[none] * len(PARITIES)], names)

        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                sets = [ngram_set(t, n) for t in batch.column("text").to_pylist()]
                none = pa.nulls(len(sets), pa.int64())
                ids = [class_of(s) if len(s) else None for s in sets]
                odd = [pa.array(column, pa.int64()) for column in np.array([parities(s) for s in sets]).reshape(-1, len(PARITIES)).T]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()), none, none, *odd], names)
                for own, tokens in zip(ids, sets):
                    if own is not None and own not in met:
                        met.add(own)
                        held.append(tokens)
                        amount += len(tokens)
                if amount > WINDOW:
                    yield frequent()
                    held, amount = [], 0
            give_back()
        if held:
            yield frequent()

    names = ["doc_id", "size", "class", "token", "seen", *PARITIES]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tasks, ", ".join(f"{name} long" for name in names))


def _places(docs: DataFrame, n: int, t: Fraction, often) -> DataFrame:
    """(token, class, size, place) of the first n-grams of every class; a class may come from several tasks."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts = often.value
        met: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                columns: list[list[np.ndarray]] = [[], [], [], []]
                for text in batch.column("text").to_pylist():
                    tokens = ngram_set(text, n)
                    size = len(tokens)
                    if not size or (own := class_of(tokens)) in met:
                        continue
                    met.add(own)
                    first = global_order(tokens, listed, counts)[: size - math.ceil(t * size) + 1]
                    columns[0].append(first.view(np.int64))
                    columns[1].append(np.full(len(first), own))
                    columns[2].append(np.full(len(first), size))
                    columns[3].append(np.arange(len(first)))
                if columns[0]:
                    arrays = [pa.array(np.concatenate(c), k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))]
                    yield pa.RecordBatch.from_arrays(arrays, ["token", "class", "size", "place"])
            give_back()

    return docs.select("text").mapInArrow(tasks, "token long, class long, size int, place int")


def _sets(docs: DataFrame, n: int, often) -> DataFrame:
    """(class, tokens): sets as bytes in reversed global order, once per class and task."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, counts = often.value
        met: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                ids, sets = [], []
                for text in batch.column("text").to_pylist():
                    tokens = ngram_set(text, n)
                    if len(tokens) and (own := class_of(tokens)) not in met:
                        met.add(own)
                        ids.append(own)
                        sets.append(global_order(tokens, listed, counts)[::-1].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["class", "tokens"])
            give_back()

    return docs.select("text").mapInArrow(tasks, "class long, tokens binary")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the documents with the given ids (column ``rep``)."""
    wanted = hinted(ids, fits(ids, 16))
    return docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi").select("text")


def _links(pairs: DataFrame, docs: DataFrame, reps: DataFrame, n: int, often, t: Fraction) -> DataFrame:
    """(a, b, overlap) of the pairs (a, b) that reach t. A probe with many partners is spread over cells.

    Only sets of classes in pairs are made, from one text of each, and each is sent to the cells it has a part in.
    """
    pairs = stage(pairs, "trie-pairs")
    cells = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells"))
    cells = stage(cells, "trie-cells")
    placed = pairs.join(hinted(cells, fits(cells, 64)), "a").withColumn("cell", F.pmod(F.xxhash64("b"), F.col("cells")).cast("int"))
    stored = placed.select(F.col("b").alias("class"), "a", "cell", F.lit(1).alias("stored"), "b")
    probes = cells.select(F.col("a").alias("class"), "a", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.lit(0).alias("stored"), F.col("a").alias("b"))
    parts = stage(probes.unionByName(stored), "trie-parts")
    ids = stage(reps.join(parts.select("class").distinct(), "class", "left_semi").select("rep"), "trie-ids")
    rows = _sets(_texts(docs, ids), n, often).join(hinted(parts, fits(parts, 48)), "class").select("a", "cell", "stored", "b", "tokens")
    rows = rows.repartition(F.col("a"), F.col("cell")).sortWithinPartitions("a", "cell", "stored")

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, probe, kept, held = None, [], [], 0
        for whole in batches:
            for batch in slices(whole, "tokens", 2 << 20):
                out: list[tuple[int, int, int]] = []
                for a, part, is_stored, b, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                    if (a, part) != cell or held > HELD_TOKENS:
                        if kept:
                            out.extend((cell[0], b_, o) for b_, o in tree_matches(probe, kept, t))
                        kept, held = [], 0
                    if (a, part) != cell:
                        cell, probe = (a, part), []
                    tokens = np.frombuffer(tokens, dtype=np.uint64).tolist()
                    if is_stored:
                        kept.append((tokens, b))
                        held += len(tokens)
                    else:
                        probe = tokens
                yield _pairs_batch(out)
            give_back()
        if kept:
            yield _pairs_batch([(cell[0], b_, o) for b_, o in tree_matches(probe, kept, t)])

    return rows.mapInArrow(tasks, "a long, b long, overlap int")


def _pairs_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    arrays = [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int32()))]
    return pa.RecordBatch.from_arrays(arrays, ["a", "b", "overlap"])


def with_class(docs: DataFrame, n: int) -> DataFrame:
    """The rows with ``own_class``, the class of each row's set (null if it is empty)."""
    fields = [docs.schema[c] for c in docs.columns]
    names = [*docs.columns, "own_class"]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [ngram_set(t, n) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())], names)

    return docs.mapInArrow(tasks, T.StructType([*fields, T.StructField("own_class", T.LongType())]))


def jaccard_links(docs: DataFrame, n: int, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, size, class) and links (a, b, overlap) between classes that connect all that the
    threshold connects."""
    spark, t = docs.sparkSession, Fraction(threshold)
    if not 0 < t <= 1:
        raise ValueError("the threshold lies above 0 and up to 1")
    found = stage(_classes(docs, n), "trie-classes")
    rows = found.where("token is null").select("doc_id", "size", "class", *PARITIES)
    top = found.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).orderBy(F.desc("seen"), "token").limit(LISTED).toArrow()
    tokens = np.array(top["token"].to_numpy(), dtype=np.int64).view(np.uint64)
    order = np.argsort(tokens)
    often = spark.sparkContext.broadcast((tokens[order], np.array(top["seen"].to_numpy(), dtype=np.int64)[order]))

    reps = stage(rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), *[F.first(p).alias(p) for p in PARITIES]), "trie-reps")
    places = stage(_places(_texts(docs, reps.select("rep")), n, t, often), "trie-places")
    leader = places.groupBy("token").agg(F.min(F.struct("place", "class", "size")).alias("leader"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = stage(places.join(leader.select("token", "leader"), "token"), "trie-shared")

    # Sizes and places that can still reach t; a common n-gram before this one is possible on both sides.
    top_, bottom = t.numerator, t.denominator

    def possible(size_a, place_a, size_b, place_b, before):
        bound = before + F.least(size_a - place_a, size_b - place_b)
        return (bound * (top_ + bottom) >= top_ * (size_a + size_b)) & (F.least(size_a, size_b) * bottom >= F.greatest(size_a, size_b) * top_)

    star = shared.where("class <> leader.class").where(
        possible(F.col("size"), F.col("place"), F.col("leader.size"), F.col("leader.place"), F.least("place", "leader.place"))
    )
    star = star.select(F.col("leader.class").alias("a"), F.col("class").alias("b"), F.col("leader.size").alias("size_a"), F.col("size").alias("size_b"))
    star = stage(star.distinct(), "trie-star")

    def alike(size_a, size_b, left: str, right: str):
        """The slots that differ in parity are at most as many as the n-grams that only one of both has."""
        differ = sum((F.bit_count(F.col(f"{left}.{p}").bitwiseXOR(F.col(f"{right}.{p}"))) for p in PARITIES), F.lit(0))
        sizes = size_a.cast("long") + size_b
        return (sizes - differ) * (top_ + bottom) >= sizes * 2 * top_

    # Parities of both ends, before any set is sent: small rows beside the classes.
    small, odd = fits(star, 160), reps.select("class", *PARITIES)
    met = hinted(star, small).alias("s").join(odd.alias("x"), F.col("s.a") == F.col("x.class")).select("s.*", F.struct("x.*").alias("x"))
    met = hinted(met, small).alias("s").join(odd.alias("y"), F.col("s.b") == F.col("y.class"))
    near = met.where(alike(F.col("s.size_a"), F.col("s.size_b"), "s.x", "y")).select("a", "b")
    links = stage(_links(near, docs, reps, n, often, t).distinct(), "trie-links")

    roots = stage(connected(links.select("a", "b")), "trie-roots")
    labelled = shared.join(hinted(roots, fits(roots, 16)).withColumnRenamed("node", "class"), "class", "left")
    labelled = labelled.select("token", "class", "size", "place", F.coalesce("root", "class").alias("root"), F.col("leader.class").alias("lead"))
    groups = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max(F.when(F.col("class") == F.col("lead"), F.col("root"))).alias("lead_root"))
    groups = stage(groups.where("low <> high").select("token", "lead_root"), "trie-open")
    # Sizes that reach t lie in one band or in two, of which most sets need one. The margin covers rounded logarithms.
    step = math.log(1 / float(t) if t < 1 else 2.0)
    in_band = lambda steps: F.floor((F.log(F.col("size").cast("double")) / step + steps) / BAND_STEPS).cast("int")
    open_rows = labelled.join(groups, "token").withColumn("band", in_band(0)).join(odd, "class")
    open_rows = stage(open_rows, "trie-open-rows")
    outside = open_rows.where("root <> lead_root").withColumn("band", F.explode(F.array_distinct(F.array(in_band(-1 - 1e-9), in_band(1 + 1e-9)))))
    o, r = outside.alias("o"), open_rows.alias("r")
    across = o.join(r, (F.col("o.token") == F.col("r.token")) & (F.col("o.band") == F.col("r.band")) & (F.col("o.root") != F.col("r.root")))
    across = across.where(alike(F.col("o.size"), F.col("r.size"), "o", "r"))
    # Both outside: each pair once per token.
    across = across.where((F.col("r.root") == F.col("r.lead_root")) | (F.col("o.class") < F.col("r.class")))
    across = across.where(possible(F.col("o.size"), F.col("o.place"), F.col("r.size"), F.col("r.place"), F.least("o.place", "r.place")))
    first = F.col("o.class") < F.col("r.class")
    ends = {"a": ("o", "r"), "b": ("r", "o")}
    across = across.select(
        *[F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(f"{c}_{e}") for e, (x, y) in ends.items() for c in ("class", "place", "size")]
    )
    met = across.groupBy(F.col("class_a").alias("a"), F.col("class_b").alias("b")).agg(
        F.min("place_a").alias("place_a"), F.min("place_b").alias("place_b"), F.first("size_a").alias("size_a"), F.first("size_b").alias("size_b"),
        F.count(F.lit(1)).alias("common"),
    )
    # All common first n-grams were seen, so nothing precedes the earliest of them. Of the set whose first n-grams end
    # earlier in the global order, all but size - overlap are common: so many must have been seen at least.
    up = lambda amount, by: F.floor((amount + by - 1) / by)
    overlap = up((F.col("size_a") + F.col("size_b")) * top_, top_ + bottom)
    seen = overlap + 1 - up(F.greatest("size_a", "size_b") * top_, bottom)
    rest = met.where(possible(F.col("size_a"), F.col("place_a"), F.col("size_b"), F.col("place_b"), F.lit(0))).where(F.col("common") >= seen)
    compared = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = rest.select("a", "b").join(hinted(compared, fits(compared, 32)), ["a", "b"], "left_anti")
    more = stage(_links(rest, docs, reps, n, often, t).distinct(), "trie-links")
    return rows, links.unionByName(more)


def _cell_counts(sets: list[np.ndarray], left: np.ndarray, t: Fraction) -> np.ndarray:
    """For each set, its links with the sets of the other side; all are on the left where a chunk meets itself."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = held[column] > 1
    row, column = np.repeat(np.arange(len(sets)), sizes)[shared], (np.cumsum(held > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    alone = bool(left.all())
    one, two = np.flatnonzero(left), np.flatnonzero(left if alone else ~left)
    overlap = np.zeros((len(one), len(two)), dtype=np.int64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        begin, end = np.searchsorted(column, [first, first + COLUMNS])
        block = np.zeros((len(sets), min(COLUMNS, int(column[-1]) + 1 - first)), dtype=np.float32)
        block[row[begin:end], column[begin:end] - first] = 1
        overlap += (block[one] @ block[two].T).astype(np.int64)
    linked = overlap * (t.numerator + t.denominator) >= t.numerator * (sizes[one][:, None] + sizes[two])
    if alone:
        np.fill_diagonal(linked, False)
    counts = np.zeros(len(sets), dtype=np.int64)
    counts[one] = linked.sum(1)
    if not alone:
        counts[two] = linked.sum(0)
    return counts


def link_counts(docs: DataFrame, members: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """(class, n_links): how many other classes each of ``members`` (class, rep, size, root) links with."""
    t, cell = Fraction(threshold), ["root", "band_a", "chunk_a", "band_b", "chunk_b"]
    # Sizes that reach t lie in the same or in neighbouring bands.
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(1 / float(t) if t < 1 else 2.0) + 1e-9).cast("int")
    members = members.withColumn("band", band)
    chunks = F.greatest(F.ceil(F.count(F.lit(1)) / CELL), F.ceil(F.sum("size") / HELD_TOKENS)).cast("int")
    groups = stage(members.groupBy("root", "band").agg(chunks.alias("chunks")), "trie-groups")
    members = stage(members.join(groups, ["root", "band"]).withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int")), "trie-members")
    parts = groups.select("root", "band", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    a = parts.select("root", F.col("band").alias("band_a"), F.col("chunk").alias("chunk_a"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band_b"))
    b = parts.select("root", F.col("band").alias("band_b"), F.col("chunk").alias("chunk_b"))
    cells = stage(a.join(b, ["root", "band_b"]).where("band_a < band_b or chunk_a <= chunk_b").select(*cell), "trie-count-cells")
    same = (F.col("band_a") == F.col("band_b")) & (F.col("chunk_a") == F.col("chunk_b"))
    sides = cells.select(*cell, F.col("band_a").alias("band"), F.col("chunk_a").alias("chunk"), F.lit(0).alias("side")).unionByName(
        cells.where(~same).select(*cell, F.col("band_b").alias("band"), F.col("chunk_b").alias("chunk"), F.lit(1).alias("side"))
    )
    placed = members.join(sides, ["root", "band", "chunk"]).select("class", *cell, "side")
    no_order = docs.sparkSession.sparkContext.broadcast((np.empty(0, np.uint64), np.empty(0, np.int64)))
    rows = _sets(_texts(docs, members.select("rep")), n, no_order).join(placed, "class").select(*cell, "side", "class", "tokens")
    rows = rows.repartition(*cell).sortWithinPartitions(*cell)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}

        def counted() -> pa.RecordBatch:
            found = _cell_counts([s for _, s in held.values()], np.array([side == 0 for side, _ in held.values()]), t) if held else []
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(found, pa.int64())], ["class", "n_links"])

        for whole in batches:
            for batch in slices(whole, "tokens", 2 << 20):
                for *key, side, own, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                    if key != at:
                        yield counted()
                        at, held = key, {}
                    held[own] = side, np.frombuffer(tokens, dtype=np.uint64)  # several tasks may send a class
            give_back()
        yield counted()

    return rows.mapInArrow(tasks, "class long, n_links long").groupBy("class").agg(F.sum("n_links").alias("n_links"))


def near_components(docs: DataFrame, n: int = 3, threshold: Fraction = Fraction(9, 10), counted: bool = True) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id reachable by links), class, n_links
    (different sets that its own links with; left out unless ``counted``), class_size (documents with the same set)."""
    rows, links = jaccard_links(docs, n, threshold)
    classes = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("class_size"), F.first("size").alias("size"))
    roots = stage(classes.join(connected(links.select("a", "b")).withColumnRenamed("node", "class"), "class", "left").where("class_size > 1 or root is not null"), "trie-all-roots")
    known = roots.withColumn("root", F.coalesce("root", "class"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("class", "component_id", "class_size")
    if counted:
        members = roots.where("root is not null").select("class", F.col("least").alias("rep"), "size", "root")
        known = known.join(link_counts(docs, members, n, threshold), "class", "left")
    known = stage(known, "trie-components")
    out = rows.join(hinted(known, fits(known, 64)), "class", "left")
    own = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if counted else []
    return out.select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "class",
        *own, F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )
