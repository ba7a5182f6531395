"""Document fingerprints: a Merkle tree over paragraphs and sections.

Leaves are paragraphs (lines). A leaf's digest covers its bytes; a section's digest covers those of its
paragraphs, the root those of the sections. Sections are content-defined: one ends before a blank line and after a
paragraph whose digest is a multiple of eight, so an edit changes the sections around it and no others. The
fingerprint string holds the whole tree::

    root | section = paragraph : marks ; paragraph : marks | section = ...

Equal roots mean equal texts. Differing roots are descended: equal sections and paragraphs match as a whole, and what
remains is compared by marks, three-byte checksums of the phrases (up to 24 bytes, ended by punctuation)
of a paragraph. The likeness of two fingerprints is 2 * matched / (marks of both), 1 only for equal texts.

Null text counts as empty; the empty text is one empty paragraph with a single mark. Paragraphs may repeat:
matching counts them as often as both sides have them. Very long texts are hashed whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Phrases end at punctuation or at 24 bytes, in lines under ``SHORT`` bytes at 6.
PHRASE = re.compile(rb"[^.!?,;|\n]{1,24}[.!?,;|]*|[.!?,;|]+")
SHORT, SHORT_PHRASE = 48, re.compile(rb"[^.!?,;|\n]{1,6}[.!?,;|]*|[.!?,;|]+")
EMPTY_MARK = np.zeros(1, dtype=np.uint32)


class Paragraph:
    """Digest and marks of one line."""

    __slots__ = ("digest", "marks")

    def __init__(self, line: bytes):
        self.digest = hashlib.blake2b(line, digest_size=12).digest()
        marks = [zlib.crc32(p) & 0xFFFFFF for p in (PHRASE if len(line) >= SHORT else SHORT_PHRASE).findall(line)]
        self.marks = np.array(marks, dtype=np.uint32) if marks else EMPTY_MARK


class Tree:
    """Root, and sections as (digest, paragraphs)."""

    __slots__ = ("root", "sections")

    def __init__(self, text: bytes, known: dict[bytes, Paragraph] | None = None):
        known = {} if known is None else known
        self.sections: list[tuple[bytes, list[Paragraph]]] = []
        own: list[Paragraph] = []
        for line in text.split(b"\n"):
            paragraph = known.get(line)
            if paragraph is None:
                paragraph = known[line] = Paragraph(line)
            if own and not line.strip():
                self._close(own)
                own = []
            own.append(paragraph)
            if paragraph.digest[0] % 8 == 0:
                self._close(own)
                own = []
        if own:
            self._close(own)
        self.root = hashlib.blake2b(b"".join(d for d, _ in self.sections), digest_size=16).hexdigest()

    def _close(self, own: list[Paragraph]) -> None:
        self.sections.append((hashlib.blake2b(b"".join(p.digest for p in own), digest_size=12).digest(), own))

    def __str__(self) -> str:
        parts = [self.root]
        for digest, own in self.sections:
            inner = ";".join(f"{p.digest.hex()}:{_packed(p.marks)}" for p in own)
            parts.append(f"{digest.hex()}={inner}")
        return "|".join(parts)

    @classmethod
    def parse(cls, fingerprint: str) -> Tree:
        tree = cls.__new__(cls)
        tree.root, *sections = fingerprint.split("|")
        tree.sections = []
        for section in sections:
            digest, _, inner = section.partition("=")
            own = []
            for part in inner.split(";"):
                paragraph = Paragraph.__new__(Paragraph)
                code, _, marks = part.partition(":")
                paragraph.digest, paragraph.marks = bytes.fromhex(code), _unpacked(marks)
                own.append(paragraph)
            tree.sections.append((bytes.fromhex(digest), own))
        return tree


def _packed(marks: np.ndarray) -> str:
    return base64.b64encode(marks.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()).decode().replace("=", "")


def _unpacked(text: str) -> np.ndarray:
    data = np.frombuffer(base64.b64decode(text), dtype=np.uint8).reshape(-1, 3)
    return np.hstack([data, np.zeros((len(data), 1), np.uint8)]).copy().view("<u4").ravel()


def _unmatched(a: list, b: list, key) -> tuple[list, list]:
    """What is left of both lists after equal keys have been matched one to one."""
    common = Counter(map(key, a)) & Counter(map(key, b))
    if not common:
        return a, b
    left = []
    for side in (a, b):
        open_, rest = dict(common), []
        for item in side:
            k = key(item)
            if open_.get(k, 0):
                open_[k] -= 1
            else:
                rest.append(item)
        left.append(rest)
    return left[0], left[1]


def _amount(paragraphs: list[Paragraph]) -> int:
    return sum(len(p.marks) for p in paragraphs)


def likeness(a: Tree, b: Tree) -> float:
    """Share of marks that match, descending only branches that differ; 1 exactly for equal roots."""
    if a.root == b.root:
        return 1.0
    total = sum(_amount(own) for tree in (a, b) for _, own in tree.sections)
    left, right = _unmatched(a.sections, b.sections, lambda s: s[0])
    left, right = _unmatched([p for _, own in left for p in own], [p for _, own in right for p in own], lambda p: p.digest)
    matched = (total - _amount(left) - _amount(right)) // 2
    if left and right:
        x, m = np.unique(np.concatenate([p.marks for p in left]), return_counts=True)
        y, n = np.unique(np.concatenate([p.marks for p in right]), return_counts=True)
        _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        matched += int(np.minimum(m[i], n[j]).sum())
    return min(2 * matched / total, 1 - 1e-9)


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph), both from 0, of the paragraphs of fingerprint ``b`` that ``a`` does not have."""
    one, two = Tree.parse(a), Tree.parse(b)
    if one.root == two.root:
        return []
    same = Counter(d for d, _ in one.sections)
    open_ = Counter()
    for digest, own in one.sections:
        open_.update(p.digest for p in own)
    out, checked = [], []
    for s, (digest, own) in enumerate(two.sections):
        if same[digest] > 0:
            same[digest] -= 1
            open_.subtract(p.digest for p in own)
        else:
            checked.append((s, own))
    for s, own in checked:
        for k, paragraph in enumerate(own):
            if open_[paragraph.digest] > 0:
                open_[paragraph.digest] -= 1
            else:
                out.append((s, k))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``fingerprint`` of its text (replaced if there is one)."""

    @F.pandas_udf("string")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([str(Tree((t or "").encode(errors="surrogatepass"))) for t in texts])

    return docs.withColumn("fingerprint", fingerprint(F.col("text")))


def edited_tail(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or all) of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def in_id_order(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows (bucket, guard, doc_id, text) such that each bucket holds a range of ids, and as guard the first row of the next
    bucket (of the first bucket for the last one). Only ids are read for the bounds; the driver keeps one per bucket.
    """
    spark = docs.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    ranges = ids.repartitionByRange(buckets, "doc_id").groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("least"))
    lows = np.array(sorted({r["least"] for r in ranges.collect()}), dtype=np.int64)
    # Null ids come first, in a bucket of their own if there are any.
    has_null = not docs.where("doc_id is null").isEmpty()
    count = len(lows) + has_null

    @F.pandas_udf("array<int>")
    def homes(doc_id: pd.Series) -> pd.Series:
        null = doc_id.isna().to_numpy()
        values = doc_id.fillna(0).astype("int64").to_numpy()
        own = np.maximum(np.searchsorted(lows, values, side="right") - 1, 0) + has_null
        own[null] = 0
        first = null | ((lows[own - has_null] == values) if len(lows) else False)
        return pd.Series([[o, (o - 1) % count] if f else [o] for o, f in zip(own.tolist(), first.tolist())])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.posexplode(homes("doc_id")).alias("guard", "bucket"))
    return rows.select("bucket", "guard", "doc_id", "text").repartition("bucket").sortWithinPartitions("bucket", "guard", "doc_id", "text")


def compare_with_edited(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_paragraphs (how many
    of the edited text's paragraphs the text lacks).

    The next document is the one with the next higher id (after the last: the first); rows that repeat an id follow
    each other by text, a null id comes before all. Each text is sent once, to the bucket of its id range.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edited_paragraphs"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32()]

        def pair(doc_id, text, known, tree, following, next_tree):
            edited = edited_tail(text, following).encode(errors="surrogatepass")
            other = Tree(edited, known)
            lacking = _unmatched([p for _, own in tree.sections for p in own], [p for _, own in other.sections for p in own], lambda p: p.digest)[1]
            return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), str(tree), str(other), likeness(tree, other), likeness(tree, next_tree), len(lacking))

        def read(text):
            known: dict[bytes, Paragraph] = {}
            return known, Tree(text.encode(errors="surrogatepass"), known)

        before, closed = None, None
        out, held = [], 0
        for batch in batches:
            for bucket, guard, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket == closed:
                    continue  # a guard id that repeats: only its first row follows
                if before is not None and before[0] != bucket:
                    raise ValueError("a bucket without its guard")
                known, tree = read(text)
                if before is not None:
                    out.append(pair(*before[1:], text, tree))
                    held += len(out[-1][3]) + len(out[-1][4])
                before, closed = (None, bucket) if guard else ((bucket, doc_id, text, known, tree), None)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edited_paragraphs int"
    return in_id_order(docs, buckets).mapInArrow(tasks, schema)
