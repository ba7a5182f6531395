"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's evidence is linear in its own features and in those of the lines before and
after it; transitions tie neighbouring lines together. Forward-backward gives each line's probability of
being good, and the mean over lines, weighted by their length, is the document's quality.

Learning: a line inherits the label of its document. At most ``max_docs`` labelled documents, those with the
smallest hash of their id, are read, each with all its lines; only their features reach the driver, 152 bytes a line. Conditional likelihood with a squared penalty is climbed by
Adam over whole-sample gradients. Labels, language, source and id are not inputs of a score.

Null text counts as empty. An empty text is one empty line and gets that line's score. White-space-only
lines weigh 1. Rows that repeat are scored again, alike. Labels of one kind only give every line about 0.98 for that kind, no
labels 0.5. An empty table gives no rows. Other columns pass through; columns named like the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklight.llm.common import give_back, slices

NAMES = ["upper", "digits", "symbols", "stops", "non_ascii", "spaces", "distinct", "new", "word_length", "words", "short", "empty"]
WIDTH = len(NAMES)
#: Byte classes: 0 other letters, 1 upper case, 2 digits, 3 symbols, 4 sentence marks, 5 bytes above ASCII, 6 blanks.
CLASSES = np.zeros(256, dtype=np.int64)
CLASSES[ord("A") : ord("Z") + 1] = 1
CLASSES[ord("0") : ord("9") + 1] = 2
for code in range(33, 127):
    if not chr(code).isalnum():
        CLASSES[code] = 4 if chr(code) in ".,;:?'\"()-" else 3
CLASSES[128:] = 5
CLASSES[[9, 10, 11, 12, 13, 32]] = 6
CLASSES[:9] = 3


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of all texts, their lengths in characters, and the number of lines of each text."""
    lines, counts, extra, chars = [], [], [], []
    for text in texts:
        own = text.split("\n")
        counts.append(len(own))
        seen: set[str] = set()
        for line in own:
            words = line.split()
            n, kinds = len(words), len(set(words))
            extra.append((kinds / n if n else 1.0, 0.0 if line in seen and n > 2 else 1.0, n))
            if n > 2:
                seen.add(line)
            chars.append(len(line))
        lines.extend(own)
    encoded = [line.encode() + b"\n" for line in lines]
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
    owner = np.repeat(np.arange(len(encoded)), sizes)
    held = np.bincount(owner * 7 + CLASSES[data], minlength=7 * len(encoded)).reshape(-1, 7).astype(np.float64)
    held[:, 6] -= 1  # the line end added above
    size = np.maximum(sizes - 1, 1).astype(np.float64)
    more = np.array(extra, dtype=np.float64).reshape(-1, 3)
    words = more[:, 2]
    out = np.empty((len(encoded), WIDTH))
    for column, kind in enumerate((1, 2, 3, 4, 5, 6)):
        out[:, column] = np.sqrt(held[:, kind] / size)
    out[:, 6], out[:, 7] = more[:, 0], more[:, 1]
    out[:, 8] = np.log1p(size / np.maximum(words, 1))
    out[:, 9] = np.log1p(words) / 3
    out[:, 10] = words < 4
    out[:, 11] = words == 0
    return out, np.array(chars, dtype=np.float64), np.array(counts, dtype=np.int64)


def with_neighbours(own: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after in the same text (zeros beyond its ends), and both ends as flags."""
    n = len(own)
    ends = np.cumsum(counts)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[ends - counts], last[ends - 1] = True, True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first], after[last] = 0, 0
    return np.hstack([own, before, after, first[:, None], last[:, None]])


@dataclass
class Model:
    """Evidence for good over bad: (x - mean) / scale @ weight + bias; transition[a, b] from label a to b."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    transition: np.ndarray

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weight + self.bias

    def marginals(self, evidence: list[float]) -> list[float]:
        """Probability of good for each line of one text, by forward-backward in ratios of good to bad."""
        (bb, bg), (gb, gg) = np.exp(self.transition).tolist()
        n = len(evidence)
        forward, backward, ratio = [0.0] * n, [0.0] * n, 0.0
        for i, e in enumerate(evidence):
            if i:
                p = 1 / (1 + math.exp(-min(max(ratio, -500.0), 500.0)))
                e += math.log(((1 - p) * bg + p * gg) / ((1 - p) * bb + p * gb))
            forward[i] = ratio = e
        ratio = 0.0
        for i in range(n - 2, -1, -1):
            p = 1 / (1 + math.exp(-min(max(ratio + evidence[i + 1], -500.0), 500.0)))
            ratio = math.log(((1 - p) * gb + p * gg) / ((1 - p) * bb + p * bg))
            backward[i] = ratio
        return [1 / (1 + math.exp(-min(max(f + b, -500.0), 500.0))) for f, b in zip(forward, backward)]

    def scores(self, texts: list[str]) -> tuple[list[float], list[int], list[int]]:
        """Quality, lines and lines that are likelier good, of each text."""
        own, chars, counts = line_features(texts)
        evidence = self.evidence(with_neighbours(own, counts)).tolist()
        weight = np.maximum(chars, 1)
        good = []
        begin = 0
        for n in counts.tolist():
            good.extend(self.marginals(evidence[begin : begin + n]))
            begin += n
        good = np.array(good)
        starts = np.cumsum(counts) - counts
        quality = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
        return np.clip(quality, 0, 1).tolist(), counts.tolist(), np.add.reduceat((good > 0.5).astype(np.int64), starts).tolist()


def neutral(labels: np.ndarray) -> Model:
    """The model of labels of one kind, or of none: the same evidence for every line."""
    width = 3 * WIDTH + 2
    bias = 0.0 if not len(labels) else 4.0 if labels[0] == 1 else -4.0
    return Model(np.zeros(width), np.ones(width), np.zeros(width), bias, np.zeros((2, 2)))


def fit_sample(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = 150, rate: float = 0.1, penalty: float = 1e-3) -> Model:
    """Climbs the conditional likelihood of the label chains; each text weighs by its class so that both classes count alike."""
    if len(set(labels.tolist())) < 2:
        return neutral(labels)
    mean, scale = x.mean(0), x.std(0)
    scale[scale < 1e-6] = 1.0
    z = (x - mean) / scale
    # Lines lie by their place in the text, texts of most lines first, so that no short text takes the room of a long one.
    order = np.argsort(-counts, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    longest = int(counts.max())
    there = len(counts) - np.searchsorted(np.sort(counts), np.arange(longest), side="right")  # texts with more than t lines
    starts = np.cumsum(there) - there
    row = np.repeat(np.arange(len(counts)), counts)
    column = np.arange(len(x)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.argsort(starts[column] + rank[row], kind="stable")
    z, row = z[at], row[at]
    later = np.arange(there[0], len(z))  # lines that have one before
    before = later - np.repeat(there[:-1], there[1:])
    last = starts[counts - 1] + rank
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    truth = labels[row].astype(np.float64)
    pairs = np.maximum(counts - 1, 0)
    spans = list(zip(starts.tolist(), there.tolist()))
    weight, bias, transition = np.zeros(z.shape[1]), 0.0, np.zeros((2, 2))
    first = [np.zeros_like(weight), 0.0, np.zeros((2, 2))]
    second = [np.zeros_like(weight), 0.0, np.zeros((2, 2))]
    for step in range(1, steps + 1):
        score = np.zeros((len(z), 2))
        score[:, 1] = z @ weight + bias
        alpha, beta = score.copy(), np.zeros((len(z), 2))
        for (begin, _), (here, n) in zip(spans, spans[1:]):
            prior = alpha[begin : begin + n]
            alpha[here : here + n] += np.logaddexp(prior[:, :1] + transition[0], prior[:, 1:] + transition[1])
        total = np.logaddexp(alpha[last, 0], alpha[last, 1])[row]
        for (begin, _), (here, n) in zip(spans[-2::-1], spans[:0:-1]):
            ahead = beta[here : here + n] + score[here : here + n]
            beta[begin : begin + n] = np.logaddexp(transition[:, 0] + ahead[:, :1], transition[:, 1] + ahead[:, 1:])
        good = np.exp(alpha[:, 1] + beta[:, 1] - total)
        joint = alpha[before, :, None] + transition + (beta + score)[later, None, :] - total[later, None, None]
        # The mean over a text's lines, so that long texts do not outweigh short ones.
        each = (share / counts)[row]
        miss = (truth - good) * each
        seen = np.zeros((2, 2))
        expected = (np.exp(joint) * each[later, None, None]).sum(0)
        for label in (0, 1):
            seen[label, label] = ((share / counts) * pairs)[labels == label].sum()
        slopes = [z.T @ miss - penalty * weight, miss.sum(), seen - expected - penalty * 10 * transition]
        values = [weight, bias, transition]
        for k, slope in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            values[k] = values[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        weight, bias, transition = values
    return Model(mean, scale, weight, float(bias), transition)


def fit(docs: DataFrame, labelled: DataFrame, max_docs: int = 3000) -> Model:
    """Learns from ``labelled`` (doc_id, quality), already without held-out rows; reads text only of the sample."""
    chosen = labelled.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    schema = "quality int, counts int, x binary"

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                own, _, counts = line_features(batch.column("text").to_pylist())
                x = with_neighbours(own, counts).astype(np.float32)
                begin = np.cumsum(counts) - counts
                pieces = [x[b : b + n] for b, n in zip(begin, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("quality").cast(pa.int32()), pa.array([len(p) for p in pieces], pa.int32()), pa.array([p.tobytes() for p in pieces], pa.binary())],
                    ["quality", "counts", "x"],
                )
            give_back()

    rows = sample.select("text", "quality").mapInArrow(tasks, schema).toArrow()
    # The rows come in any order; sorted bytes make the sums, and so the model, the same in every run.
    order = sorted(range(rows.num_rows), key=lambda i: (rows["quality"][i].as_py(), rows["x"][i].as_py()))
    if not order:
        return neutral(np.empty(0))
    x = np.vstack([np.frombuffer(rows["x"][i].as_py(), dtype=np.float32).reshape(-1, 3 * WIDTH + 2) for i in order]).astype(np.float64)
    counts = np.array([rows["counts"][i].as_py() for i in order], dtype=np.int64)
    return fit_sample(x, counts, np.array([rows["quality"][i].as_py() for i in order]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and quality_score, n_lines, n_good_lines."""
    own = ["quality_score", "n_lines", "n_good_lines"]
    kept = [c for c in docs.columns if c.lower() not in own]
    kinds = [T.DoubleType(), T.IntegerType(), T.IntegerType()]
    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(n, k) for n, k in zip(own, kinds)]])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 2 << 20):
                quality, lines, good = model.scores([t or "" for t in batch.column("text").to_pylist()])
                found = [pa.array(quality, pa.float64()), pa.array(lines, pa.int32()), pa.array(good, pa.int32())]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], [*kept, *own])
            give_back()

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(tasks, schema)
