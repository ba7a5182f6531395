"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is a chain of characters. Every adjacent pair whose concatenation is a piece enters an agenda that
is ordered by piece score, then by position; the best pair is merged, and its two new neighbours enter. What is not a
piece in the end falls back to its bytes. Agendas of chunks of equal length are rows of one matrix and take their
turns together; long chunks have a heap.

No piece holds a space mark after another character, and some characters (line ends) are in no longer
piece. A merge across such a place is impossible, so the chain is cut there, each cut chunk is solved on
its own, and a bounded table keeps the answers of frequent chunks. The loader proves both properties from
the vocabulary; where they do not hold, the whole text is one chunk. In each Arrow batch the chunks solved
for the first time are encoded by the sentencepiece library too, and a difference raises an error. Ids
are decoded by the library's decode(ids).

Null text counts as empty: no ids, empty decoded text. Very long texts are encoded whole. Other columns
are passed through; columns named ``ids`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklight.llm.chunk_table import ChunkTable, Ids, flat_ids, joined, per_text
from tracklight.llm.common import give_back, held, slices

SPACE = "▁"
KEPT_CHUNKS, KEPT_IDS = 100_000, 1 << 20
SHORT = 48
#: Chunks of equal length that share an agenda.
TOGETHER = 1 << 14
#: Chunks that the library encodes as one text.
ASKED = 64


class Codec:
    """Encoder built from a serialized model; ``check`` compares new chunks with the library."""

    def __init__(self, model: bytes, check: bool = True):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        library, size = self.library, self.library.get_piece_size()
        special = [library.is_control(i) or library.is_unknown(i) or library.is_unused(i) for i in range(size)]
        self.bytes_of = {int(library.id_to_piece(i)[3:5], 16): i for i in range(size) if library.is_byte(i)}
        self.ids = {library.id_to_piece(i): i for i in range(size) if not special[i] and not library.is_byte(i)}
        self.cost = {piece: -library.get_score(i) for piece, i in self.ids.items()}
        if any(library.is_unused(i) for i in range(size)) or len(self.bytes_of) != 256:
            raise ValueError("expected a merge vocabulary with byte fallback and no unused pieces")
        self.check = check
        self.known = ChunkTable(1, self._solve, KEPT_CHUNKS, KEPT_IDS)
        self.pieces = [library.id_to_piece(i) for i in range(size)]
        #: The id of a character that is no piece, and the place of a pair that makes none.
        self.no_piece, self.none = size, len(self.ids)
        self.letters = np.full(0x110000, self.no_piece, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.letters[ord(piece)] = i
        ordered = sorted(self.ids, key=lambda p: (self.cost[p], self.ids[p]))
        place = {piece: i for i, piece in enumerate(ordered)}
        self.by_place = np.array([self.ids[p] for p in ordered], dtype=np.int64)
        splits = ((p, p[:i], p[i:]) for p in self.ids for i in range(1, len(p)))
        pairs = {self.ids[a] * (size + 1) + self.ids[b]: place[p] for p, a, b in splits if a in self.ids and b in self.ids}
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_places = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        scores = Counter(self.cost[p] for p in self.ids if len(p) > 1)
        #: Neighbours in pieces of equal scores (runs of spaces): where these occur, the leftmost of equal pairs must be merged first.
        self.tied = {p[i : i + 2] for p in self.ids if len(p) > 1 and scores[self.cost[p]] > 1 for i in range(len(p) - 1)}
        long = [p for p in self.ids if len(p) > 1]
        marks_lead = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in long)
        lines_alone = not any("\n" in p for p in long)
        self.cut = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+") if marks_lead and lines_alone else None

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return self.cut.findall(marked) if self.cut else [marked]

    def merge_all(self, chunks: list[str]) -> list[Ids]:
        """Ids of the chunks: short ones of equal length share an agenda, long ones and those with tied pairs have their own."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        alone = sizes > SHORT
        if self.tied:
            alone |= np.fromiter((any(t in c for t in self.tied) for c in chunks), bool, len(chunks))
        rows, ids = [], []
        for size in np.unique(sizes[~alone]).tolist():
            of_size = np.flatnonzero((sizes == size) & ~alone)
            for begin in range(0, len(of_size), TOGETHER):
                own = of_size[begin : begin + TOGETHER]
                for done, symbols in self._merge_equal([chunks[i] for i in own.tolist()], size):
                    rows.append(np.repeat(own[done], symbols.shape[1]))
                    ids.append(symbols.ravel())
        for row in np.flatnonzero(alone).tolist():
            symbols = self._ids(self._merge_long(list(chunks[row])))
            rows.append(np.full(len(symbols), row))
            ids.append(np.array(symbols, dtype=np.int64))
        row, symbol = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, ids))
        order = np.argsort(row, kind="stable")
        row, symbol = row[order], symbol[order]
        unknown = set(row[symbol == self.no_piece].tolist())
        lengths = np.bincount(row, minlength=len(chunks))
        if unknown:
            ends = np.cumsum(lengths)
            parts = np.split(symbol, ends[:-1])
            for i in unknown:
                parts[i] = np.array(self._with_bytes(parts[i].tolist(), chunks[i]), dtype=np.int64)
                lengths[i] = len(parts[i])
            symbol = np.concatenate(parts)
        return [(symbol, lengths)]

    def _merge_equal(self, chunks: list[str], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, symbols) of chunks with ``size`` characters each, as they are done.

        The agenda is a matrix: for each chunk the place, in the order of scores, of the piece that each adjacent pair would
        make. In every turn the first of the least of each chunk is merged, and its two new pairs are looked up.
        """
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        symbols = self.letters[points].astype(np.int64).reshape(len(chunks), size)
        agenda = self._places(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(chunks))
        while size > 1:
            first = agenda.argmin(axis=1)
            every = np.arange(len(rows))
            least = agenda[every, first]
            done = least == self.none
            if done.any():
                yield rows[done], symbols[done]
                left = ~done
                rows, symbols, agenda, first, least = rows[left], symbols[left], agenda[left], first[left], least[left]
                every = np.arange(len(rows))
            if not len(rows):
                return
            size -= 1
            kept = np.arange(size)[None, :]
            symbols = np.take_along_axis(symbols, kept + (kept > first[:, None]), axis=1)
            symbols[every, first] = self.by_place[least]
            if size > 1:
                kept = kept[:, :-1]
                agenda = np.take_along_axis(agenda, kept + (kept >= first[:, None]), axis=1)
                for at in (first - 1, first):
                    inside = np.flatnonzero((at >= 0) & (at < size - 1))
                    at = at[inside]
                    agenda[inside, at] = self._places(symbols[inside, at], symbols[inside, at + 1])
        yield rows, symbols

    def _places(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of the pieces that the pairs make, ``none`` where they make none."""
        keys = left * (self.no_piece + 1) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_places[at], self.none)

    def _with_bytes(self, symbols: list[int], chunk: str) -> list[int]:
        """Symbols with the bytes of each character that is no piece."""
        out, at = [], 0
        for symbol in symbols:
            if symbol == self.no_piece:
                out.extend(self.bytes_of[b] for b in chunk[at].encode())
                at += 1
            else:
                out.append(symbol)
                at += len(self.pieces[symbol])
        return out

    def _ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for symbol in symbols:
            found = self.ids.get(symbol)
            if found is not None:
                out.append(found)
            else:
                out.extend(self.bytes_of[b] for b in symbol.encode())
        return out

    def _merge_long(self, symbols: list[str | None]) -> list[str]:
        """The agenda as a heap over linked symbols."""
        n, cost = len(symbols), self.cost
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = ((i, symbols[i] + symbols[i + 1]) for i in range(n - 1))
        agenda = [(cost[pair], i, pair) for i, pair in pairs if pair in cost]
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            left, j = symbols[i], after[i]
            if left is None or j >= n or left + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (longer := pair + symbols[k]) in cost:
                    heapq.heappush(agenda, (cost[longer], i, longer))
            h = before[i]
            if h >= 0 and (longer := symbols[h] + pair) in cost:
                heapq.heappush(agenda, (cost[longer], h, longer))
        return [s for s in symbols if s is not None]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts, one after the other."""
        every, counts = joined(map(self.chunks, texts))
        ids, lengths = self.known.gather(0, self.known.places(every))
        return np.concatenate([[0], np.cumsum(per_text(lengths, counts))]), ids

    def _solve(self, chunks: list[str]) -> list[Ids]:
        """Ids of new chunks by the agenda, compared with the library's."""
        solved = self.merge_all(chunks)
        if self.check:
            self._compare(chunks, *solved[0])
        return solved

    def _compare(self, chunks: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Chunks that start with a space are encoded by the library ``ASKED`` at a time, as one text whose spaces they bring along;
        the others, and those of a text that differs, one by one."""
        whole = np.fromiter((c[0] == SPACE and c[-1] != SPACE for c in chunks), bool, len(chunks)) if self.cut else np.zeros(len(chunks), bool)
        ends = np.cumsum(lengths)
        alone, together = np.flatnonzero(~whole), np.flatnonzero(whole)
        groups = [together[i : i + ASKED] for i in range(0, len(together), ASKED)]
        texts = ["".join([chunks[i] for i in own.tolist()])[1:].replace(SPACE, " ") for own in groups]
        theirs, counts = flat_ids(self.library.encode(texts, num_threads=1) if texts else [])
        mine = ids[np.repeat(whole, lengths)]
        if not np.array_equal(theirs, mine):
            starts = np.cumsum(counts) - counts
            sizes = [int(lengths[own].sum()) for own in groups]
            at = np.cumsum(sizes) - sizes
            wrong = [i for i in range(len(groups)) if not np.array_equal(theirs[starts[i] : starts[i] + counts[i]], mine[at[i] : at[i] + sizes[i]])]
            alone = np.concatenate([alone, *[groups[i] for i in wrong]])
        self._compare_each([chunks[i] for i in alone.tolist()], [ids[ends[i] - lengths[i] : ends[i]].tolist() for i in alone.tolist()])

    def _compare_each(self, chunks: list[str], solved: list[list[int]]) -> None:
        """The library puts a space before every text, so a chunk that starts with one is a text by itself;
        any other chunk is encoded behind a line end and loses the ids of ``' \n'``."""
        lead = len(self.library.encode("\n"))
        own = [c[0] == SPACE and len(c) > 1 for c in chunks]
        texts = [c[1:].replace(SPACE, " ") if text else "\n" + c for c, text in zip(chunks, own)]
        for chunk, text, mine, found in zip(chunks, own, solved, self.library.encode(texts, num_threads=1) if texts else []):
            found = found if text else found[lead:]
            if mine != found:
                raise ValueError(f"agenda and library differ on {chunk[:80]!r}: {mine[:40]} / {found[:40]}")

    def decode_batch(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        flat, ends = ids.tolist(), offsets.tolist()
        lists = [flat[a:b] for a, b in zip(ends, ends[1:])]
        return [t if i else "" for i, t in zip(lists, self.library.decode(lists, num_threads=1))] if lists else []


def worker_codec(model: bytes, check: bool) -> Codec:
    """The codec of this Python worker; tasks that follow find its solved chunks."""
    return held("sentencepiece", hashlib.md5(model).hexdigest(), check, make=lambda: Codec(model, check))


def encode_decode(docs: DataFrame, model_path: str, column: str = "text", check: bool = True) -> DataFrame:
    """Adds ``ids`` (array of int) and ``decoded`` (string) to every row.

    The model file is read once on the driver and travels with the tasks.
    """
    with open(model_path, "rb") as file:
        model = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    fields = [docs.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(model.value, check)
        for whole in batches:
            for batch in slices(whole, column, 1 << 20):
                offsets, ids = codec.encode_batch([t or "" for t in batch.column(column).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                arrays = [batch.column(c) for c in kept] + [lists, pa.array(codec.decode_batch(offsets, ids), pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, "ids", "decoded"])
            give_back()

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(tasks, schema)
