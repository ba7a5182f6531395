"""Repair of conversation structure: the cheapest edits that make the roles of every conversation legal.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``. Rows are kept (cost 0), given the role user or
assistant (3), deleted (4; blank and duplicate rows must be) or an empty user or assistant row is inserted (3); a truncated
row that stays costs 3 more. Of equally cheap edits the ASCII-least string of their initials K, R, D, I wins.

1. Each row has one symbol of nine: must go, or the initial of its role and whether it is truncated. A range shuffle
   by (conversation, turn, role, digest of the text) of rows without text puts them in order; the symbols of a conversation
   in a task are cut into segments of at most ``SEGMENT``, so a hot conversation lies in many tasks.
2. Re-Pair: in every round the pairs of neighbouring symbols are counted over all segments, the ``RULES`` most frequent that
   occur twice or more become rules, and tasks replace them. Equal runs of roles and faults become the same rule in
   all conversations.
3. A rule has one 4 x 4 transfer matrix over the states start, system, user, assistant: least cost and, as a rope, the least
   audit. The matrix of a rule is the min-plus product of its parts' matrices, made once per worker, bottom up, and shared by
   all conversations. Two audits of equal cost and equal borders never are each other's prefix, so that the least of a
   product is the product of the least.
4. The rest of a conversation's symbols is folded as a row vector; its audit is dealt out to its rows again.

One row of a conversation is at most one symbol of four bytes in the fold, which ends in the one audit string that
the conversation has; texts are never gathered: rows and their edits meet by a shuffle on the conversation and stream through
in order, spilling as any sort.

Rows are ordered by turn (nulls first), then role, then MD5 of the text; equal rows are neighbours. Null roles and texts count as
one space: such a role can only be changed, such a text is blank. An empty role has no initial and can only be changed
too. A null conv_id is a conversation. Rows without a conversation after damage have zeros, an empty audit and no lines;
an empty table gives no rows; other columns are not read. ``gaps`` beyond the range of long are given as its largest value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklight.llm.common import fits, held, hinted, slices
from tracklight.runtime import stage

SEGMENT, RULES, ROUNDS = 4096, 1024, 10
SPACES = "\\t\\n\\u000b\\u000c\\r "
ROLES = "sua"
TERMINALS = 1 + 2 * (len(ROLES) + 1)
LEGAL = {"su", "ua", "au"}

# Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a row of the given initial; other rows may not follow.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}


class Rope:
    """A string as a tree of joined parts with its length and hash; short ones are flat."""

    __slots__ = ("left", "right", "text", "length", "hash")
    FLAT, BASE, PRIME = 64, 911382323, (1 << 127) - 1

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.left, self.right, self.text = left, right, text
        if text is None:
            self.length = left.length + right.length
            self.hash = (left.hash * pow(self.BASE, right.length, self.PRIME) + right.hash) % self.PRIME
        else:
            self.length, self.hash = len(text), 0
            for letter in text:
                self.hash = (self.hash * self.BASE + ord(letter)) % self.PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.length:
            return other
        if not other.length:
            return self
        if self.length + other.length <= self.FLAT:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __lt__(self, other: Rope) -> bool:
        a, b = [self], [other]
        while a and b:
            p, q = a.pop(), b.pop()
            if p.length == q.length and p.hash == q.hash:
                continue
            if p.text is not None and q.text is not None:
                both = min(p.length, q.length)
                if p.text[:both] != q.text[:both]:
                    return p.text < q.text
                if p.length > both:
                    a.append(Rope(p.text[both:]))
                if q.length > both:
                    b.append(Rope(q.text[both:]))
            elif q.text is None and (p.text is not None or q.length > p.length):
                b.extend((q.right, q.left))
                a.append(p)
            else:
                a.extend((p.right, p.left))
                b.append(q)
        return bool(b)

    def __str__(self) -> str:
        out, work = [], [self]
        while work:
            node = work.pop()
            if node.text is None:
                work.extend((node.right, node.left))
            else:
                out.append(node.text)
        return "".join(out)


Cell = tuple[int, Rope] | None


def least(a: Cell, b: Cell) -> Cell:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if b[1] < a[1] else a


def times(row: list[Cell], matrix: list[list[Cell]]) -> list[Cell]:
    """Min-plus product of a row vector and a matrix."""
    out: list[Cell] = [None] * 4
    for middle, first in enumerate(row):
        if first is not None:
            for to, second in enumerate(matrix[middle]):
                if second is not None:
                    cost, now = first[0] + second[0], out[to]
                    if now is None or cost <= now[0]:
                        out[to] = least(now, (cost, first[1] + second[1]))
    return out


def _insertions() -> list[list[Cell]]:
    """The cheapest insertions that lead from one state to another."""
    matrix: list[list[Cell]] = [[None] * 4 for _ in range(4)]
    for state in range(4):
        at, audit = state, ""
        while matrix[state][at] is None:
            matrix[state][at] = INSERT * len(audit), Rope(audit)
            at, audit = STEP.get((at, "u"), ASSISTANT), audit + "I"
    return matrix


INSERTIONS = _insertions()


def terminal(symbol: int) -> list[list[Cell]]:
    """Matrix of one row, with the insertions before it."""
    edit: list[list[Cell]] = [[None] * 4 for _ in range(4)]
    role, more = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
    for state in range(4):
        edit[state][state] = DELETE, Rope("D")
        for initial in ROLES if symbol else "":
            to = STEP.get((state, initial))
            if to is not None:
                if role < len(ROLES) and ROLES[role] == initial:
                    edit[state][to] = least(edit[state][to], (more, Rope("K")))
                elif initial != "s":
                    edit[state][to] = least(edit[state][to], (RENAME + more, Rope("R")))
    return [times(row, edit) for row in INSERTIONS]


class Grammar:
    """Rules and their matrices; a matrix is made when it is first asked for, after those of its parts."""

    def __init__(self, rules: list[tuple[int, int]]):
        self.rules = rules
        self.matrices = {symbol: terminal(symbol) for symbol in range(TERMINALS)}

    def matrix(self, symbol: int) -> list[list[Cell]]:
        work = [symbol]
        while work:
            now = work[-1]
            if now in self.matrices:
                work.pop()
                continue
            parts = self.rules[now - TERMINALS]
            missing = [p for p in parts if p not in self.matrices]
            if missing:
                work.extend(missing)
            else:
                left, right = (self.matrices[p] for p in parts)
                self.matrices[now] = [times(row, right) for row in left]
        return self.matrices[symbol]

    def cheapest(self, symbols) -> tuple[int, str]:
        """Least cost and its audit of a whole conversation."""
        row: list[Cell] = [(0, Rope("")), None, None, None]
        for symbol in symbols:
            row = times(row, self.matrix(symbol))
        row = times(row, INSERTIONS)
        cost, audit = least(row[START], row[ASSISTANT])
        return cost, str(audit)


def worker_grammar(rules: list[tuple[int, int]]) -> Grammar:
    """The grammar of this Python worker; the tasks that follow find its matrices."""
    return held("grammar", hashlib.md5(repr(rules).encode()).hexdigest(), make=lambda: Grammar(rules))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults, chosen by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _digest() -> Column:
    return F.md5(F.col("text").cast("binary")).alias("digest")


def _distinct_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, chunk, n, blank, duplicate, truncated): equal rows as one, with their number, in chunks
    of at most ``SEGMENT``; ``duplicate`` tells whether even the first of them was seen in an earlier turn."""
    trimmed = F.expr(f"trim(TRAILING '{SPACES}' FROM text)")
    narrow = rows.select("conv_id", "turn", "role", _digest(), (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    narrow = narrow.groupBy("conv_id", "turn", "role", "digest").agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    narrow = stage(narrow, "repair-distinct")
    seen = narrow.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
    seen = stage(seen.where("turns > 1").select(*[F.col(c).alias(f"seen_{c}") for c in ("conv_id", "role", "digest")], F.col("first.turn").alias("seen_turn"), F.lit(True).alias("seen")), "repair-seen")
    same = F.col("conv_id").eqNullSafe(F.col("seen_conv_id")) & (F.col("role") == F.col("seen_role")) & (F.col("digest") == F.col("seen_digest"))
    narrow = narrow.join(hinted(seen, fits(seen, 128)), same, "left")
    again = F.coalesce(F.col("seen") & ~F.col("turn").eqNullSafe(F.col("seen_turn")), F.lit(False))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SEGMENT)))
    return narrow.select(
        "conv_id", "turn", "role", "digest", chunk.alias("chunk"), "n", "blank", again.alias("again"), "truncated"
    ).withColumn("duplicate", F.col("again") | (F.col("chunk") > 0)).withColumn("n", F.least(F.col("n") - F.col("chunk") * SEGMENT, F.lit(SEGMENT)).cast("int"))


ORDER = ["conv_id", "turn", "role", "digest", "chunk"]
SEGMENTS = "conv_id long, turn long, role string, digest string, part int, segment int, place int, symbols binary, terminals binary, sizes binary, ends string, blank long, duplicate long, truncated long, illegal long"


def _segments(rows: DataFrame) -> DataFrame:
    """Rows of two kinds: the distinct rows with their place (part, segment, place), and one row per segment with its symbols
    (``symbols`` not null), what it counts and its first and last initial."""
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in SEGMENTS.split(", ")])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        conv, segment, symbols, sizes = object(), 0, [], []
        counts, first, last = [0] * 4, "", ""

        def close() -> None:
            if symbols:
                one = np.array(symbols, dtype=np.int32)
                out.append(
                    {"conv_id": conv, "part": part, "segment": segment, "symbols": one.tobytes(), "terminals": one.astype(np.uint8).tobytes(),
                     "sizes": np.array(sizes, dtype=np.int32).tobytes(), "ends": (first or " ") + (last or " "),
                     **dict(zip(("blank", "duplicate", "truncated", "illegal"), counts))}
                )

        for batch in batches:
            for own, turn, role, digest, n, blank, duplicate, truncated in zip(*(c.to_pylist() for c in batch.columns)):
                if own != conv or len(symbols) + n > SEGMENT:
                    close()
                    conv, segment, symbols, sizes, counts, first = own, segment + 1, [], [], [0] * 4, None
                out.append({"conv_id": own, "turn": turn, "role": role, "digest": digest, "part": part, "segment": segment, "place": len(sizes)})
                initial = role[:1]
                if first is None:
                    first = initial
                else:
                    counts[3] += last + initial not in LEGAL
                last = initial
                counts[3] += n - 1
                if blank:
                    counts[0] += n
                else:
                    counts[1] += n - (not duplicate)
                    counts[2] += truncated and not duplicate
                symbols.append(0 if blank or duplicate else 1 + 2 * (ROLES.find(initial) if initial and initial in ROLES else len(ROLES)) + truncated)
                symbols.extend([0] * (n - 1))
                sizes.append(n)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return ordered.select("conv_id", "turn", "role", "digest", "n", "blank", "duplicate", "truncated").mapInArrow(tasks, SEGMENTS)


def _joined(column: pa.Array) -> np.ndarray:
    """The symbols of all segments one after the other, with -1 after each."""
    parts = []
    for value in column.to_pylist():
        parts.extend((np.frombuffer(value, dtype=np.int32), np.array([-1], dtype=np.int32)))
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def _pairs(symbols: np.ndarray) -> np.ndarray:
    """For each symbol, it and the next as one number; -1 where a segment ends."""
    pairs = np.full(len(symbols), -1, dtype=np.int64)
    if len(symbols) > 1:
        left, right = symbols[:-1].astype(np.int64), symbols[1:].astype(np.int64)
        pairs[:-1] = np.where((left >= 0) & (right >= 0), left << 32 | right, -1)
    return pairs


def replace_pairs(symbols: np.ndarray, wanted: np.ndarray, ranks: np.ndarray, first_rule: int) -> np.ndarray:
    """Replaces pairs that are rules (``wanted`` sorted, with ranks); where they overlap the smaller rank wins, in a run of
    equal symbols every other pair."""
    none = np.iinfo(np.int64).max
    pairs = _pairs(symbols)
    at = np.minimum(np.searchsorted(wanted, pairs), len(wanted) - 1)
    rank = np.where(wanted[at] == pairs, ranks[at], none)
    taken = np.zeros(len(symbols), dtype=bool)
    for _ in range(16):  # what still overlaps after so many turns is left to the next round
        begins = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
        run = np.cumsum(np.concatenate([[True], rank[1:] != rank[:-1]])) - 1
        value = rank[begins]
        around = np.concatenate([[none], value, [none]])
        low = (value < around[:-2]) & (value < around[2:])
        chosen = low[run] & ((np.arange(len(rank)) - begins[run]) % 2 == 0)
        if not chosen.any():
            break
        taken |= chosen
        rank[chosen] = none
        spots = np.flatnonzero(chosen)
        rank[spots + 1] = none
        rank[np.maximum(spots - 1, 0)] = none
    out = symbols.copy()
    spots = np.flatnonzero(taken)
    out[spots] = first_rule + ranks[at[spots]]
    return np.delete(out, spots + 1)


def compress(segments: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Segments with shorter ``symbols`` and the rules of the grammar, (left, right) of rule ``TERMINALS + i``."""
    rules: list[tuple[int, int]] = []

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = _pairs(_joined(batch.column(0)))
            found, n = np.unique(pairs[pairs >= 0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    for _ in range(ROUNDS):
        counts = segments.select("symbols").mapInArrow(counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = [r.pair for r in counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(RULES).collect()]
        if not top:
            break
        order = np.argsort(np.array(top, dtype=np.int64))
        wanted, ranks, first_rule = np.array(top, dtype=np.int64)[order], order.astype(np.int64), TERMINALS + len(rules)
        names = segments.columns

        def replaced(batches: Iterator[pa.RecordBatch], wanted=wanted, ranks=ranks, first_rule=first_rule, names=names) -> Iterator[pa.RecordBatch]:
            place = names.index("symbols")
            for batch in batches:
                if not batch.num_rows:
                    continue
                short = replace_pairs(_joined(batch.column(place)), wanted, ranks, first_rule)
                ends = np.flatnonzero(short < 0)
                lists = [short[a:b].tobytes() for a, b in zip(np.concatenate([[0], ends[:-1] + 1]), ends)]
                arrays = [pa.array(lists, pa.binary()) if i == place else c for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(arrays, names)

        segments = stage(segments.mapInArrow(replaced, segments.schema), "repair-pairs")
        rules.extend((pair >> 32, pair & 0xFFFFFFFF) for pair in top)
    return segments, rules


FOUND = "conv_id long, cost long, audit string, blank long, duplicate long, truncated long, illegal long, part int, segment int, plans array<string>"


def _solved(segments: DataFrame, rules: list[tuple[int, int]]) -> DataFrame:
    """One row per conversation (``audit`` not null) and one per segment with the plan of each of its distinct rows: u and a
    insert a row, K keeps it, U and A keep it with another role; deleted rows have no letter."""
    schema = pa.schema(
        [(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string())}[c.split()[1]]) for c in FOUND.split(", ")]
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = worker_grammar(rules)
        conv, held, out = object(), [], []

        def close() -> None:
            if held:
                symbols = np.concatenate([np.frombuffer(s["symbols"], dtype=np.int32) for s in held])
                cost, audit = grammar.cheapest(symbols.tolist())
                borders = sum(a["ends"][1] + b["ends"][0] not in LEGAL for a, b in zip(held, held[1:]))
                sums = {c: sum(s[c] for s in held) for c in ("blank", "duplicate", "truncated", "illegal")}
                out.append({"conv_id": conv, "cost": cost, "audit": audit, **sums, "illegal": sums["illegal"] + borders})
                state, at = START, 0
                for number, one in enumerate(held):
                    plans, letter = [], 0
                    for n in np.frombuffer(one["sizes"], dtype=np.int32).tolist():
                        plan = []
                        for _ in range(n):
                            role = (one["terminals"][letter] - 1) // 2
                            letter += 1
                            while audit[at] == "I":
                                plan.append("a" if state == USER else "u")
                                state, at = ASSISTANT if state == USER else USER, at + 1
                            if audit[at] == "K":
                                plan.append("K")
                                state = STEP[state, ROLES[role]]
                            elif audit[at] == "R":
                                plan.append("A" if state == USER else "U")
                                state = ASSISTANT if state == USER else USER
                            at += 1
                        plans.append("".join(plan))
                    if number == len(held) - 1:
                        while at < len(audit):
                            plans[-1] += "a" if state == USER else "u"
                            state, at = ASSISTANT if state == USER else USER, at + 1
                    out.append({"part": one["part"], "segment": one["segment"], "plans": plans})

        for batch in batches:
            for one in batch.to_pylist():
                if one["conv_id"] != conv:
                    close()
                    conv, held = one["conv_id"], []
                    if len(out) > 2000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out.clear()
                held.append(one)
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    columns = ["conv_id", "part", "segment", "symbols", "terminals", "sizes", "ends", "blank", "duplicate", "truncated", "illegal"]
    return segments.select(*columns).repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment").mapInArrow(tasks, FOUND)


LINES = "conv_id long, place long, edit string, role string, text string"
NAMES = {"u": "user", "a": "assistant"}


def _lines(rows: DataFrame, placed: DataFrame, solved: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text) of the repaired conversations; the rows of one lie together, in order."""
    plans = solved.where("audit is null").select("part", "segment", F.posexplode("plans").alias("place", "plan")).where("plan <> ''")
    plans = placed.where("symbols is null").select("conv_id", "turn", "role", "digest", "part", "segment", "place").join(plans, ["part", "segment", "place"])
    plans = plans.select("conv_id", "turn", "role", "digest", F.lit(0).alias("kind"), "part", "segment", "place", F.col("plan").alias("text"))
    texts = rows.select("conv_id", "turn", "role", _digest(), F.lit(1).alias("kind"), *[F.lit(0).alias(c) for c in ("part", "segment", "place")], "text")
    order = ["conv_id", "turn", "role", "digest", "kind", "part", "segment", "place"]
    both = plans.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "turn", "role", "digest", "kind", "text")
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, key, plan, place, out = object(), None, "", 0, []
        for whole in batches:
            for batch in slices(whole, "text"):
                for own, turn, role, digest, kind, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if own != conv:
                        conv, key, place = own, None, 0
                    if (turn, role, digest) != key:
                        key, plan = (turn, role, digest), ""
                    if kind == 0:
                        plan += text
                        continue
                    for letter in plan:
                        if letter in NAMES:
                            out.append((own, place, "I", NAMES[letter], ""))
                        else:
                            out.append((own, place, "K" if letter == "K" else "R", role if letter == "K" else NAMES[letter.lower()], text))
                        place += 1
                    plan = ""
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, schema.types)], schema=schema)
                out.clear()

    return both.mapInArrow(tasks, LINES)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) and the lines of the repaired ones
    (conv_id, place, edit, role, text) of rows (conv_id, turn, role, text) without null roles and texts.

    Lines of one conversation lie together in a partition, in order.
    """
    distinct = _distinct_rows(rows)
    placed = stage(_segments(distinct), "repair-rows")
    segments, rules = compress(placed.where("symbols is not null").drop("turn", "role", "digest", "place"))
    solved = stage(_solved(segments, rules), "repair-solved")
    turns = placed.where("symbols is null").groupBy("conv_id").agg(F.max("turn").alias("most"), F.min("turn").alias("fewest"), F.count_distinct("turn").alias("turns"))
    gaps = F.when(F.col("most").isNull(), 0).otherwise(F.coalesce(F.expr("try_subtract(try_subtract(most, fewest), turns - 1)"), F.lit((1 << 63) - 1)))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    known = solved.where("audit is not null").select("conv_id", F.lit(None).cast("long").alias("gaps"), *counts, "audit")
    empty = [F.lit(None).cast("long").alias(c) for c in counts]
    known = known.unionByName(turns.select("conv_id", gaps.cast("long").alias("gaps"), *empty, F.lit(None).cast("string").alias("audit")))
    known = known.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("gaps", *counts, "audit")])
    return known, _lines(rows, placed, solved)


def lines_sha256(lines: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the lines ``role:text`` of each conversation, joined by line ends, as they come
    from ``repair``. The hash of a conversation is made line by line."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        conv, state = none, None
        for batch in batches:
            done = []
            for own, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if own != conv:
                    if conv is not none:
                        done.append((conv, state.hexdigest()))
                    conv, state = own, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else [[]] * 2, (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])
        if conv is not none:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])

    return lines.select("conv_id", "role", "text").mapInArrow(tasks, "conv_id long, repaired_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after ``damage`` and ``repair``, with the digest of its repaired lines."""
    known, lines = repair(damage(conversations))
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    all_ids = conversations.select(F.col("conv_id").cast("long"), *[F.lit(0).cast("long").alias(c) for c in counts], F.lit("").alias("audit"), F.lit(None).cast("string").alias("repaired_sha256"))
    hashes = lines_sha256(lines).select("conv_id", *[F.lit(None).cast("long").alias(c) for c in counts], F.lit(None).cast("string").alias("audit"), "repaired_sha256")
    rows = all_ids.unionByName(known.withColumn("repaired_sha256", F.lit(None).cast("string"))).unionByName(hashes)
    out = rows.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (*counts, "audit", "repaired_sha256")])
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
