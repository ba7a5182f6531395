"""Conversation repair: beside a plain dynamic program over strings and an enumeration of all edits."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklight.llm import conversation_repair as cr
from tracklight.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, place string, plan string, digest string, kind string, part string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = lambda v: " " if v is None else str(v)
        role, text = shown(role), shown(text)
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out.extend([(conv, turn, role, text)] * (2 if kind == 3 else 1))
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit, lines) by a plain dynamic program over the states of the pattern."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    names = {"u": "user", "a": "assistant"}

    def inserted(states):
        for _ in range(3):
            for state, (cost, audit, lines) in list(states.items()):
                for initial in "ua":
                    to = step.get((state, initial))
                    if to:
                        new = (cost + 3, audit + "I", (*lines, f"{names[initial]}:"))
                        states[to] = min(states.get(to, new), new, key=lambda v: v[:2])
        return states

    states = inserted({"": (0, "", ())})
    for (_, _, role, text), fault in zip(rows, found):
        after = {}

        def put(to, new, after=after):
            after[to] = min(after.get(to, new), new, key=lambda v: v[:2])

        for state, (cost, audit, lines) in states.items():
            put(state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            to = step.get((state, role[:1]))
            if to:
                put(to, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for initial in "ua":
                to = step.get((state, initial))
                if to:
                    put(to, (cost + more + 3, audit + "R", (*lines, f"{names[initial]}:{text}")))
        states = inserted(after)
    return min((states[s] for s in ("", "a") if s in states), key=lambda v: v[:2])


def brute(rows, damage=True):
    every = sorted({r[0] for r in rows}, key=lambda c: (c is not None, c or 0))
    left = damaged(rows) if damage else rows
    out = []
    for conv in every:
        own = [r for r in left if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).hexdigest()))
        found = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = cheapest(own, found)
        counts = [sum(f == k for f in found) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def found_rows(df):
    rows = [tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, "", "ünd"])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn // 2]), role, rng.choice(["Yes.", "no", " \t", None, "ok!  ", "a?b", f"t{turn}."])))
    return rows


def wide(spark, rows):
    return spark.createDataFrame([(*r, "p", "x", "d", "k", "q") for r in rows], SCHEMA)


def test_plain_program_beside_all_edits():
    """The dynamic program of the tests finds what an enumeration of all edit strings finds."""
    rng = random.Random(1)
    for _ in range(60):
        rows = [(0, i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["A.", "b", ""])) for i in range(rng.randint(0, 4))]
        found, best = faults(rows), None
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            for edits in itertools.product("KRD", repeat=len(rows)):
                cost, audit, roles = 0, "", []
                for i, edit in enumerate([*edits, ""]):
                    cost, audit = cost + 3 * inserts[i], audit + "I" * inserts[i]
                    roles += ["?"] * inserts[i]
                    if not edit:
                        break
                    audit += edit
                    if edit != "D":
                        cost += (3 if edit == "R" else 0) + (3 if found[i] == "truncated" else 0) + (999 if found[i] in ("blank", "duplicate") else 0)
                        roles.append("?" if edit == "R" else rows[i][2][0])
                    else:
                        cost += 4
                legal = [p for n in range(len(roles) + 1) for p in ("s" * lead + "ua" * n for lead in (0, 1) if n or not lead) if len(p) == len(roles)]
                if any(all(a in ("?", b) and (a != "?" or b != "s") for a, b in zip(roles, p)) for p in legal):
                    best = min(best or (cost, audit), (cost, audit))
        assert cheapest(rows, found)[:2] == best


def test_ropes_compare_as_strings():
    rng = random.Random(2)
    for _ in range(300):
        texts = []
        for _ in range(2):
            rope, text = cr.Rope(""), ""
            for _ in range(rng.randint(0, 8)):
                part = "".join(rng.choice("DK") for _ in range(rng.choice([1, 40, 90]))) if rng.random() < 0.3 else "K" * rng.choice([30, 70, 100])
                rope, text = (rope + cr.Rope(part), text + part) if rng.random() < 0.5 else (cr.Rope(part) + rope, part + text)
            assert str(rope) == text
            texts.append((rope, text))
        (a, x), (b, y) = texts
        assert (a < b) == (x < y) and (b < a) == (y < x)


def test_replaced_pairs_expand_to_the_same_symbols():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 4, 500).astype(np.int32)
    symbols[rng.integers(0, 500, 40)] = -1
    symbols[100:140], symbols[-1] = 2, -1
    wanted = np.sort(np.array([0 << 32 | 1, 2 << 32 | 2, 1 << 32 | 2, 3 << 32 | 0], dtype=np.int64))
    ranks = np.array([2, 0, 3, 1])
    short = cr.replace_pairs(symbols, wanted, ranks, 10)
    rules = {10 + r: (w >> 32, w & 0xFFFFFFFF) for w, r in zip(wanted.tolist(), ranks.tolist())}
    assert len(short) < len(symbols) and np.concatenate([rules.get(s, (s,)) for s in short.tolist()]).tolist() == symbols.tolist()
    assert len(short[100:]) and (cr.replace_pairs(np.array([2] * 9 + [-1], dtype=np.int32), wanted, ranks, 10) >= 10).sum() == 4


@pytest.mark.parametrize("segment, rules", [(4096, 1024), (3, 5)])
def test_report_beside_brute_force(spark, monkeypatch, segment, rules):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    monkeypatch.setattr(cr, "RULES", rules)
    rows = random_rows(4, 60, 12) + [(None, 1, "user", "Null conversation."), (None, 2, "assistant", "Yes.")]
    rows += [(900, t, "user" if t % 2 else "assistant", f"Long {t % 7}.") for t in range(400)] + [(901, 1, "user", "same.")] * 30
    rows += [(902, None, None, None), (903, -(2**62), "user", "x."), (903, 5, "assistant", "y.")]
    assert found_rows(cr.report(wide(spark, rows).repartition(5))) == brute(rows)


def test_lines_are_legal(spark):
    rows = [(c, t, r, x) for c, t, r, x in random_rows(5, 30, 9) if r is not None and x is not None]
    summary, lines = cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    told = {r.conv_id: r.audit for r in summary.collect()}
    order = lines.orderBy("conv_id", "place").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text", "edit"))).alias("all"))
    for row in order.collect():
        assert re.fullmatch("(s?(ua)+)?", "".join(p.role[0] for p in row["all"]))
        assert "".join(p.edit for p in row["all"]) == told[row.conv_id].replace("D", "")


def test_no_conversations(spark):
    assert cr.report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_over_the_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found_rows(queries.op12_conversation_repair(spark, folder)) == brute(rows)
