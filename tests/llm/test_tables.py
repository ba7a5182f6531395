"""Mixing, tool calls, licence scan and exact dedup: beside SQL and on edge rows."""

import hashlib
from collections import defaultdict

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracklight.llm import checks, exact_dedup, licenses, mixing, tool_calls
from tracklight.llm.license_texts import TEMPLATES


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def beside_sql(frame, sql, **tables):
    connection = duckdb.connect()
    for name, rows in tables.items():
        connection.register(name, rows)
    theirs = connection.execute(sql).df()
    columns = sorted(theirs.columns)
    assert sorted(frame.columns) == columns
    order = lambda df: sorted(tuple(str(v) for v in r) for r in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False))
    assert order(frame) == order(theirs)


MIX_COLUMNS = ["doc_id", "source", "mix_pass", "mix_block", "mix_key", "mix_tokens"]


@pytest.mark.parametrize("target, limit, share", [(0.5, 4.0, None), (0.999, 3.0, None), (0.999, 100.0, 2.5), (0.9, 1.2, 1.0), (1.0, 50.0, 0.3)])
def test_mixing_of_edge_rows_beside_sql(edge_docs, target, limit, share):
    mixed = mixing.mix(edge_docs, target, limit, share)
    assert set(edge_docs.columns) <= set(mixed.columns)
    ours = mixed.select(*MIX_COLUMNS).toPandas().astype({"doc_id": "Int64"})
    documents = edge_docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})
    beside_sql(ours, checks.mixing(target, limit, share, documents="docs", tail=", ".join(MIX_COLUMNS)), docs=documents)


def test_mixing_meets_its_targets(spark):
    sizes = {"a": 400, "b": 60, "c": 10, "d": 3}
    rows = [(k * 1000 + i, "w " * (1 + i % 7), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    counted = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("mix_tokens"))
    plan = mixing.source_plan(counted, 0.8, 1000.0, 3.0).toPandas()
    import math

    entropy = -sum(w * math.log(w) for w in plan["weight"])
    assert entropy == pytest.approx(0.8 * math.log(4), abs=1e-4)
    limited = mixing.source_plan(counted, 0.999, 5.0, None).toPandas()
    assert (limited["quota"] / limited["tokens"]).max() == pytest.approx(5.0, rel=1e-3)
    assert (limited["quota"] >= limited["tokens"]).all()
    mixed = mixing.mix(docs, 0.8, 1000.0, 3.0).groupBy("source").agg(F.sum("mix_tokens").alias("got")).toPandas().set_index("source")["got"]
    for row in plan.itertuples():
        assert 0 <= row.quota - mixed.get(row.mix_source, 0) < 7  # less than one document short
    whole = mixing.mix(docs, 0.999, 5.0).groupBy("doc_id").count().toPandas()["count"]
    assert whole.min() >= 1 and whole.max() <= 5 and len(whole) == len(rows)


def test_mixing_passes_are_permutations(spark):
    rows = [(i, "w w", "big") for i in range(90)] + [(1000 + i, "w w", "small") for i in range(10)]
    mixed = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), 1.0, 4.0).where("source = 'small'").toPandas()
    orders = [list(part.sort_values(["mix_block", "mix_key"])["doc_id"]) for _, part in mixed.groupby("mix_pass")]
    full = [o for o in orders if len(o) == 10]
    assert len(full) >= 3 and all(sorted(o) == sorted(full[0]) for o in full) and len({tuple(o) for o in full}) > 1


def test_mixing_of_nothing(no_docs, spark):
    assert mixing.mix(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None, "s"), (2, "", None)], "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in mixing.mix(blank).collect()) == [1, 2]


RULES = [("add", "a", "number", True, 0.0, 10.0), ("add", "b", "number", False, None, None), ("say", "text", "string", True, 1.0, 5.0)]
MESSAGES = [
    (1, 0, "system", 'hi "you"\n'),
    (1, 1, "assistant", '{"tool_calls":[{"id":"x","name":"add","arguments":{"b":2.50,"a":1}},{"id":"y","name":"say","arguments":{"text":"$x"}}]}'),
    (1, 2, "tool", '{"tool_call_id":"x","content":"3é"}'),
    (1, 3, "tool", '{"tool_call_id":"zz","content":"3"}'),
    (1, 4, "tool", '{"tool_call_id":"x","content":"4"}'),
    (
        2, 1, "assistant",
        '{"tool_calls":[{"id":"a","name":"say","arguments":{"text":"$b"}},{"id":"b","name":"say","arguments":{"text":"$c"}},'
        '{"id":"c","name":"say","arguments":{"text":"toolong","q":1}},{"id":"c","name":"say","arguments":{"text":"x"}},{"id":"d","name":"say","arguments":{"text":"$d"}},'
        '{"id":null,"name":"nope","arguments":[1]},{"id":"e","name":"add","arguments":{"a":"1"}},{"id":"f","name":"add","arguments":{"a":1,"a":2}},'
        '{"id":"g","name":"say","arguments":{"text":"$none"}}]}',
    ),
    (3, 0, None, None),
    (3, 1, "assistant", '{"tool_calls":[]}'),
    (3, 2, "assistant", "{oops"),
    (None, None, "tool", "{}"),
    (4, 1, "tool", '{"tool_call_id":"r","content":"early"}'),
    (4, 2, "assistant", '{"tool_calls":[{"id":"r","name":"say","arguments":{"text":"ok"}}]}'),
]


def linked(spark, rows):
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("call_id", F.lit("clash")).withColumn("errors", F.lit("clash"))
    return tool_calls.link(messages, spark.createDataFrame(RULES, tool_calls.RULES))


def test_tool_calls_of_hand_made_messages(spark):
    rows = {(r["conv_id"], r["turn"], r["place"]): r for r in linked(spark, MESSAGES).collect()}
    x, y = rows[1, 1, 0], rows[1, 1, 1]
    assert (x["status"], x["result_turn"], x["results"], x["errors"]) == ("linked", 2, 2, [])
    assert x["json"] == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"3é"}'
    assert (y["status"], y["depends_on"], y["level"]) == ("unanswered", ["x"], 1)
    assert rows[1, 3, 0]["status"] == "orphan" and rows[1, 0, 0]["json"] == '{"content":"hi \\"you\\"\\n","role":"system"}'
    assert [rows[2, 1, k]["level"] for k in (2, 1, 0)] == [0, 1, 2]  # c before b before a
    assert rows[2, 1, 4]["errors"] == ["cycle of references"] and rows[2, 1, 4]["level"] is None
    assert rows[2, 1, 3]["status"] == "duplicate"
    assert rows[2, 1, 2]["errors"] == ["text is out of range", "unexpected q"]
    assert rows[2, 1, 5]["errors"] == ["unknown tool nope", "missing id"]
    assert rows[2, 1, 6]["errors"] == ["a is not of type number"]
    assert rows[2, 1, 7]["errors"] == ["arguments are malformed"]
    assert rows[2, 1, 8]["errors"] == ["unknown reference $none"]
    assert rows[4, 2, 0]["errors"] == ["result precedes call"] and rows[4, 2, 0]["status"] == "linked"
    assert rows[3, 0, 0]["json"] == '{"content":"","role":""}' and rows[None, None, 0]["kind"] == "message"
    assert len(rows) == 18


def test_tool_calls_repeat_and_vanish(spark):
    doubled = linked(spark, MESSAGES[:3] * 2).collect()
    assert sorted(r["kind"] for r in doubled) == ["call"] * 4 + ["message"] * 2
    assert all(r["results"] == 2 for r in doubled if r["call_id"] == "x")
    assert linked(spark, []).count() == 0


def test_topological_order_of_random_graphs(spark):
    import random

    rng, calls = random.Random(2), []
    for conv in range(6):
        names = [f"n{k}" for k in range(12)]
        order = names[:]
        rng.shuffle(order)
        listed = [
            f'{{"id":"{n}","name":"say","arguments":{{"text":"x"' + "".join(f',"k{j}":"${d}"' for j, d in enumerate(rng.sample(order[: order.index(n)], min(2, order.index(n))))) + "}}"
            for n in names
        ]
        calls.append((conv, 0, "assistant", '{"tool_calls":[' + ",".join(listed) + "]}"))
    place = {(r["conv_id"], r["call_id"]): (r["level"], r["turn"], r["place"], r["depends_on"]) for r in linked(spark, calls).collect()}
    assert len(place) == 72
    for (conv, _), (level, _, _, needs) in place.items():
        assert level == max((place[conv, d][0] + 1 for d in needs), default=0)


def say(call, *needs):
    return f'{{"id":"{call}","name":"say","arguments":{{"text":"x"' + "".join(f',"k{j}":"${d}"' for j, d in enumerate(needs)) + "}}"


def test_levels_of_chains_and_cycles(spark):
    """A chain that points backwards, one that points forward, branches, calls above cycles, references to nothing."""
    chain = [(1, 2 * k, "assistant", '{"tool_calls":[' + (say(f"c{2 * k}", f"c{2 * k - 2}") if k else say("c0")) + "]}") for k in range(70)]
    ahead = [(2, k, "assistant", '{"tool_calls":[' + (say(f"c{k}", f"c{k + 1}") if k < 9 else say("c9", "gone")) + "]}") for k in range(10)]
    graph = [("a",), ("b", "a"), ("c", "b"), ("d", "a", "c"), ("e", "d"), ("f", "e", "b"), ("g", "f"), ("p", "q"), ("q", "p"), ("r", "p"), ("s", "r", "a"), ("t", "s"), ("u", "v", "a"), ("v", "u"), ("w", "w")]
    mixed = [(3, k, "assistant", '{"tool_calls":[' + say(*row) + "]}") for k, row in enumerate(graph)]
    out = {(r["conv_id"], r["call_id"]): r for r in linked(spark, chain + ahead + mixed).collect()}
    assert [out[1, f"c{2 * k}"]["level"] for k in range(70)] == list(range(70))
    assert [out[2, f"c{k}"]["level"] for k in range(10)] == list(range(9, -1, -1))
    assert {c: out[3, c]["level"] for c in "abcdefg"} == {"a": 0, "b": 1, "c": 2, "d": 3, "e": 4, "f": 5, "g": 6}
    for c in "pqrstuvw":
        assert out[3, c]["level"] is None and "cycle of references" in out[3, c]["errors"]
    assert out[2, "c9"]["errors"][-1:] == ["unknown reference $gone"]


def test_levels_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(tool_calls, "BROADCAST_BYTES", 0)
    test_levels_of_chains_and_cycles(spark)


def bag_dice(a, b):
    from collections import Counter

    a, b = (Counter(zip(w, w[1:])) for w in (a, b))
    return 2 * sum((a & b).values()) / (sum(a.values()) + sum(b.values()))


def test_licences_beside_sql_and_brute_force(edge_docs, spark):
    extra = [(20, TEMPLATES["MIT"].replace(". ", ".\n"), "x"), (21, "intro\n\n" + TEMPLATES["ISC"].replace(", ", ",\n") + "\n\nend", "x"), (22, TEMPLATES["GPL-3.0 notice"].upper() + " Yes", "x")]
    docs = edge_docs.select("doc_id", "text", F.lit("u").alias("unit")).unionByName(spark.createDataFrame(extra, "doc_id long, text string, unit string"))
    ours = licenses.scan(docs).toPandas()
    beside_sql(ours, checks.licenses(), documents=docs.toPandas().astype({"doc_id": "Int64"}))
    found = {(r.doc_id, r.unit, r.template) for r in ours.itertuples()}
    assert {(13, "line", "MIT notice"), (20, "block", "MIT"), (21, "block", "ISC"), (22, "line", "GPL-3.0 notice")} <= found
    import re

    words = lambda t: [w for w in re.sub("[^a-z0-9]+", " ", lower_ascii(t)).split(" ") if w]
    for doc_id, text in [(r["doc_id"], r["text"]) for r in docs.collect()]:
        for number, line in enumerate((text or "").split("\n"), 1):
            for name, template in TEMPLATES.items():
                if len(words(line)) > 1 and bag_dice(words(line), words(template)) >= 0.8:
                    assert len(ours[(ours.doc_id == doc_id) & (ours.unit == "line") & (ours.unit_no == number) & (ours.template == name)]) >= 1


def laid_out(name, *breaks, prefix=""):
    """A template in its usual layout: a blank line at every break, lines of eight words."""
    text = TEMPLATES[name]
    for at in breaks:
        assert at in text
        text = text.replace(" " + at, "\x00" + at, 1)
    blocks = [block.split(" ") for block in text.split("\x00")]
    return f"\n{prefix}\n".join("\n".join(prefix + " ".join(b[k : k + 8]) for k in range(0, len(b), 8)) for b in blocks)


MIT = laid_out("MIT", "The above copyright", "THE SOFTWARE IS")
APACHE = laid_out("Apache-2.0 header", "You may obtain", "Unless required", prefix=" * ")
GPL = laid_out("GPL-3.0 header", "This program is distributed", prefix="# ")
PROSE = "\n".join(f"line {k} of a longer file that says little of the rights and the software" for k in range(40))
LAYOUTS = [
    (30, "MIT License\n\nCopyright (c) 2020 A. Author\n\n" + MIT + "\n\n" + PROSE, {"MIT"}),
    (31, "/*\n" + APACHE + "\n */\n" + PROSE, {"Apache-2.0 header", "Apache-2.0 notice"}),
    (32, MIT + "\none more line in the same block\n" + PROSE, {"MIT"}),
    (33, PROSE + "\n" + GPL + "\n" + MIT + "\n" + MIT + "\n" + PROSE, {"GPL-3.0 header", "MIT"}),
    (34, "x\nReleased under\n\nthe MIT License.\n" + PROSE, {"MIT notice"}),
    (35, PROSE.replace("\n", " ") + "\n" + MIT.replace("\n", "\r\n"), {"MIT"}),
    (36, "Released under the MIT License.\nfoo\nReleased under the MIT License.\nMIT", set()),
    (36, "Released under the MIT License.\nfoo\nReleased under the MIT License.\nMIT", set()),
    (37, MIT[: len(MIT) // 2] + "\n" + PROSE, set()),
    (38, PROSE, set()),
]


def best_runs(text, name):
    """All runs of neighbouring lines, the best first, none overlapping one taken before."""
    import re

    words = lambda t: [w for w in re.sub("[^a-z0-9]+", " ", lower_ascii(t)).split(" ") if w]
    lines = [(no, w) for no, line in enumerate((text or "").split("\n"), 1) if (w := words(line))]
    template, passing = words(TEMPLATES[name]), []
    for i in range(len(lines)):
        run = []
        for j in range(i, len(lines)):
            run = run + lines[j][1]
            if len(run) > 3 * len(template):
                break
            if len(run) > 1 and (dice := bag_dice(run, template)) >= 0.8:
                passing.append((-dice, lines[i][0], lines[j][0]))
    taken = []
    for rank, first, last in sorted(passing):
        if all(last < a or first > b for _, a, b in taken):
            taken.append((rank, first, last))
    return sorted((first, last, round(-rank, 6)) for rank, first, last in taken if first < last)


def test_licences_in_their_usual_layout_by_brute_force(spark, edge_docs):
    docs = spark.createDataFrame([row[:2] for row in LAYOUTS], "doc_id long, text string").withColumn("words", F.lit("clash")).withColumn("t", F.lit("clash"))
    docs = docs.unionByName(edge_docs.where("doc_id is null or doc_id not in (7, 8)").select("doc_id", "text", F.lit("").alias("words"), F.lit("").alias("t")))
    ours = licenses.scan(docs).toPandas()
    beside_sql(ours, checks.licenses(), documents=docs.toPandas().astype({"doc_id": "Int64"}))
    runs = ours[ours.unit == "run"]
    for doc_id, _, names in LAYOUTS:
        assert names <= set(ours[ours.doc_id == doc_id].template), doc_id
        assert set(runs[runs.doc_id == doc_id].template) <= names or not names
    assert len(runs[(runs.doc_id == 33) & (runs.template == "MIT")]) == 2
    expected = [(doc_id, name, *run) for doc_id, text, _ in LAYOUTS for name in TEMPLATES for run in best_runs(text, name)]
    assert sorted((r.doc_id, r.template, r.unit_no, r.last_no, r.dice) for r in runs.itertuples()) == sorted(expected)
    assert len(runs) >= 7


@pytest.mark.parametrize("threshold", [0.5, 0.95])
def test_licence_runs_at_other_thresholds(spark, threshold):
    docs = spark.createDataFrame([row[:2] for row in LAYOUTS], "doc_id long, text string")
    beside_sql(licenses.scan(docs, threshold=threshold).toPandas(), checks.licenses(threshold), documents=docs.toPandas())


def test_licences_of_nothing(no_docs, edge_docs):
    assert licenses.scan(no_docs).count() == 0
    assert licenses.scan(edge_docs, templates={"a word": "word", "none": ""}).count() == 0
    assert licenses.scan(edge_docs, templates={}).count() == 0


def test_licence_sizes_lose_no_match():
    for threshold in (0.5, 0.8, 0.9, 1.0):
        ratio = threshold / (2 - threshold)
        for size in range(1, 60):
            possible = [n for n in range(1, 300) if 2 * min(n, size) >= threshold * (n + size)]
            import math

            assert possible == list(range(math.ceil(size * ratio - 1e-9), math.floor(size / ratio + 1e-9) + 1))


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower_ascii(text or "")].append(doc_id)
    out = []
    for doc_id, text in rows:
        body = lower_ascii(text or "")
        known = [i for i in groups[body] if i is not None]
        keep = max(known) if known else None
        out.append((doc_id, keep, len(groups[body]), doc_id == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_by_brute_force(edge_docs, edge_texts, weak):
    digest = (lambda t: F.substring(F.sha2(t, 256), 1, 1).cast("binary")) if weak else exact_dedup.sha256
    found = exact_dedup.exact_duplicates(edge_docs, digest).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_groups(edge_texts)


def test_exact_groups_over_the_broadcast_bound(edge_docs, edge_texts, monkeypatch):
    monkeypatch.setattr(exact_dedup, "fits", lambda df, row_bytes: False)
    found = exact_dedup.exact_duplicates(edge_docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_groups(edge_texts)


def test_exact_groups_of_nothing(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0


def test_state_grows_over_batches(spark):
    rows = pd.DataFrame({"digest": [bytes([k % 5]) for k in range(200)], "doc_id": range(200), "locator": ["f"] * 200})
    records = spark.createDataFrame(rows, "digest binary, doc_id long, locator string").repartition(8)
    state = {r["digest"][0]: (r["keep_id"], r["members"]) for r in exact_dedup.keyed_state(records, batches=4).collect()}
    assert state == {k: (195 + k, 40) for k in range(5)}
