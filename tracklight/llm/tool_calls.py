"""Tool-call linking: calls and results meet by identifier, are ordered topologically, checked and written canonically.

Input are messages (conv_id, turn, role, text). An assistant message whose text is the JSON object
``{"tool_calls": [{"id", "name", "arguments"}]}`` holds calls; a tool message whose text is
``{"tool_call_id", "content"}`` holds a result. Everything else is a plain message.

* Linking is a hash join on (conv_id, call_id). Of calls that repeat an identifier the first by (turn, place)
  counts, the others are listed as ``duplicate``; of several results the earliest is linked and ``results``
  counts them. Both are found by aggregates that combine inside tasks, so a long conversation is never
  gathered: it spreads over its identifiers.
* An argument string ``$id`` refers to another call of the conversation. The level of a call is the length of the
  longest chain of references below it, 0 without any, so (level, turn, place) is a topological order. Calls with
  one reference point to the call below them and doubling such pointers ends at a call with none or several in as
  many rounds as the logarithm of the chain; only calls with several references are peeled, one round for each of
  them on the longest chain. Calls on or above a cycle keep a null level and an error.
* Arguments are checked against rules (tool, argument, type, required, least, most): presence, type, length of
  strings or range of numbers, unexpected names, unknown tools and references.
* Canonical JSON has sorted keys and no blanks.

Null text counts as empty and is a plain message; malformed JSON, duplicate keys and absent identifiers give
errors, not failures; rows without a conv_id are listed and never linked. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklight.llm.common import fits, hinted, text_of
from tracklight.runtime import BROADCAST_BYTES, Relay, stage

CALLS = "tool_calls array<struct<id:string,name:string,arguments:string>>"
RESULT = "tool_call_id string, content string"
RULES = "tool string, argument string, type string, required boolean, least double, most double"
COLUMNS = ["conv_id", "turn", "place", "kind", "call_id", "status", "errors", "depends_on", "level", "result_turn", "results", "json"]


def canonical(json: Column) -> Column:
    """JSON text with sorted keys; null where it is malformed or repeats a key."""
    return F.to_json(F.try_parse_json(json))


def quoted(text: Column) -> Column:
    """A JSON string, null as null."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def parse(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and plain messages."""
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text_of().alias("text"))
    rows = rows.withColumn("call_list", F.when(F.col("role") == "assistant", F.from_json("text", CALLS)["tool_calls"]))
    rows = rows.withColumn("answer", F.when(F.col("role") == "tool", F.from_json("text", RESULT)))
    is_result = F.col("answer.tool_call_id").isNotNull()
    calls = rows.where(F.size("call_list") > 0).select("conv_id", "turn", F.posexplode("call_list").alias("place", "call"))
    calls = calls.select("conv_id", "turn", "place", F.col("call.id").alias("call_id"), F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"))
    results = rows.where(is_result).select("conv_id", "turn", F.col("answer.tool_call_id").alias("call_id"), F.col("answer.content").alias("content"))
    plain = rows.where(~F.coalesce(F.size("call_list") > 0, F.lit(False)) & ~F.coalesce(is_result, F.lit(False)))
    return calls, results, plain.select("conv_id", "turn", "role", "text")


def argument_errors(rules: DataFrame) -> Column:
    """Errors of the columns ``given`` (map of variants) and ``rules`` (array of structs, null for an unknown tool)."""

    def broken(rule: Column) -> Column:
        value = F.get(F.transform(F.array(rule["argument"]), lambda a: F.try_element_at(F.col("given"), a)), F.lit(0))
        kind = F.schema_of_variant(value)
        fine = (
            F.when(rule["type"] == "string", kind == "STRING")
            .when(rule["type"] == "integer", kind == "BIGINT")
            .when(rule["type"] == "number", kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"))
            .when(rule["type"] == "boolean", kind == "BOOLEAN")
            .when(rule["type"] == "object", kind.startswith("OBJECT"))
            .when(rule["type"] == "array", kind.startswith("ARRAY"))
            .otherwise(False)
        )
        text = value.cast("string")
        amount = F.when(rule["type"] == "string", F.length(text).cast("double")).when(rule["type"].isin("integer", "number"), text.try_cast("double"))
        absent = value.isNull() | (kind == "VOID")
        return (
            F.when(absent, F.when(rule["required"], F.concat(F.lit("missing "), rule["argument"])))
            .when(~fine, F.concat(rule["argument"], F.lit(" is not of type "), rule["type"]))
            .when((amount < rule["least"]) | (amount > rule["most"]), F.concat(rule["argument"], F.lit(" is out of range")))
        )

    known = F.transform("rules", lambda r: r["argument"])
    extra = F.transform(F.array_sort(F.array_except(F.map_keys("given"), known)), lambda a: F.concat(F.lit("unexpected "), a))
    return (
        F.when(F.col("rules").isNull(), F.array(F.concat(F.lit("unknown tool "), F.coalesce("name", F.lit("")))))
        .when(F.col("given").isNull(), F.array(F.lit("arguments are not an object")))
        .otherwise(F.concat(F.filter(F.transform("rules", broken), lambda e: e.isNotNull()), extra))
    )


def anchors(single: DataFrame) -> DataFrame:
    """conv_id, call_id, anchor, steps: where the chain of single references from a call ends and its length.

    ``single`` (conv_id, call_id, dep) has one row per call. Pointers double in every round, so chains of n calls
    take log2(n) rounds; a pointer that still moves after more steps than there are calls runs in a cycle and is
    left out.
    """
    versions = Relay(single.sparkSession, "anchors")
    heads = single.select("conv_id", F.col("call_id").alias("anchor"), F.lit(True).alias("moves"))
    state = single.select("conv_id", "call_id", F.col("dep").alias("anchor"), F.lit(1).cast("long").alias("steps"))
    state = versions.write(state.join(heads, ["conv_id", "anchor"], "left").withColumn("moves", F.coalesce("moves", F.lit(False))))
    calls, reach = state.count(), 1
    while reach <= calls and not state.where("moves").isEmpty():
        ahead = state.select("conv_id", F.col("call_id").alias("anchor"), F.col("anchor").alias("next"), F.col("steps").alias("more"), F.col("moves").alias("still"))
        moved = state.where("moves").join(hinted(ahead, calls * 256 <= BROADCAST_BYTES), ["conv_id", "anchor"])
        moved = moved.select("conv_id", "call_id", F.col("next").alias("anchor"), (F.col("steps") + F.col("more")).alias("steps"), F.col("still").alias("moves"))
        state = versions.write(state.where("not moves").unionByName(moved))
        reach *= 2
    return state.where("not moves").drop("moves")


def levels(edges: DataFrame) -> DataFrame:
    """conv_id, call_id, level of the calls that have references; null on or above a cycle.

    ``edges``: distinct (conv_id, call_id, dep). Calls that only occur as ``dep`` have level 0.
    """
    key = ["conv_id", "call_id"]
    edges = stage(edges, "edges")
    counted = edges.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("dep").alias("dep"))
    counted = stage(counted, "counted")
    single, several = counted.where("n = 1").select(*key, "dep"), counted.where("n > 1").select(*key)
    placed = stage(anchors(stage(single, "single")), "placed")
    if several.isEmpty():
        return counted.select(*key).join(placed.select(*key, F.col("steps").cast("int").alias("level")), key, "left")

    # References of the calls with several ones, drawn together to where their chains end.
    ends = placed.select("conv_id", F.col("call_id").alias("dep"), "anchor", "steps", F.lit(True).alias("found"))
    alone = single.select("conv_id", F.col("call_id").alias("dep"), F.lit(True).alias("is_single"))
    drawn = edges.join(several, key, "left_semi").join(ends, ["conv_id", "dep"], "left").join(alone, ["conv_id", "dep"], "left")
    lost = drawn.where("is_single and found is null").select(*key).distinct()  # above a cycle of single references
    drawn = drawn.select(*key, F.coalesce("anchor", "dep").alias("anchor"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"))
    drawn = stage(drawn.groupBy(*key, "anchor").agg(F.max("steps").alias("steps")), "drawn")
    heads = several.select("conv_id", F.col("call_id").alias("anchor"))
    waiting = stage(drawn.join(heads, ["conv_id", "anchor"], "left_semi"), "waiting")
    reached = drawn.join(heads, ["conv_id", "anchor"], "left_anti").select(*key, F.col("steps").alias("level"))
    left = stage(several.join(lost, key, "left_anti"), "left")
    reached, done = stage(reached, "reached"), []
    while True:
        ready = left.join(waiting, key, "left_anti").join(reached, key).groupBy(*key).agg(F.max("level").alias("level"))
        ready = stage(ready, "ready")
        if ready.isEmpty():
            break
        done.append(ready)
        below = ready.select("conv_id", F.col("call_id").alias("anchor"), F.col("level").alias("below"))
        reached = stage(reached.unionByName(waiting.join(below, ["conv_id", "anchor"]).select(*key, (F.col("below") + F.col("steps")).alias("level"))), "reached")
        left = stage(left.join(ready, key, "left_anti"), "left")
        waiting = stage(waiting.join(below, ["conv_id", "anchor"], "left_anti"), "waiting")
    peeled = stage(reduce(DataFrame.unionByName, done), "peeled") if done else left.where("false").withColumn("level", F.lit(0).cast("long"))
    base = peeled.select("conv_id", F.col("call_id").alias("anchor"), F.col("level").alias("below"))
    chained = placed.join(base, ["conv_id", "anchor"], "left").join(heads.withColumn("peels", F.lit(True)), ["conv_id", "anchor"], "left")
    chained = chained.select(*key, F.when(F.col("peels"), F.col("below") + F.col("steps")).otherwise(F.col("steps")).alias("level"))
    return counted.select(*key).join(chained.unionByName(peeled).select(*key, F.col("level").cast("int").alias("level")), key, "left")


def link(messages: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per call, per result without a call, and per plain message; columns ``COLUMNS``.

    ``kind``: call, result or message. ``status`` of a call: linked, unanswered or duplicate; of a result: orphan.
    ``json`` is the canonical object of the row.
    """
    calls, results, plain = parse(messages)
    calls = stage(calls, "calls")
    per_tool = stage(
        rules.groupBy(F.col("tool").alias("name")).agg(
            F.array_sort(F.collect_list(F.struct("argument", "type", "required", "least", "most"))).alias("rules")
        ),
        "tool-rules",
    )
    key = ["conv_id", "call_id"]
    first = calls.where("call_id is not null").groupBy(*key).agg(F.min(F.struct("turn", "place")).alias("first_at"))
    answers = results.groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("answer"), F.count(F.lit(1)).alias("results"))
    checked = calls.join(hinted(per_tool, fits(per_tool, 65536)), "name", "left")
    checked = checked.withColumn("given", F.from_json("arguments", "map<string,variant>"))
    checked = checked.withColumn("errors", argument_errors(rules))
    references = F.array_sort(F.array_distinct(F.regexp_extract_all(F.coalesce("arguments", F.lit("")), F.lit(r'"\$([A-Za-z0-9_-]+)"'), 1)))
    checked = stage(
        checked.join(first, key, "left").select(
            *key, "turn", "place", "name", canonical(F.col("arguments")).alias("arguments"), "errors", references.alias("depends_on"),
            (F.struct("turn", "place") == F.col("first_at")).alias("counts"),
        ),
        "checked-calls",
    )

    # References: those that exist order the calls, the others are errors.
    edges = checked.where(F.size("depends_on") > 0).select("conv_id", "call_id", F.struct("turn", "place").alias("at"), F.explode(F.array_distinct("depends_on")).alias("dep"))
    places = first.select("conv_id", F.col("call_id").alias("dep"), "first_at")
    edges = stage(edges.join(places, ["conv_id", "dep"], "left"), "references")
    unknown = edges.where("first_at is null").groupBy("conv_id", "call_id", "at").agg(F.array_sort(F.collect_set(F.concat(F.lit("unknown reference $"), "dep"))).alias("unknown"))
    known = edges.where("first_at is not null and call_id is not null").select(*key, "dep").distinct()
    peeled = None
    if not known.isEmpty():
        peeled = stage(levels(known).select(*key, F.coalesce("level", F.lit(-1)).alias("peeled")), "levels")

    out = checked.withColumn("at", F.struct("turn", "place")).join(unknown, [*key, "at"], "left").join(answers, key, "left")
    out = out.withColumn("peeled", F.lit(None).cast("int")) if peeled is None else out.join(hinted(peeled, fits(peeled, 256)), key, "left")
    duplicate = F.col("call_id").isNotNull() & ~F.col("counts")
    linked = ~duplicate & F.col("results").isNotNull()
    nothing = F.array().cast("array<string>")
    errors = F.concat(
        "errors", F.when(F.col("arguments").isNull(), F.array(F.lit("arguments are malformed"))).otherwise(nothing), F.coalesce("unknown", nothing),
        F.when(F.col("peeled") == -1, F.array(F.lit("cycle of references"))).otherwise(nothing),
        F.when(F.col("call_id").isNull(), F.array(F.lit("missing id"))).otherwise(nothing),
        F.when(linked & (F.col("answer.turn") < F.col("turn")), F.array(F.lit("result precedes call"))).otherwise(nothing),
    )
    listed = out.select(
        "conv_id", "turn", "place", F.lit("call").alias("kind"), "call_id",
        F.when(duplicate, "duplicate").when(linked, "linked").otherwise("unanswered").alias("status"),
        errors.alias("errors"), "depends_on",
        F.when(F.col("peeled") == -1, F.lit(None)).otherwise(F.coalesce("peeled", F.lit(0))).alias("level"),
        F.when(linked, F.col("answer.turn")).alias("result_turn"), F.when(linked, F.col("results")).alias("results"),
        "name", "arguments", F.when(linked, F.col("answer.content")).alias("content"),
    )
    listed = listed.withColumn("json", F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), quoted(F.col("name")),
        F.lit(',"result":'), quoted(F.col("content")), F.lit("}"),
    )).select(*COLUMNS)
    orphans = results.join(first.select(*key), key, "left_anti")
    message = lambda role, text: F.concat(F.lit('{"content":'), quoted(text), F.lit(',"role":'), quoted(role), F.lit("}"))
    missing = lambda kind: F.lit(None).cast(kind)
    alone = orphans.select(
        "conv_id", "turn", F.lit(0).alias("place"), F.lit("result").alias("kind"), "call_id", F.lit("orphan").alias("status"), nothing.alias("errors"),
        nothing.alias("depends_on"), F.lit(0).alias("level"), F.col("turn").alias("result_turn"), F.lit(1).cast("long").alias("results"),
        message(F.lit("tool"), F.col("content")).alias("json"),
    )
    rest = plain.select(
        "conv_id", "turn", F.lit(0).alias("place"), F.lit("message").alias("kind"), missing("string").alias("call_id"), missing("string").alias("status"),
        nothing.alias("errors"), nothing.alias("depends_on"), F.lit(0).alias("level"), missing("long").alias("result_turn"), missing("long").alias("results"),
        message(F.col("role"), F.col("text")).alias("json"),
    )
    return listed.unionByName(alone).unionByName(rest)
