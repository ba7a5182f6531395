"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams.

Units of a document are its lines, its blocks (runs of lines between blank lines, if longer than a line),
the whole text (if longer than a block) and its runs of neighbouring lines, blank lines inside included, so that
a licence is found in its usual layout and beside other text. A unit and a template are bags of word bigrams
over lower-case ASCII letters and digits. Dice is 2 * common / (a + b), so a coefficient of t or more needs
a * t <= b * (2 - t) and the same the other way round; the sizes that a template allows are listed, and
units meet templates in an equi-join on size, before any bigram is built. Templates are a parameter with
few rows; the join's small side is broadcast after its rows are counted.

Runs are searched only where a template can fit: a bag at the threshold holds at least b * t / (2 - t) bigrams of
the template, so a document needs as many distinct words of it as any such share holds, and then as many of its
bigrams. A run that passes with a first line that shares nothing also passes without it and scores higher, so runs
start at lines that share a bigram. Of the runs that pass for a template the best by (dice, first line, last line)
is taken, then the best that overlaps none taken, and so on; those of several lines are listed (single lines are
units of their own). This takes passing runs times taken ones of one document and template.

Null and empty texts, and units of a single word, match nothing. Every template that passes is listed, so
equal coefficients give several rows; rows that repeat are listed again. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklight.llm.common import ascii_lower, fits, hinted, text_of
from tracklight.llm.license_texts import TEMPLATES

THRESHOLD = 0.8


def normal(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits, one space between them; line ends stay."""
    return F.lower(F.regexp_replace(text, "[^A-Za-z0-9\\n]+", " "))


def words(unit: Column) -> Column:
    return F.filter(F.split(unit, "[ \\n]+"), lambda w: w != "")


def bigrams(unit: Column) -> Column:
    """Bigrams of an array of at least two words."""
    return F.transform(F.sequence(F.lit(1), F.size(unit) - 1), lambda i: F.concat_ws(" ", F.get(unit, i - 1), F.get(unit, i)))


def allowed_sizes(size: Column, threshold: float) -> Column:
    """Bag sizes that can reach the threshold beside a bag of ``size`` bigrams."""
    ratio = threshold / (2 - threshold)
    return F.sequence(F.ceil(size * ratio - 1e-9).cast("int"), F.floor(size / ratio + 1e-9).cast("int"))


def template_table(spark, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """template, template_bag, template_bigrams and, one row each, the unit_bigrams it may meet."""
    rows = spark.createDataFrame(sorted(templates.items()), "template string, template_text string")
    bag = rows.select("template", words(normal(F.col("template_text"))).alias("template_words")).where(F.size("template_words") > 1)
    bag = bag.select("template", bigrams(F.col("template_words")).alias("template_bag"))
    grams = F.array_distinct("template_bag")
    sized = bag.select("*", F.size("template_bag").alias("template_bigrams"), grams.alias("template_grams"))
    return sized.withColumn("unit_bigrams", F.explode(allowed_sizes(F.col("template_bigrams"), threshold)))


def neighbours(words: Column) -> Column:
    """Bigrams of any array of words; a last element is null."""
    return F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def known_templates(templates: dict[str, str], threshold: float) -> tuple[Column, list[str], int]:
    """The templates as an array of structs, all their words, and the least number of words any of them asks of a document."""
    ratio = threshold / (2 - threshold)
    rows, vocabulary, least = [], set(), []
    for name, text in sorted(templates.items()):
        found = [w.lower() for w in re.findall("[A-Za-z0-9]+", text)]
        bag = Counter(" ".join(pair) for pair in zip(found, found[1:]))
        if not bag:
            continue
        size = bag.total()
        low, high = math.ceil(size * ratio - 1e-9), math.floor(size / ratio + 1e-9)
        # Every common bigram has a left word; the most frequent words cover the most of them.
        covered, asked = 0, 0
        for _, count in Counter(found).most_common():
            if covered >= low:
                break
            covered, asked = covered + count, asked + 1
        repeated = [F.struct(F.lit(g).alias("gram"), F.lit(n).alias("times")) for g, n in bag.items() if n > 1]
        none = F.array().cast("array<struct<gram:string,times:int>>")
        rows.append(F.struct(
            F.lit(name).alias("template"), F.lit(size).alias("size"), F.lit(low).alias("low"), F.lit(high).alias("high"), F.lit(asked).alias("asked"),
            F.array(*map(F.lit, sorted(set(found)))).alias("vocabulary"), F.array(*map(F.lit, bag)).alias("grams"),
            (F.array(*repeated) if repeated else none).alias("repeated"),
        ))
        vocabulary.update(found)
        least.append(asked)
    return F.array(*rows), sorted(vocabulary), min(least, default=0)


def runs(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``scan`` for the best runs of several neighbouring lines; ``unit_no`` and ``last_no`` are line numbers."""
    known, vocabulary, least = known_templates(templates, threshold)
    lower = docs.select("doc_id", ascii_lower(text_of()).alias("body"))
    if not vocabulary:
        return lower.where("false").selectExpr(
            "doc_id", "'run' unit", "0 unit_no", "0 last_no", "'' template", "0 common", "0 unit_bigrams", "0 template_bigrams", "0D dice"
        )

    def fitting(words: Column) -> Column:
        """The templates whose words the document holds, each with the document's words."""
        asked = lambda present: F.filter(known, lambda t: F.size(F.array_intersect(present, t["vocabulary"])) >= t["asked"])
        chosen = lambda present: F.when(F.size(present) >= least, asked(present))
        return F.transform(let(F.array_intersect(words, F.array(*map(F.lit, vocabulary))), chosen), lambda t: F.struct(t.alias("t"), words.alias("words")))

    # Each text is split once: the lambdas hold their values, and an outer explode is not preceded by a filter on its own input.
    held = F.when(F.col("body").contains("\n"), let(F.split("body", "[^a-z0-9]+"), fitting))
    pairs = lower.select("doc_id", "body", F.explode_outer(held).alias("p")).where("p is not null").select("doc_id", "body", "p.words", "p.t")
    shared = F.size(F.array_intersect(neighbours(F.col("words")), F.col("t.grams")))
    pairs = pairs.where(shared + F.col("t.size") - F.size("t.grams") >= F.col("t.low"))

    parted = F.transform(
        F.split("body", "\n"), lambda line, i: F.struct((i + 1).alias("no"), F.filter(F.split(line, "[^a-z0-9]+"), lambda w: w != "").alias("words"))
    )
    lined = pairs.select("doc_id", "t", F.filter(parted, lambda line: F.size(line["words"]) > 0).alias("lines"))
    size, low, high, grams = F.col("t.size"), F.col("t.low"), F.col("t.high"), F.col("t.grams")
    nothing = F.array().cast("array<string>")

    def shares(i: Column) -> Column:
        following = F.coalesce(F.slice(F.get("lines", i + 1)["words"], 1, 1), nothing)
        return F.arrays_overlap(neighbours(F.concat(F.get("lines", i)["words"], following)), grams)

    def common(bag: Column) -> Column:
        times = lambda r: F.greatest(F.least(r["times"], F.size(F.filter(bag, lambda g: g == r["gram"]))) - 1, F.lit(0))
        return F.aggregate(F.col("t.repeated"), F.size(F.array_intersect(bag, grams)), lambda n, r: n + times(r))

    def from_line(i: Column) -> Column:
        """The runs from line i whose size the template allows."""
        piece = F.slice("lines", i + 1, high + 1)
        last = lambda ends: F.coalesce(F.get(ends, F.size(ends) - 1), F.lit(0))
        # Words up to the end of each line, until they are too many.
        ends = F.aggregate(
            piece,
            F.array().cast("array<int>"),
            lambda acc, line: F.when(last(acc) > high + 1, acc).otherwise(F.concat(acc, F.array(last(acc) + F.size(line["words"])))),
        )

        def of(held: Column) -> Column:
            flat = F.flatten(F.transform(F.slice(piece, F.lit(1), F.size(held)), lambda line: F.slice(line["words"], F.lit(1), high + 2)))
            allowed = F.filter(F.transform(held, lambda e, j: F.struct(j.alias("j"), (e - 1).alias("n"))), lambda e: e["n"].between(low, high))
            scored = lambda words, e: F.struct(
                F.get("lines", i)["no"].alias("first"), F.get("lines", i + e["j"])["no"].alias("last"), e["n"].alias("n"),
                common(neighbours(F.slice(words, F.lit(1), e["n"] + 1))).alias("common"),
            )
            return let(flat, lambda words: F.transform(allowed, lambda e: scored(words, e)))

        return F.filter(let(ends, of), lambda r: 2 * r["common"] >= threshold * (r["n"] + size))

    starts = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), shares)
    passing = lined.select("doc_id", "t", F.flatten(F.transform(starts, from_line)).alias("passing"))
    ranked = F.array_sort(
        F.transform("passing", lambda r: F.struct((-2 * r["common"] / (r["n"] + size)).alias("rank"), r["first"].alias("first"), r["last"].alias("last"), r["n"].alias("n"), r["common"].alias("common")))
    )
    meets = lambda a, b: (a["first"] <= b["last"]) & (b["first"] <= a["last"])
    none = F.array().cast("array<struct<rank:double,first:int,last:int,n:int,common:int>>")
    taken = F.aggregate(ranked, none, lambda acc, r: F.when(F.exists(acc, lambda a: meets(a, r)), acc).otherwise(F.concat(acc, F.array(r))))
    several = lambda r: r["first"] < r["last"]
    chosen = F.when(F.exists("passing", several), F.filter(taken, several))
    found = passing.select("doc_id", "t", F.explode_outer(chosen).alias("r")).where("r is not null")
    return found.select(
        "doc_id", F.lit("run").alias("unit"), F.col("r.first").alias("unit_no"), F.col("r.last").alias("last_no"), F.col("t.template").alias("template"),
        F.col("r.common").alias("common"), F.col("r.n").alias("unit_bigrams"), size.alias("template_bigrams"), F.round(-F.col("r.rank"), 6).alias("dice"),
    )


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, unit (line, block, text or run), unit_no (1-based among units of its kind; of a run its first line),
    last_no (the same; of a run its last line), template, common, unit_bigrams, template_bigrams, dice: one row for
    every unit and template at or above the threshold."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies above 0 and up to 1")
    known = template_table(docs.sparkSession, templates, threshold)
    ratio = threshold / (2 - threshold)
    # Normalised words are at most as many as the letters, so no unit above this size meets any template.
    most = math.floor(max((len(t) for t in templates.values()), default=1) / ratio) + 1
    text = normal(text_of())
    lines = F.split(F.col("body"), "\n")
    blocks = F.split(F.col("body"), "\n *\n[ \n]*")

    def units(kind: str, parts: Column, keep) -> Column:
        numbered = F.transform(parts, lambda part, i: F.struct(F.lit(kind).alias("unit"), (i + 1).alias("unit_no"), words(part).alias("words"), part.alias("part")))
        return F.transform(F.filter(numbered, keep), lambda u: F.struct(u["unit"], u["unit_no"], u["words"]))

    none = F.array().cast("array<struct<unit:string,unit_no:int,words:array<string>>>")
    in_size = lambda u: (F.size(u["words"]) > 1) & (F.size(u["words"]) - 1 <= most)
    several = lambda u: F.trim(u["part"]).contains("\n")
    found = docs.select("doc_id", text.alias("body")).select(
        "doc_id",
        F.explode(
            F.concat(
                units("line", lines, in_size),
                F.when(F.col("body").contains("\n"), units("block", blocks, lambda u: several(u) & in_size(u))).otherwise(none),
                F.when(F.size(blocks) > 1, units("text", F.array(F.col("body")), in_size)).otherwise(none),
            )
        ).alias("u"),
    )
    sized = found.select("doc_id", "u.unit", "u.unit_no", "u.words", (F.size("u.words") - 1).alias("unit_bigrams"))
    pairs = sized.join(hinted(known, fits(known, 16384)), "unit_bigrams")
    # Shared bigrams without their counts, plus what the template repeats, bound the common bag from above.
    shared = F.size(F.array_intersect(bigrams(F.col("words")), F.col("template_grams")))
    bound = shared + F.col("template_bigrams") - F.size("template_grams")
    pairs = pairs.where(2 * bound >= threshold * (F.col("unit_bigrams") + F.col("template_bigrams")))

    def held(bag: Column, gram: Column) -> Column:
        return F.size(F.filter(bag, lambda x: x == gram))

    each = F.transform("template_grams", lambda g: F.least(held(F.col("template_bag"), g), held(bigrams(F.col("words")), g)))
    common = F.aggregate(each, F.lit(0), lambda a, x: a + x)
    scored = pairs.withColumn("common", common)
    dice = 2 * F.col("common") / (F.col("unit_bigrams") + F.col("template_bigrams"))
    scored = scored.withColumn("dice", F.round(dice, 6)).where(2 * F.col("common") >= threshold * (F.col("unit_bigrams") + F.col("template_bigrams")))
    scored = scored.select("doc_id", "unit", "unit_no", F.col("unit_no").alias("last_no"), "template", "common", "unit_bigrams", "template_bigrams", "dice")
    return scored.unionByName(runs(docs, templates, threshold))
