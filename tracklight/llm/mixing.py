"""Mixing sources to target weights: temperature, bisected exponent, budgeted block permutations.

A source's share p of all tokens becomes a weight proportional to p**a. The exponent a in [0, 1] is
bisected (sixteen parts a round) to the largest value whose entropy meets the target; a repetition limit
asks for an exponent that is large enough, and wins. With a budget of B tokens a source owes w * B tokens:
full passes over all its documents and one partial pass.

A pass is a permutation of blocks: the documents of a source are hashed into about sqrt(n) blocks, the
blocks of each pass are ordered by a digest of source, pass, block and seed, and documents inside a block by a digest
of their id and pass. The partial pass takes whole blocks while they fit and then documents of the next
block while they fit, so every source ends within one document of what it owes. Windows only ever see
the block totals of a source or the documents of one block: both about sqrt(n) rows.

Without a budget the smallest one is taken that gives every source at least one full pass, so no document
is lost. Sources are told apart by value; null is a source of its own. Null and empty texts have no
tokens and come with every pass of their source; a source without any token gets one pass. Rows that
repeat a doc_id are mixed as separate rows. An empty table stays empty. Columns named like the results
(``mix_...``) are replaced, other columns pass through whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tracklight.llm.common import fits, hinted, text_of
from tracklight.runtime import stage

PARTS, ROUNDS = 16, 7


def digest(*parts: Column) -> Column:
    """The first 15 hex digits of an md5 over the parts, as a number."""
    text = F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def bisect_exponent(shares: DataFrame, target_entropy: float, max_repetition: float, budget_share: float | None) -> float:
    """Exponent for shares (column ``p``, above 0): the largest that reaches ``target_entropy`` times the largest
    possible entropy, or, if that repeats a source more than ``max_repetition`` times, the least that does not."""
    p = F.col("p")
    whole = shares.agg(
        F.count(F.lit(1)).alias("n"), F.sum(-p * F.log(p)).alias("entropy"), F.max(p).alias("most"), F.min(p).alias("least")
    ).first()
    if whole["n"] < 2:
        return 1.0
    goal = target_entropy * math.log(whole["n"])
    by_entropy, by_limit = (0.0, 1.0), (0.0, 1.0)
    for _ in range(ROUNDS):
        grid = [_parts(by_entropy), _parts(by_limit)]
        sums = shares.agg(
            *[F.sum(p ** F.lit(a)).alias(f"z{k}_{i}") for k in (0, 1) for i, a in enumerate(grid[k])],
            *[F.sum(p ** F.lit(a) * F.log(p)).alias(f"s{i}") for i, a in enumerate(grid[0])],
        ).first()
        entropy = [math.log(sums[f"z0_{i}"]) - a * sums[f"s{i}"] / sums[f"z0_{i}"] for i, a in enumerate(grid[0])]
        if budget_share is None:  # the largest source is read once
            repeats = [(whole["most"] / whole["least"]) ** (1 - a) for a in grid[1]]
        else:
            repeats = [whole["least"] ** (a - 1) / sums[f"z1_{i}"] * budget_share for i, a in enumerate(grid[1])]
        by_entropy = _between(grid[0], [h >= goal for h in entropy])
        by_limit = _between(grid[1], [r > max_repetition for r in repeats])
    return round(max(by_entropy[0], by_limit[0]), 6)


def _parts(span: tuple[float, float]) -> list[float]:
    return [span[0] + (span[1] - span[0]) * i / PARTS for i in range(PARTS + 1)]


def _between(grid: list[float], holds: list[bool]) -> tuple[float, float]:
    """The part of the grid in which a condition that holds from the left ends."""
    if all(holds):
        return grid[-1], grid[-1]
    if not holds[0]:
        return grid[0], grid[0]
    last = holds.index(False)
    return grid[last - 1], grid[last]


def source_plan(counted: DataFrame, target_entropy: float, max_repetition: float, budget_share: float | None) -> DataFrame:
    """One row per source of ``counted`` (source, mix_tokens): mix_source, rows, tokens, blocks, weight, quota,
    passes (full ones) and rest (tokens of the partial pass)."""
    sizes = stage(
        counted.groupBy(F.col("source").cast("string").alias("mix_source")).agg(F.count(F.lit(1)).alias("rows"), F.sum("mix_tokens").alias("tokens")),
        "mix-sizes",
    )
    total = sizes.agg(F.sum("tokens")).first()[0] or 0
    shares = sizes.where("tokens > 0").select((F.col("tokens") / F.lit(float(total or 1))).alias("p"))
    exponent = bisect_exponent(shares, target_entropy, max_repetition, budget_share)
    raw = F.when(F.col("tokens") > 0, (F.col("tokens") / F.lit(float(total or 1))) ** F.lit(exponent)).otherwise(0.0)
    norm = sizes.agg(F.sum(raw)).first()[0] or 1.0
    weighed = sizes.withColumn("weight", F.round(raw / F.lit(norm), 9))
    if budget_share is not None:
        budget = math.floor(total * budget_share)
    else:
        needed = weighed.where("weight > 0").agg(F.max(F.ceil(F.col("tokens") / F.col("weight")))).first()[0]
        budget = int(needed or 0)
    owed = F.greatest(F.floor(F.col("weight") * F.lit(float(budget))), F.lit(0)).cast("long")
    return weighed.select(
        "mix_source", "rows", "tokens", F.ceil(F.sqrt(F.col("rows").cast("double"))).cast("long").alias("blocks"), "weight", owed.alias("quota"),
        F.when(F.col("tokens") > 0, F.floor(owed / F.col("tokens")).cast("long")).otherwise(F.lit(1).cast("long")).alias("passes"),
        F.when(F.col("tokens") > 0, owed % F.col("tokens")).otherwise(F.lit(0).cast("long")).alias("rest"),
    )


def mix(docs: DataFrame, target_entropy: float = 0.98, max_repetition: float = 4.0, budget_share: float | None = None, seed: int = 0) -> DataFrame:
    """The mixture of ``budget_share`` times the tokens there are: every row as often as its passes ask for, with

    mix_pass (0-based), mix_block (place of its block in the pass), mix_key (place inside the block),
    mix_tokens and mix_weight. Ordering by (mix_pass, mix_block, mix_key) within a source gives its permutation.
    """
    own = ["mix_pass", "mix_block", "mix_key", "mix_tokens", "mix_weight"]
    kept = [c for c in docs.columns if c.lower() not in own]
    counted = stage(docs.select("doc_id", "source", word_count(text_of()).alias("mix_tokens")), "mix-counted")
    plan = stage(source_plan(counted, target_entropy, max_repetition, budget_share), "mix-plan")
    small = fits(plan, 128)
    same = F.col("s.mix_source").eqNullSafe(F.col("d.source").cast("string"))

    def placed(rows: DataFrame) -> DataFrame:
        """Rows with their source's plan and their block."""
        joined = rows.alias("d").join(hinted(plan, small).alias("s"), same)
        return joined.withColumn("mix_home", F.pmod(digest(F.col("d.doc_id"), F.lit(seed)), F.col("s.blocks")))

    narrow = placed(counted)
    totals = narrow.groupBy("s.mix_source", "mix_home").agg(F.sum("mix_tokens").alias("held"), F.first("s.passes").alias("passes"), F.first("s.rest").alias("rest"))
    in_pass = Window.partitionBy("mix_source", "mix_pass").orderBy("mix_order", "mix_home")
    ordered = (
        totals.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes"))).alias("mix_pass"))
        .withColumn("mix_order", digest(F.col("mix_source"), F.col("mix_pass"), F.col("mix_home"), F.lit(seed)))
        .withColumn("mix_block", F.row_number().over(in_pass).cast("long"))
        .withColumn("through", F.sum("held").over(in_pass.rowsBetween(Window.unboundedPreceding, 0)))
    )
    partial = F.col("mix_pass") == F.col("passes")
    left = F.col("rest") - (F.col("through") - F.col("held"))
    blocks = stage(
        ordered.where(~partial | (left > 0)).select(
            "mix_source", "mix_home", "mix_pass", "mix_block",
            F.when(partial & (F.col("held") > left), left).alias("mix_left"),
        ),
        "mix-blocks",
    )
    rows = placed(docs.select(*[F.col(f"`{c}`") for c in kept], word_count(text_of()).alias("mix_tokens")))
    rows = rows.select(
        *[F.col(f"d.`{c}`") for c in kept], "d.mix_tokens", "s.mix_source", "mix_home", F.col("s.weight").alias("mix_weight"),
        digest(F.col("d.doc_id"), F.lit(seed), F.lit("row")).alias("mix_row"),
    )
    keys = blocks.select(F.col("mix_source").alias("b_source"), F.col("mix_home").alias("b_home"), "mix_pass", "mix_block", "mix_left")
    chosen = rows.join(hinted(keys, fits(keys, 128)), F.col("mix_source").eqNullSafe(F.col("b_source")) & (F.col("mix_home") == F.col("b_home")))
    chosen = chosen.withColumn("mix_key", digest(F.col("mix_row"), F.col("mix_pass")))
    # Documents of the block that only partly fits: about sqrt(n) rows of a source.
    cut = Window.partitionBy("mix_source", "mix_home").orderBy("mix_key", "doc_id", "mix_tokens").rowsBetween(Window.unboundedPreceding, 0)
    columns = [*[F.col(f"`{c}`") for c in kept], *[F.col(c) for c in own]]
    whole = chosen.where("mix_left is null").select(*columns)
    partly = chosen.where("mix_left is not null").withColumn("mix_sum", F.sum("mix_tokens").over(cut)).where("mix_sum <= mix_left").select(*columns)
    return whole.unionByName(partly)
