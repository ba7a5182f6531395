"""Corpus pipeline: quality, exact dedup, near dedup, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps with their columns; the last one adds
ids. Stages are written as Parquet and read again before the next one starts. Rows whose doc_id is null are judged like
others by quality and exact dedup, and kept by near dedup.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklight.llm import exact_dedup, jaccard_trie, mixing, quality_crf, sentencepiece_codec
from tracklight.llm.common import ascii_lower, fits, held_out, hinted, small_batches, table, text_of
from tracklight.runtime import stage


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the line classifier gives less than 0.3."""
    small_batches(spark)
    labelled = table(spark, sf_dir, "labels").where(~held_out(5)).select("doc_id", "quality")
    scored = quality_crf.score(docs, quality_crf.fit(docs, labelled))
    return scored.where("quality_score >= 0.3").select(*_columns(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of equal texts, the row with the largest doc_id, and one of rows that repeat it."""
    found = stage(exact_dedup.exact_duplicates(docs), "pipeline-exact")
    dropped = found.where("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha"))
    keyed = docs.withColumn("own_sha", F.sha2(ascii_lower(text_of()), 256))
    same = F.col("gone_id").eqNullSafe(F.col("doc_id")) & (F.col("gone_sha") == F.col("own_sha"))
    left = keyed.join(hinted(dropped, fits(dropped, 128)), same, "left_anti")
    repeated = stage(found.where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "pipeline-repeated")
    if not repeated.isEmpty():
        again = repeated.select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_sha"))
        again = hinted(again, fits(again, 128))
        left = left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates(["doc_id", "own_sha"]))
    return left.select(*_columns(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, with the smallest doc_id, of each group linked by 0.8 or more over five-word shingles.

    Rows that repeat a doc_id are judged by their own sets of shingles: of the sets that a group's smallest doc_id has in it, the
    least class stays, once; a set outside the group stays too.
    """
    small_batches(spark)
    found = stage(jaccard_trie.near_components(docs, 5, Fraction(8, 10), counted=False), "pipeline-near").where("class is not null")
    first = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias("first_id")).agg(F.min("class").alias("first_class"), F.count_distinct("class").alias("sets"))
    several = stage(first.where("sets > 1").drop("sets"), "pipeline-several")
    gone = found.join(hinted(several, fits(several, 32)), F.col("doc_id") == F.col("first_id"), "left")
    gone = gone.where("doc_id <> component_id or class <> first_class").select(F.col("doc_id").alias("gone_id"), F.col("class").alias("gone_class"))
    gone = stage(gone.distinct(), "pipeline-gone")
    again = stage(docs.groupBy(F.col("doc_id").alias("again_id")).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows"), "pipeline-again")
    repeated, small = F.col("doc_id") == F.col("again_id"), fits(again, 16)
    left = docs.join(hinted(gone, fits(gone, 24)), F.col("doc_id") == F.col("gone_id"), "left_anti")
    if not again.isEmpty():
        rows = jaccard_trie.with_class(docs.join(hinted(again, small), repeated, "left_semi"), 5).dropDuplicates(["doc_id", "own_class"])
        kept = rows.join(gone, (F.col("doc_id") == F.col("gone_id")) & F.col("own_class").eqNullSafe(F.col("gone_class")), "left_anti")
        left = left.join(hinted(again, small), repeated, "left_anti").unionByName(kept.select(*_columns(docs)))
    return left.select(*_columns(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources at 98 % of the largest entropy; every document is read at least once, none over twice."""
    return mixing.mix(docs, target_entropy=0.98, max_repetition=2.0).select(*_columns(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether decoding gives the text again."""
    small_batches(spark)
    coded = sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == text_of()).alias("lossless"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixture", mixture), ("tokens", tokens)]

#: The classifier and the joins are not expressible in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
