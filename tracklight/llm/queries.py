"""The registered queries of this package: every operator over its whole table, with SQL beside it where SQL can say it.

Parameters are the production ones; a query adds the digest columns of its contract to what the operator returns.
"""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklight.llm import checks, conversation_repair, ctw, exact_dedup, html_text, jaccard_trie, licenses, merkle, mixing, quality_crf, sentencepiece_codec, token_alignment, tool_calls, warc
from tracklight.llm.common import held_out, table, text_of
from tracklight.runtime import new_path, stage

PIECES = "piece_bpe_32k.model"
#: Ids of that vocabulary.
PIECES_SIZE = 32_000
BYTE_PAIRS = "byte_bpe_50k.json"


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode_decode(docs, public_tokenizers.path(PIECES))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page; weights learned from the pages that mark their article."""
    found = html_text.main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus mixed at 99.5 % of the largest entropy, as many tokens as it has, no source read over four times."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, target_entropy=0.995, max_repetition=4.0, budget_share=1.0)
    return mixed.select("doc_id", "source", "mix_pass", "mix_block", "mix_key", "mix_tokens", F.round("mix_weight", 6).alias("mix_weight"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likeness."""
    return merkle.compare_with_edited(table(spark, folder, "documents").select("doc_id", "text"))


def tool_traffic(conversations: DataFrame) -> DataFrame:
    """Conversations as tool messages: a user turn calls ``answer`` and refers to the user turn before it, the turn
    that follows is the result."""
    turn = F.col("turn").cast("string")
    arguments = F.to_json(
        F.struct(
            F.when(F.col("turn") >= 2, F.concat(F.lit("$c"), (F.col("turn") - 2).cast("string"))).alias("after"),
            text_of().alias("query"),
            F.col("turn").alias("turn"),
        )
    )
    call = F.concat(F.lit('{"tool_calls":[{"id":"c'), turn, F.lit('","name":"answer","arguments":'), arguments, F.lit("}]}"))
    result = F.to_json(F.struct(F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")).alias("tool_call_id"), text_of().alias("content")))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    return conversations.select(
        "conv_id", "turn",
        F.when(user, "assistant").when(assistant, "tool").otherwise(F.col("role")).alias("role"),
        F.when(user, call).when(assistant, result).otherwise(F.col("text")).alias("text"),
    )


# What a call of ``answer`` may hold.
ANSWER_RULES = [
    ("answer", "after", "string", False, 2.0, None),
    ("answer", "query", "string", True, 1.0, 300.0),
    ("answer", "turn", "integer", True, 0.0, None),
]


def op5_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of the conversations as linked call, orphan result or plain message."""
    rules = spark.createDataFrame(ANSWER_RULES, tool_calls.RULES)
    linked = tool_calls.link(tool_traffic(table(spark, folder, "conversations")), rules)
    return linked.select(
        "conv_id", "turn", "kind", F.array_join("errors", "; ").alias("errors"), F.array_join("depends_on", ",").alias("depends_on"),
        F.coalesce("level", F.lit(-1)).alias("level"), F.coalesce("result_turn", F.lit(-1).cast("long")).alias("result_turn"),
        F.coalesce("results", F.lit(0).cast("long")).alias("results"), F.coalesce("call_id", F.lit("")).alias("call_id"),
        F.coalesce("status", F.lit("")).alias("status"), "json",
    )


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from labels of rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labelled = table(spark, folder, "labels").where(~held_out(5)).select("doc_id", "quality")
    scored = quality_crf.score(docs, quality_crf.fit(docs, labelled))
    return scored.select(
        "doc_id", held_out(5).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"), "n_lines", "n_good_lines"
    )


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licence statements in the lines, blocks and whole texts of all documents."""
    return licenses.scan(table(spark, folder, "documents"))


def op8_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    """log10 probability of every document under a byte context tree and under word counts."""
    scored = ctw.score(table(spark, folder, "documents").select("doc_id", "text"), ~held_out(10))
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents under a Jaccard coefficient of at least 0.9 over three-word shingles."""
    found = jaccard_trie.near_components(table(spark, folder, "documents").select("doc_id", "text"), 3, Fraction(9, 10))
    return found.select("doc_id", "n_shingles", "component_id", "n_links", "class_size")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the row of its text that stays."""
    found = exact_dedup.exact_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Alignment of a byte-level and a piece vocabulary on every document, with corpus-wide counts of linked ids."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    aligned = token_alignment.align(docs, public_tokenizers.path(BYTE_PAIRS), public_tokenizers.path(PIECES))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    aligned = stage(aligned.select("doc_id", *token_alignment.SIZES, digest, "pairs", "pair_links"), "aligned")
    found = token_alignment.with_corpus_counts(aligned, PIECES_SIZE)
    return found.select("doc_id", *token_alignment.SIZES, "n_best", "count_sum", "groups_sha256")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation after planted damage: its faults, the cheapest repair and the digest of the repaired lines."""
    return conversation_repair.report(table(spark, folder, "conversations"))


def op13_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a record of the archives that are written to the shared folder and read back from there."""
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    return warc.page_records(warc.read_archives(spark, path, with_payload=False))


QUERIES = {
    "op1_sentencepiece": (op1_sentencepiece, None),
    "op2_html_text": (op2_html_text, None),
    "op3_mixing": (op3_mixing, checks.MIXING),
    "op4_fingerprints": (op4_fingerprints, None),
    "op5_tool_calls": (op5_tool_calls, checks.TOOL_CALLS),
    "op6_quality": (op6_quality, None),
    "op7_licenses": (op7_licenses, checks.licenses()),
    "op8_context_tree": (op8_context_tree, None),
    "op9_jaccard_join": (op9_jaccard_join, None),
    "op10_exact_dedup": (op10_exact_dedup, checks.EXACT_DEDUP),
    "op11_token_alignment": (op11_token_alignment, None),
    "op12_conversation_repair": (op12_conversation_repair, None),
    "op13_warc": (op13_warc, checks.WARC),
}
