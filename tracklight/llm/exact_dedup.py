"""Exact deduplication as a stateful stream: keyed state on disk, no expiry, full bytes checked on hits.

The narrow records (digest, doc_id, locator) are written once and then read as a stream. The state of the
streaming aggregate lives in RocksDB under the shared checkpoint folder; it keeps for every digest the
stable identifier of the row that stays, the locator of its content and the number of rows, and never
drops a key. Each task adds up its own copies before the shuffle, so a digest that a third of all rows
share costs one record per task. Rows whose digest was hit are then compared byte by byte: the same
pre-aggregation runs on (digest, text), and a digest with several texts is resolved by the texts themselves.

Null text counts as empty. Rows that repeat a doc_id and a text are all listed, with the same ``keep_id``.
An empty table gives an empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklight.llm.common import ascii_lower, fits, hinted, text_of
from tracklight.runtime import new_path, stage

BATCHES = 4
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: reserving file space ahead costs more than it saves.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def keyed_state(records: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Streams (digest, doc_id, locator) through the keyed state; returns digest, keep_id, locator, members."""
    spark = records.sparkSession
    folder, checkpoint = new_path(spark, "arrivals"), new_path(spark, "dedup-state")
    records.write.parquet(folder)
    written = spark.read.schema(records.schema).parquet(folder)
    files = len(written.inputFiles())
    names = [f.name for f in records.schema.fields]
    assert names == ["digest", "doc_id", "locator"], names
    if not files or written.isEmpty():
        return written.select("digest", F.col("doc_id").alias("keep_id"), "locator", F.lit(0).cast("long").alias("members"))
    before = {key: spark.conf.get(key, None) for key in ROCKSDB}
    try:
        for key, value in ROCKSDB.items():
            spark.conf.set(key, value)
        arrivals = (
            spark.readStream.schema(records.schema).option("maxFilesPerTrigger", max(1, -(-files // batches))).parquet(folder)
        )
        state = arrivals.groupBy("digest").agg(
            F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("members")
        )
        run = (
            state.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).start()
        )
        run.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    kept = spark.read.format("statestore").load(checkpoint)
    keeper, members = (f"value.`{name}`" for name in kept.schema["value"].dataType.names)
    return kept.select(
        F.col("key.digest").alias("digest"),
        F.col(f"{keeper}.doc_id").alias("keep_id"),
        F.col(f"{keeper}.locator").alias("locator"),
        F.col(members).alias("members"),
    )


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, keep_locator.

    ``digest`` may be weak; the byte comparison separates texts that share a digest.
    """
    text = ascii_lower(text_of())
    rows = docs.select("doc_id", text.alias("body"), F.input_file_name().alias("locator"))
    digests = rows.select(digest(F.col("body")).alias("digest"), "doc_id", "locator")
    state = keyed_state(digests)
    hits = stage(state.where("members > 1"), "dedup-hits")
    small = fits(hits, 256)
    wanted = hinted(hits.select("digest"), small)

    # The byte check. Copies collapse inside each task before anything is shuffled.
    bodies = rows.select(digest(F.col("body")).alias("digest"), "doc_id", "body", "locator")
    by_body = [F.max(F.struct("doc_id", "locator")).alias("own_keeper"), F.count(F.lit(1)).alias("own_members")]
    if small:
        texts = bodies.join(wanted, "digest", "left_semi").groupBy("digest", "body").agg(F.count(F.lit(1)).alias("rows"))
    else:
        texts = bodies.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("rows")).join(wanted, "digest", "left_semi")
    collisions = stage(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "dedup-collisions")
    exact = None
    if not collisions.isEmpty():
        shared = hinted(collisions.select("digest"), fits(collisions, 64))
        exact = stage(bodies.join(shared, "digest", "left_semi").groupBy("digest", "body").agg(*by_body), "dedup-resolved")

    listed = rows.select(
        "doc_id", digest(F.col("body")).alias("digest"), F.sha2("body", 256).alias("text_sha256"), "locator",
        *(["body"] if exact is not None else []),
    )
    hit = hits.select("digest", "keep_id", "members", F.col("locator").alias("keep_locator"))
    found = listed.join(hinted(hit, small), "digest", "left")
    keep_id, size, keep_locator = F.col("keep_id"), F.col("members"), F.col("keep_locator")
    if exact is not None:
        found = found.join(exact, ["digest", "body"], "left")
        resolved = F.col("own_members").isNotNull()
        keep_id = F.when(resolved, F.col("own_keeper.doc_id")).otherwise(keep_id)
        keep_locator = F.when(resolved, F.col("own_keeper.locator")).otherwise(keep_locator)
        size = F.coalesce(F.col("own_members"), size)
    alone = F.coalesce(size, F.lit(1)) == 1
    found = found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(keep_id).alias("keep_id"),
        F.coalesce(size, F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
        F.when(alone, F.col("locator")).otherwise(keep_locator).alias("keep_locator"),
    )
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "keep_locator")
