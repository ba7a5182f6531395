"""Session helpers: the shared work folder, staged tables and size-checked broadcasts."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
#: Rows that a task of ``by_rows`` sorts or groups, on average at most.
TASK_ROWS = 1_000_000


def work_folder(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints, as the session names it in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tracklight-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{work_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, so a lost executor costs a file read and not a recomputation, and gives
    the optimizer true sizes for the joins that follow.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Relay:
    """Two folders that hold the last two versions of a table that changes with every iteration.

    A version may be computed from the one before it; the one before that is overwritten, so an
    iteration of any length keeps two versions on disk.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.paths = [new_path(spark, label), new_path(spark, label)]
        self.turn = 0

    def write(self, df: DataFrame) -> DataFrame:
        path = self.paths[self.turn % 2]
        self.turn += 1
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast only when the measured size allows it; otherwise leave the join to the optimizer."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def by_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as its ``rows`` ask for, so that a task's memory does not grow with the table."""
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(least, math.ceil(rows / TASK_ROWS)), *keys)
