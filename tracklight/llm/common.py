"""What several operators of this package need: held-out rows, broadcasts behind a size check, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklight.runtime import BROADCAST_BYTES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of rows that the JVM hands to Python at a time. Spark's 64 MB are held several times over, in the JVM's growing buffers,
#: which its pools keep, and in the worker.
BATCH_BYTES = 4 << 20


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z and leaves every other letter as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def held_out(modulus: int, column: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text leaves no remainder. A null id is never held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == 0, F.lit(False))


def fits(df: DataFrame, row_bytes: int) -> bool:
    """Whether the counted rows of a written table may be broadcast."""
    return df.count() * row_bytes <= BROADCAST_BYTES


def hinted(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def small_batches(spark) -> None:
    """Arrow batches of ``BATCH_BYTES`` for the Python tasks of this session, unless the session names a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Hands freed memory of Arrow and of the C library back to the system, since Python workers live on between tasks. What
    earlier tasks leave behind are cycles of functions and their globals, which a collection frees."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def held(*key, make: Callable[[], object]) -> object:
    """A table that this Python worker keeps for the tasks that follow.

    Functions travel with their tasks, and so do the globals of this package, so the table lies in a module of its own that
    outlives a task. The first task that asks for another table drops the one before.
    """
    tables = vars(sys.modules.setdefault("tracklight_worker_tables", types.ModuleType("tracklight_worker_tables"))).setdefault("tables", {})
    if key not in tables:
        tables.clear()
        give_back()
        tables[key] = make()
    return tables[key]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with at most ``most_bytes`` of text, or a single row that is longer than that."""
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist()
    begin, held = 0, 0
    for row, length in enumerate(lengths):
        held += length or 0
        if held > most_bytes and row > begin:
            yield batch.slice(begin, row - begin)
            begin, held = row, length or 0
    if batch.num_rows > begin:
        yield batch.slice(begin)
