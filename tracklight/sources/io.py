"""Reading and writing the text formats of histories, catalogues, dictionaries and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklight.schema import INTERACTIONS


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Comma CSV with a header. Without a schema every column is text, which needs no extra pass."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_tsv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated text whose types are found by a pass over the file; prefer a schema for large files."""
    return spark.read.option("header", True).option("sep", "\t").option("inferSchema", True).csv(path)


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = INTERACTIONS,
    limit: int | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Typed tab-separated text; ``limit`` keeps the first rows in the order of ``order``."""
    df = read_csv(spark, path, schema, sep="\t")
    return df if limit is None else df.orderBy(*(order or df.columns)).limit(limit)


def _escaped(key: Column) -> Column:
    """Backslash, tab and line ends as two characters; null as ``\\N``, which no escaped text equals."""
    for raw, name in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        key = F.replace(key, F.lit(raw), F.lit(name))
    return F.coalesce(key, F.lit("\\N"))


def _unescaped(text: Column) -> Column:
    """The key of ``_escaped``; an unknown escape stays as it is."""
    plain = F.transform(
        F.split(text, r"\\\\"),  # between escaped backslashes
        lambda part: F.replace(
            F.replace(F.replace(part, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")
        ),
    )
    return F.when(text != "\\N", F.array_join(plain, "\\"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(key, idx)`` of lines ``key<TAB> idx``: split at the last tab, nothing is quoted or trimmed in the key.

    An index that is no number is null.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    last = F.regexp_extract("value", r"\t([^\t]*)$", 1)
    key = F.regexp_extract("value", r"^(.*)\t[^\t]*$", 1)
    return lines.select(_unescaped(key).alias("key"), F.trim(last).try_cast("int").alias("idx"))


def read_dictionary_reverse(spark: SparkSession, path: str) -> DataFrame:
    return read_dictionary(spark, path).select("idx", "key")


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    text = F.concat(_escaped(F.col("key")), F.lit("\t "), F.col("idx").cast("string"))
    dictionary.select(text.alias("line")).write.option("lineSep", "\n").text(path)


def write_tsv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.option("sep", "\t").option("header", True).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """One CSV file: a summary has a row per algorithm and K."""
    df.coalesce(1).write.option("header", True).csv(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> tuple[list[str], DataFrame]:
    """Column names and the first rows by ``order`` (all columns if not given)."""
    return df.columns, df.orderBy(*(order or df.columns)).limit(n)


def literal_ratings(spark: SparkSession, rows: list[list[float]]) -> DataFrame:
    """A small dense matrix as ``(user, item, rating)`` rows; zeros are missing cells."""
    cells = [(u, i, float(r)) for u, row in enumerate(rows) for i, r in enumerate(row) if r > 0]
    return spark.createDataFrame(cells, "user_id int, track_id int, rating double")
