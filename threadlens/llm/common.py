"""Columns and tables shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers some 4 MB at once instead of 10,000 rows, unless the session has its own limit."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, "4m")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """`doc_id`, `text` and the columns named in `more`; a missing text becomes the empty one, other columns go."""
    return docs.select("doc_id", *more, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def identity(*columns: str) -> Column:
    """A digest of the values of a row: rows with equal values share it, and get equal results."""
    parts = [F.concat(F.when(F.col(c).isNull(), "0").otherwise("1"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    return F.md5(F.concat_ws("\x00", *parts))


def indices(size: Column) -> Column:
    """0 to size - 1, empty for size 0."""
    return F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))


def fold(key: Column) -> Column:
    """crc32 of the key written as text, modulo 5; fold 0 is held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5, F.lit(1))


def partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
