"""Scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.buckets import nan_to_null


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """JSON lines (plain or compressed), only the fields of `schema`."""
    return spark.read.schema(schema).json(path if isinstance(path, str) else list(path))


def read_parquet(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, merge_schema: bool = False
) -> DataFrame:
    """One file, a folder, or many of either as one table; NaN becomes NULL."""
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return clear_nan(reader.parquet(*([paths] if isinstance(paths, str) else paths)))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    header: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV whose quoted fields may hold newlines and doubled quotes; `columns` prunes the scan.

    Multi-line files are not splittable, so large CSV input should come as many files, or, where no field holds a newline,
    be read with `multi_line=False`, which splits files.
    """
    df = (
        spark.read.schema(schema)
        .option("header", str(header).lower())
        .option("multiLine", str(multi_line).lower())
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path if isinstance(path, str) else list(path))
    )
    return clear_nan(df.select(*columns) if columns else df)


def read_two_row_csv(spark: SparkSession, path: str | Sequence[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """CSV files with two header rows, the names of columns and those of their fields: columns of one name become a struct.

    Columns without a second name are strings and fields doubles, unless `kinds` names the type of a column ("name") or
    field ("name.field"). Every file starts with the same two rows; they are taken from the first.
    """
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    paths, kinds = path if isinstance(path, str) else list(path), kinds or {}
    first, second = spark.read.options(**options).csv(paths).limit(2).collect()
    pairs = [(a, b or "") for a, b in zip(first, second)]
    names = [f"c{i}" for i in range(len(pairs))]
    rows = spark.read.options(**options, header="true", enforceSchema="true").schema(", ".join(f"{n} string" for n in names)).csv(paths)
    is_head = reduce(and_, (F.coalesce(F.col(n), F.lit("")) == b for n, (_, b) in zip(names, pairs)))
    rows = rows.where(~is_head) if any(b for _, b in pairs) else rows
    columns: dict[str, list[Column] | Column] = {}
    for n, (a, b) in zip(names, pairs):
        if b:
            columns.setdefault(a, []).append(F.col(n).cast(kinds.get(f"{a}.{b}", "double")).alias(b))
        else:
            columns[a] = F.col(n).cast(kinds.get(a, "string"))
    return clear_nan(rows.select(*[(F.struct(*c) if isinstance(c, list) else c).alias(a) for a, c in columns.items()]))


def clear_nan(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, so that one missing-value rule holds downstream."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floating}) if floating else df
