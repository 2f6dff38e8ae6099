"""Sinks. Each overwrites its target folder and lets the executors write in parallel."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sized(df: DataFrame, files: int | None) -> DataFrame:
    return df.coalesce(files) if files else df


def write_parquet(df: DataFrame, path: str, files: int | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet; give `files` only for results known to be small, since it also limits the last stage's tasks."""
    writer = _sized(df, files).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json_gzip(df: DataFrame, path: str, files: int | None = None) -> None:
    _sized(df, files).write.mode("overwrite").option("ignoreNullFields", "true").json(path, compression="gzip")


def write_csv(df: DataFrame, path: str, header: bool = True, files: int | None = None) -> None:
    """CSV with doubled quotes inside fields, readable by `read_csv`."""
    (
        _sized(df, files)
        .write.mode("overwrite")
        .option("header", str(header).lower())
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def header_pairs(df: DataFrame) -> list[tuple[str, str]]:
    """Both names of every flat column: a struct's with its field's, a plain column's with an empty one."""
    out = []
    for field in df.schema.fields:
        out += [(field.name, part.name) for part in field.dataType.fields] if isinstance(field.dataType, T.StructType) else [(field.name, "")]
    return out


def write_two_row_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with two header rows in every file, the names of columns and those of their fields; `read_two_row_csv` reads it.

    Struct columns become one column for each field. Files are written in parallel. Strings keep their spaces, and quotes
    inside them are doubled; a null is an empty field, an empty string is quoted.
    """
    pairs = header_pairs(df)
    flat = [F.col(f"`{a}`.`{b}`" if b else f"`{a}`").alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    options = {"quote": '"', "escape": '"', "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    heads = [",".join('"' + name.replace('"', '""') + '"' if set(name) & set(',"\n\r') else name for name in names) for names in zip(*pairs)]

    def with_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(heads)], ["value"])
        yield from batches

    lines = df.select(F.to_csv(F.struct(*flat), options).alias("value"))
    _sized(lines, files).mapInArrow(with_heads, "value string").write.mode("overwrite").text(path)
