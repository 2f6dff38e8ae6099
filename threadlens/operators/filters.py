"""Row filters beyond ingest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.buckets import nonzero
from threadlens.functions.text import alternation, word_count
from threadlens.session import written

MAX_WORDS = 512
MIN_GROUP_ROWS = 40


def mentions_any(df: DataFrame, terms: Sequence[str], column: str = "body") -> DataFrame:
    """Rows whose text contains one of the terms, case ignored; rows without text are dropped."""
    return df.where(F.coalesce(F.col(column).rlike(alternation(terms)), F.lit(False)))


def drop_long_texts(df: DataFrame, column: str = "body", max_words: int = MAX_WORDS) -> DataFrame:
    return df.where(word_count(column) <= max_words)


def strong_scores(df: DataFrame, column: str, threshold: float = 0.2, strict: bool = False, flag: str | None = None) -> DataFrame:
    """Rows with |score| at or (strict) above the threshold, and the boolean flag set when one is named."""
    size = F.abs(F.col(column))
    keep = size > threshold if strict else size >= threshold
    return df.where(keep & F.col(flag) if flag else keep)


def drop_zero(df: DataFrame, column: str = "shifted") -> DataFrame:
    """Drop rows whose value is exactly zero; rows without a value stay."""
    return df.where(nonzero(column))


def large_groups(df: DataFrame, column: str = "subreddit", more_than: int = MIN_GROUP_ROWS) -> DataFrame:
    """Rows of groups with more than `more_than` rows; rows without a group are dropped.

    Counting first and joining the surviving keys back keeps the rows themselves out of any shuffle on the
    group, which a window count would need.
    """
    kept = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > more_than)
        .select(column)
    )
    return df.join(written(kept, "groups"), column, "left_semi")


def week_range(df: DataFrame, centre: int, width: int, column: str = "week") -> DataFrame:
    return df.where(F.col(column).between(centre - width, centre + width))


def misclassified(df: DataFrame, truth: str = "truth", prediction: str = "prediction") -> DataFrame:
    return df.where(F.col(truth) != F.col(prediction))
