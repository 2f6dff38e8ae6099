"""From raw comments and submissions to one activity table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.hashing import order_key
from threadlens.functions.text import concat_strict
from threadlens.operators.ranking import top_per_group
from threadlens.sources.readers import read_json

# Communities about the election, removal markers, deleted-account name, rows kept per community.
ELECTION_COMMUNITIES = (
    "politics", "uspolitics", "democrats", "Republican", "immigration", "Libertarian", "Conservative", "Economics",
    "PoliticalDiscussion", "Liberal", "guns", "NeutralPolitics", "Firearms", "AmericanPolitics", "Law", "healthcare",
    "environment", "guncontrol", "prochoice", "The_Donald",
)
REMOVAL_MARKERS = ("[deleted]", "[removed]")
DELETED_AUTHOR = "[deleted]"
ROWS_PER_COMMUNITY = 2000


def in_set(c: str, values: Sequence) -> Column:
    return F.col(c).isin(list(values))


def drop_removed(df: DataFrame, column: str = "body", markers: Sequence[str] = REMOVAL_MARKERS) -> DataFrame:
    """Drop rows whose text holds a removal marker anywhere, and rows without text; no-op without the column."""
    if column not in df.columns:
        return df
    return df.where(~F.col(column).rlike("|".join(re.escape(m) for m in markers)))


def drop_author(df: DataFrame, author: str = DELETED_AUTHOR, column: str = "author") -> DataFrame:
    return df.where(F.col(column) != author)


def stratified_cap(
    df: DataFrame,
    cap: int = ROWS_PER_COMMUNITY,
    community: str = "subreddit",
    key: str = "id",
    seed: int = 42,
) -> DataFrame:
    """At most `cap` rows per community in seeded hash order of the key: repeatable without caching."""
    picked = top_per_group(
        df.withColumn("_order", order_key(key, seed)), [community], [F.col("_order"), F.col(key)], cap
    )
    return picked.drop("_order")


def load_filtered(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    communities: Sequence[str] = ELECTION_COMMUNITIES,
    year: int = 2016,
    cap: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """JSON scan, community and year filter, removal filter, then the cap, if one is named."""
    rows = drop_removed(
        read_json(spark, path, schema).where(in_set("subreddit", communities) & (F.col("year") == year))
    )
    return rows if cap is None else stratified_cap(rows, cap, seed=seed)


def distinct_authors(*tables: DataFrame, column: str = "author", deleted: str = DELETED_AUTHOR) -> DataFrame:
    """Distinct authors over the bag union of the tables, without the deleted-account name."""
    keys = tables[0].select(column)
    for table in tables[1:]:
        keys = keys.union(table.select(column))
    return drop_author(keys.distinct(), deleted, column)


def keep_authors(df: DataFrame, authors: DataFrame, column: str = "author") -> DataFrame:
    """Rows of the given authors; the planner broadcasts the keys when their size allows it."""
    return df.join(authors.select(column), column, "left_semi")


def refine_submissions(df: DataFrame) -> DataFrame:
    """Submissions in the comments' layout, title and text as one body."""
    return df.withColumn("body", concat_strict("title", "selftext")).drop("title", "selftext")


def combine_activity(comments: DataFrame, submissions: DataFrame) -> DataFrame:
    """Comments and refined submissions of the authors seen in either, by column name.

    Each row's author is in that author set unless it is missing or the deleted-account name, so the
    semi-join with the set reduces to a filter and needs no shuffle.
    """
    return drop_author(comments).unionByName(drop_author(refine_submissions(submissions)), allowMissingColumns=True)


def concat_frames(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
