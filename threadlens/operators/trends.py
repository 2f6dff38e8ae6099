"""Activity over weeks and around dated milestones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.functions.times import weeks_between, weeks_to
from threadlens.operators.aggregates import group_sizes
from threadlens.session import local_table

NO_EVENT = "No Event"
MILESTONE_WEEKS = T.StructType(
    [T.StructField("place", T.IntegerType()), T.StructField("event", T.StringType()), T.StructField("event_week", T.LongType())]
)


def milestone_weeks(spark: SparkSession, anchor: dt.date, milestones: Sequence[tuple[str, dt.date]]) -> DataFrame:
    """Milestones in date order with their week before the anchor: (place, event, event_week)."""
    ordered = sorted(milestones, key=lambda m: m[1])
    rows = [(i, name, weeks_between(anchor, day)) for i, (name, day) in enumerate(ordered)]
    return local_table(spark, rows, MILESTONE_WEEKS)


def with_week(df: DataFrame, anchor: dt.date, created: str = "created_ts", week: str = "week") -> DataFrame:
    return df.withColumn(week, weeks_to(anchor, created))


def window_weeks(milestones: DataFrame, window: int) -> DataFrame:
    """One row per milestone and week inside its window, which turns the interval join into an equi-join."""
    return milestones.withColumn(
        "week", F.explode(F.sequence(F.col("event_week") - window, F.col("event_week") + window))
    )


def label_events(df: DataFrame, milestones: DataFrame, window: int = 2, week: str = "week", label: str = "event") -> DataFrame:
    """Label each row with the earliest milestone whose window holds its week, else 'No Event'."""
    first = (
        window_weeks(milestones, window)
        .groupBy("week")
        .agg(F.min_by("event", "place").alias("_event"))
        .withColumnRenamed("week", week)
    )
    # One row per week near a milestone; the planner broadcasts it by its size.
    return (
        df.join(first, week, "left")
        .withColumn(label, F.coalesce("_event", F.lit(NO_EVENT)))
        .drop("_event")
    )


def activity_by_week(df: DataFrame, community: str = "subreddit", week: str = "week") -> DataFrame:
    return group_sizes(df, [community, week])


def activity_by_event(df: DataFrame, community: str = "subreddit", label: str = "event") -> DataFrame:
    return group_sizes(df, [label, community])


def event_window_metrics(
    df: DataFrame, milestones: DataFrame, window: int = 2, community: str = "subreddit", week: str = "week"
) -> DataFrame:
    """Per milestone: rows inside its window (windows may overlap) and their ratio to the mean community size.

    Rows are counted per (community, week) once; windows then join those counts, not the rows.
    """
    counts = group_sizes(df.where(F.col(community).isNotNull()), [community, week], "_n")
    mean_size = (
        counts.groupBy(community).agg(F.sum("_n").alias("_size")).agg(F.avg("_size").alias("m")).select("m").scalar()
    )
    per_week = counts.groupBy(week).agg(F.sum("_n").alias("_n")).withColumnRenamed(week, "week")
    totals = (
        window_weeks(milestones, window)
        .join(per_week, "week", "left")
        .groupBy("place", "event")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_activity"))
    )
    ratio = F.when(mean_size > 0, F.col("total_activity") / mean_size).otherwise(F.lit(0.0))
    return totals.select("event", "total_activity", ratio.alias("activity_ratio"))


def linear_trend(df: DataFrame, x: str = "week", y: str = "post_count") -> DataFrame:
    """Least-squares slope and intercept of y on x, one row."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def fitted_trend(df: DataFrame, x: str = "week", y: str = "post_count") -> DataFrame:
    """The points with the fitted value of the linear trend."""
    trend = linear_trend(df, x, y)
    slope, intercept = trend.select("slope").scalar(), trend.select("intercept").scalar()
    return df.withColumn("fitted", intercept + slope * F.col(x))


def activity_timeline(df: DataFrame, milestones: DataFrame, community: str = "subreddit", week: str = "week") -> DataFrame:
    """Long table behind the timeline chart: a count per community and week, and a marker row per milestone."""
    series = activity_by_week(df, community, week).select(
        F.lit("activity").alias("kind"), F.col(community).alias("name"), F.col(week).alias("week"), "post_count"
    )
    markers = milestones.select(
        F.lit("milestone").alias("kind"), F.col("event").alias("name"), F.col("event_week").alias("week"),
        F.lit(None).cast("bigint").alias("post_count"),
    )
    return series.unionByName(markers)
