"""Queries over weeks and milestones."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.operators import filters, trends
from threadlens.operators.smoothing import lowess
from threadlens.plans import datasets as ds
from threadlens.plans.registry import query

WINDOW = 1
_WEEK = "CAST(floor(floor((epoch_us(TIMESTAMP '2024-01-20') - epoch_us(created_ts)) / 86400000000.0) / 7) AS BIGINT)"
WEEKLY = f"SELECT *, {_WEEK} AS week FROM ({ds.EVENT_ACTIVITY})"
LABELLED = f"""SELECT *, coalesce((SELECT arg_min(event, place) FROM {ds.MILESTONE_ROWS}
    WHERE abs(w.week - event_week) <= {WINDOW}), 'No Event') AS event FROM ({WEEKLY}) w"""
BY_WEEK = f"SELECT subreddit, week, count(*) AS post_count FROM ({WEEKLY}) GROUP BY ALL"
OVERALL = f"SELECT week, count(*) AS post_count FROM ({WEEKLY}) GROUP BY ALL"


def weekly(spark, sf_dir):
    return trends.with_week(ds.event_activity(spark, sf_dir), ds.ANCHOR)


def labelled(spark, sf_dir):
    return trends.label_events(weekly(spark, sf_dir), ds.milestones(spark), WINDOW)


@query("weeks_to_anchor", f"SELECT id, week FROM ({WEEKLY})")
def weeks_to_anchor(spark, sf_dir):
    return weekly(spark, sf_dir).select("id", "week")


@query("event_labels", f"SELECT id, week, event FROM ({LABELLED})")
def event_labels(spark, sf_dir):
    return labelled(spark, sf_dir).select("id", "week", "event")


@query("activity_by_week", BY_WEEK)
def activity_by_week(spark, sf_dir):
    return trends.activity_by_week(weekly(spark, sf_dir))


@query("activity_by_event", f"SELECT event, subreddit, count(*) AS post_count FROM ({LABELLED}) GROUP BY ALL")
def activity_by_event(spark, sf_dir):
    return trends.activity_by_event(labelled(spark, sf_dir))


@query("window_week_range", f"SELECT id, week FROM ({WEEKLY}) WHERE week BETWEEN 0 AND 2")
def window_week_range(spark, sf_dir):
    return filters.week_range(weekly(spark, sf_dir), 1, WINDOW).select("id", "week")


@query(
    "event_window_metrics",
    f"""WITH w AS ({WEEKLY}), s AS (SELECT avg(n) AS m FROM (SELECT count(*) AS n FROM w GROUP BY subreddit))
    SELECT event, total_activity, round(total_activity / m, 8) AS activity_ratio FROM (SELECT event,
    (SELECT count(*) FROM w WHERE w.week BETWEEN event_week - {WINDOW} AND event_week + {WINDOW}) AS total_activity
    FROM {ds.MILESTONE_ROWS}), s""",
)
def event_window_metrics(spark, sf_dir):
    out = trends.event_window_metrics(weekly(spark, sf_dir), ds.milestones(spark), WINDOW)
    return out.withColumn("activity_ratio", F.round("activity_ratio", 8))


@query(
    "trend_regression",
    f"SELECT round(regr_slope(post_count, week), 6) AS slope, round(regr_intercept(post_count, week), 6) AS intercept FROM ({OVERALL})",
)
def trend_regression(spark, sf_dir):
    weeks = trends.group_sizes(weekly(spark, sf_dir), ["week"])
    return trends.linear_trend(weeks).select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


@query(
    "trend_fitted",
    f"""WITH o AS ({OVERALL}), r AS (SELECT regr_slope(post_count, week) AS b, regr_intercept(post_count, week) AS a FROM o)
    SELECT week, post_count, round(a + b * week, 6) AS fitted FROM o, r""",
)
def trend_fitted(spark, sf_dir):
    weeks = trends.group_sizes(weekly(spark, sf_dir), ["week"])
    return trends.fitted_trend(weeks).withColumn("fitted", F.round("fitted", 6))


@query(
    "activity_timeline",
    f"""SELECT 'activity' AS kind, subreddit AS name, week, post_count FROM ({BY_WEEK})
    UNION ALL SELECT 'milestone', event, CAST(event_week AS BIGINT), NULL FROM {ds.MILESTONE_ROWS}""",
)
def activity_timeline(spark, sf_dir):
    return trends.activity_timeline(weekly(spark, sf_dir), ds.milestones(spark))


@query("lowess_by_community")
def lowess_by_community(spark, sf_dir):
    return lowess(trends.activity_by_week(weekly(spark, sf_dir)))


_DAYS = "SELECT subreddit AS g, CAST(datediff('day', DATE '2024-01-20', CAST(created_ts AS DATE)) AS INT) AS x, count(*) AS y FROM ({}) GROUP BY ALL"


@query(
    "lowess_by_day",
    f"""WITH p AS ({_DAYS.format(ds.EVENT_ACTIVITY)}), n AS (SELECT g, greatest(CAST(floor(0.2 * count(*) + 1e-10) AS INT), 2) AS k FROM p GROUP BY 1),
    pairs AS (SELECT a.g, a.x, b.x - a.x AS d, b.y, k, row_number() OVER (PARTITION BY a.g, a.x ORDER BY abs(b.x - a.x)) AS place FROM p a JOIN p b ON a.g = b.g JOIN n ON n.g = a.g),
    reach AS (SELECT g, x, abs(d) AS far FROM pairs WHERE place = k),
    w AS (SELECT g, x, d, y, pow(1 - pow(abs(d) / far, 3), 3) AS w FROM pairs JOIN reach USING (g, x) WHERE abs(d) < far),
    s AS (SELECT g, x, sum(w) AS t, sum(w * d) / sum(w) AS md, sum(w * y) / sum(w) AS my, sum(w * d * d) AS dd, sum(w * d * y) AS dy FROM w GROUP BY ALL)
    SELECT g AS subreddit, x AS day, round(my - CASE WHEN dd - t * md * md > 1e-12 THEN (dy - t * md * my) / (dd - t * md * md) ELSE 0 END * md, 6) AS smoothed FROM s""",
)
def lowess_by_day(spark, sf_dir):
    """Daily counts of every community, smoothed without robustness passes."""
    day = F.date_diff(F.to_date("created_ts"), F.lit(ds.ANCHOR)).alias("day")
    daily = ds.event_activity(spark, sf_dir).groupBy("subreddit", day).agg(F.count("*").alias("post_count"))
    return lowess(daily, x="day", passes=0).withColumn("smoothed", F.round("smoothed", 6))
