"""Queries for projections, predicates, buckets, group summaries and pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import buckets, times
from threadlens.functions.text import normalise_author, spaced
from threadlens.operators import aggregates, filters
from threadlens.operators.aggregates import share_percent
from threadlens.operators.models import clustering
from threadlens.operators.models.features import standardise_columns
from threadlens.plans import datasets as ds
from threadlens.plans import workflows
from threadlens.plans.registry import query

_CATEGORY = """CASE WHEN {x} < -10 THEN 'very_negative' WHEN {x} < 0 THEN 'slightly_negative' WHEN {x} = 0 THEN 'neutral'
    WHEN {x} > 0 AND {x} <= 10 THEN 'slightly_positive' ELSE 'very_positive' END"""
_CODE = """CASE WHEN {x} < -10 THEN 1 WHEN {x} < 0 THEN 2 WHEN {x} = 0 THEN 3 WHEN {x} > 0 AND {x} <= 10 THEN 4 ELSE 5 END"""
_LEANING = "CASE WHEN {x} > 0 THEN 'Republican' WHEN {x} < 0 THEN 'Democratic' ELSE 'Neutral' END"


def _centred(spark, sf_dir):
    return ds.scored_events(spark, sf_dir).withColumn("score", F.col("score") - 50)


CENTRED = f"SELECT * REPLACE (score - 50 AS score) FROM ({ds.SCORED_EVENTS})"


@query(
    "engagement_by_leaning",
    f"""SELECT {_LEANING.format(x='shifted')} AS political_leaning, round(avg(score), 6) AS score_mean,
    round(sum(score), 4) AS score_sum, max(score) AS score_max FROM
    (SELECT author, avg(shifted) AS shifted, avg(score) AS score FROM ({ds.SCORED_EVENTS})
     WHERE author <> '[deleted]' GROUP BY ALL) GROUP BY 1""",
)
def engagement_by_leaning(spark, sf_dir):
    return workflows.engagement_by_leaning(spark, sf_dir).select(
        "political_leaning", F.round("score_mean", 6).alias("score_mean"), F.round("score_sum", 4).alias("score_sum"), "score_max"
    )


@query(
    "leaning_engagement",
    f"""SELECT {_LEANING.format(x='sentiment')} AS political_leaning, round(avg(score), 6) AS score_mean,
    round(sum(score), 4) AS score_sum, max(score) AS score_max FROM ({ds.SCORED_EVENTS}) GROUP BY 1""",
)
def leaning_engagement(spark, sf_dir):
    rows = ds.scored_events(spark, sf_dir).withColumn("political_leaning", buckets.leaning("sentiment"))
    return aggregates.score_summary(rows, "political_leaning").select(
        "political_leaning", F.round("score_mean", 6).alias("score_mean"), F.round("score_sum", 4).alias("score_sum"), "score_max"
    )


@query(
    "score_bucket_counts",
    f"""SELECT {_CATEGORY.format(x='score')} AS score_category, {_CODE.format(x='score')} AS score_code,
    CASE WHEN sentiment >= 0 THEN 'positive' ELSE 'negative' END AS sentiment_category, count(*) AS n FROM ({CENTRED}) GROUP BY ALL""",
)
def score_bucket_counts(spark, sf_dir):
    return (
        _centred(spark, sf_dir)
        .groupBy(
            buckets.score_category("score").alias("score_category"), buckets.score_code("score").alias("score_code"),
            buckets.sentiment_category("sentiment").alias("sentiment_category"),
        )
        .agg(F.count("*").alias("n"))
    )


@query("score_cap", f"SELECT id, score FROM ({ds.EVENT_ACTIVITY}) WHERE score < 400")
def score_cap(spark, sf_dir):
    return ds.event_activity(spark, sf_dir).where(F.col("score") < 400).select("id", "score")


@query(
    "strong_scores",
    f"SELECT id, sentiment FROM ({ds.SCORED_EVENTS}) WHERE abs(sentiment) >= 0.2 AND subreddit IN ('click', 'purchase')",
)
def strong_scores(spark, sf_dir):
    rows = ds.scored_events(spark, sf_dir).withColumn("politician_mentioned", F.col("subreddit").isin("click", "purchase"))
    return filters.strong_scores(rows, "sentiment", 0.2, flag="politician_mentioned").select("id", "sentiment")


@query(
    "strong_author_means",
    f"""SELECT author, round(sentiment, 8) AS sentiment FROM (SELECT author, avg(sentiment) AS sentiment
    FROM ({ds.SCORED_EVENTS}) GROUP BY ALL) WHERE abs(sentiment) > 0.05""",
)
def strong_author_means(spark, sf_dir):
    """Means per author; the threshold is lower than the usual 0.2, which no author of the test tables reaches."""
    means = aggregates.group_means(ds.scored_events(spark, sf_dir), ["author"], ["sentiment"])
    kept = filters.strong_scores(means, "sentiment", 0.05, strict=True)
    return kept.withColumn("sentiment", F.round("sentiment", 8))


_GAPS = f"""SELECT e.id, e.subreddit, l.quality * e.shifted AS shifted, e.sentiment FROM ({ds.SCORED_EVENTS}) e
    LEFT JOIN labels l ON l.doc_id = e.id"""


def _with_gaps(spark, sf_dir):
    """Scores that are zero or missing for many rows, by way of the label table."""
    labels = ds.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    return ds.scored_events(spark, sf_dir).join(labels, "id", "left").withColumn("shifted", F.col("quality") * F.col("shifted"))


@query("nonzero_shift", f"SELECT id, shifted FROM ({_GAPS}) WHERE shifted IS NULL OR shifted <> 0")
def nonzero_shift(spark, sf_dir):
    return filters.drop_zero(_with_gaps(spark, sf_dir)).select("id", "shifted")


@query(
    "pct_changed",
    f"""SELECT subreddit, round(avg(CASE WHEN coalesce(shifted = sentiment, false) THEN 0.0::DOUBLE ELSE 1 END) * 100, 6) AS pct_changed,
    round(avg(CASE WHEN coalesce(shifted = sentiment, false) THEN 1.0::DOUBLE ELSE 0 END) * 100, 6) AS pct_same
    FROM ({_GAPS}) GROUP BY 1""",
)
def pct_changed(spark, sf_dir):
    return _with_gaps(spark, sf_dir).groupBy("subreddit").agg(
        F.round(share_percent(buckets.differs("shifted", "sentiment")), 6).alias("pct_changed"),
        F.round(share_percent(buckets.same("shifted", "sentiment")), 6).alias("pct_same"),
    )


@query(
    "flagged_rows",
    f"SELECT id, subreddit FROM ({ds.SCORED_EVENTS}) WHERE shifted <> sentiment",
)
def flagged_rows(spark, sf_dir):
    rows = ds.scored_events(spark, sf_dir).withColumn("flag", F.col("shifted") != F.col("sentiment"))
    return rows.where("flag").select("id", "subreddit")


@query(
    "group_size_filter",
    f"""SELECT id, author, score FROM ({ds.EVENT_ACTIVITY})
    WHERE author IN (SELECT author FROM ({ds.EVENT_ACTIVITY}) GROUP BY author HAVING count(*) > 66)""",
)
def group_size_filter(spark, sf_dir):
    return filters.large_groups(ds.event_activity(spark, sf_dir), "author", 66).select("id", "author", "score")


@query("value_counts", f"SELECT author, count(*) AS n FROM ({ds.EVENT_ACTIVITY}) GROUP BY 1")
def value_counts(spark, sf_dir):
    return aggregates.value_counts(ds.event_activity(spark, sf_dir), "author")


@query(
    "author_means",
    f"""SELECT author, round(avg(shifted), 8) AS shifted, round(avg(score), 6) AS score FROM ({ds.SCORED_EVENTS})
    WHERE author <> '[deleted]' GROUP BY 1""",
)
def author_means(spark, sf_dir):
    rows = ds.scored_events(spark, sf_dir).where(F.col("author") != "[deleted]")
    means = aggregates.group_means(rows, ["author"], ["shifted", "score"])
    return means.select("author", F.round("shifted", 8).alias("shifted"), F.round("score", 6).alias("score"))


@query(
    "top_communities",
    f"SELECT author, round(avg(shifted), 8) AS shifted FROM ({ds.SCORED_EVENTS}) GROUP BY 1 ORDER BY avg(shifted) DESC, author LIMIT 10",
)
def top_communities(spark, sf_dir):
    best = aggregates.ranked_means(ds.scored_events(spark, sf_dir), "author", "shifted", 10)
    return best.withColumn("shifted", F.round("shifted", 8))


@query(
    "sentiment_features",
    f"""SELECT author, round(avg(sentiment), 8) AS sentiment_mean, min(sentiment) AS sentiment_min, max(sentiment) AS sentiment_max
    FROM ({ds.SCORED_EVENTS}) GROUP BY 1""",
)
def sentiment_features(spark, sf_dir):
    out = aggregates.sentiment_features(ds.scored_events(spark, sf_dir))
    return out.withColumn("sentiment_mean", F.round("sentiment_mean", 8))


_MODE = f"""SELECT author, hour AS most_common_hour FROM (SELECT author, hour, row_number() OVER
    (PARTITION BY author ORDER BY n DESC, hour) AS r FROM (SELECT author, CAST(hour(created_ts) AS INT) AS hour, count(*) AS n
    FROM ({ds.EVENT_ACTIVITY}) GROUP BY ALL)) WHERE r = 1"""


@query("mode_hour", _MODE)
def mode_hour(spark, sf_dir):
    return aggregates.most_common_hour(ds.event_activity(spark, sf_dir))


def _each(template: str, prefix: str) -> str:
    return ", ".join(template.format(c=c) + f' AS "{prefix}{c}"' for c in ds.EVENT_TYPES)


@query(
    "pivot_avg_score",
    f"""SELECT author, {_each("round(coalesce(avg(score) FILTER (subreddit = '{c}'), 0), 6)", 'avg_score_')}
    FROM ({ds.EVENT_ACTIVITY}) GROUP BY 1""",
)
def pivot_avg_score(spark, sf_dir):
    wide = aggregates.pivot_mean(ds.event_activity(spark, sf_dir), "author", "subreddit", "score", ds.EVENT_TYPES)
    return wide.select("author", *[F.round(c, 6).alias(c) for c in wide.columns if c != "author"])


@query(
    "pivot_counts",
    f"""SELECT author, {_each("count(*) FILTER (subreddit = '{c}')", 'subreddit_')} FROM ({ds.EVENT_ACTIVITY}) GROUP BY 1""",
)
def pivot_counts(spark, sf_dir):
    return aggregates.pivot_count(ds.event_activity(spark, sf_dir), "author", "subreddit")


@query(
    "crosstab",
    f"""SELECT CASE WHEN sentiment >= 0 THEN 'positive' ELSE 'negative' END AS sentiment_category,
    count(*) FILTER (score < -10) AS very_negative, count(*) FILTER (score >= -10 AND score < 0) AS slightly_negative,
    count(*) FILTER (score = 0) AS neutral, count(*) FILTER (score > 0 AND score <= 10) AS slightly_positive,
    count(*) FILTER (score > 10) AS very_positive FROM ({CENTRED}) WHERE subreddit = 'click' GROUP BY 1""",
)
def crosstab(spark, sf_dir):
    rows = _centred(spark, sf_dir).where(F.col("subreddit") == "click").select(
        buckets.sentiment_category("sentiment").alias("sentiment_category"), buckets.score_category("score").alias("score_category")
    )
    return aggregates.crosstab(rows, "sentiment_category", "score_category", buckets.SCORE_CATEGORIES)


@query(
    "user_aggregate_prefix_sum",
    f"""SELECT author, round(avg(sentiment), 8) AS sentiment, {_each("count(*) FILTER (subreddit = '{c}')", 'subreddit_')},
    count(id) AS post_count FROM ({ds.SCORED_EVENTS}) GROUP BY 1""",
)
def user_aggregate_prefix_sum(spark, sf_dir):
    """One-hot columns per row, then every column of the prefix summed; the text column subreddit_id is left out."""
    rows = ds.scored_events(spark, sf_dir).withColumn("subreddit_id", F.concat(F.lit("t5_"), "subreddit"))
    rows = rows.withColumns({f"subreddit_{c}": (F.col("subreddit") == c).cast("bigint") for c in ds.EVENT_TYPES})
    return aggregates.prefixed_user_totals(rows).withColumn("sentiment", F.round("sentiment", 8))


@query(
    "author_numbers",
    f"""SELECT s.*, m.most_common_hour FROM (SELECT author, round(avg(sentiment), 8) AS sentiment_mean, min(sentiment) AS sentiment_min,
    max(sentiment) AS sentiment_max, {_each("round(coalesce(avg(score) FILTER (subreddit = '{c}'), 0), 6)", 'avg_score_')},
    {_each("count(*) FILTER (subreddit = '{c}')", 'subreddit_')} FROM ({ds.SCORED_EVENTS}) GROUP BY 1) s JOIN ({_MODE}) m USING (author)""",
)
def author_numbers(spark, sf_dir):
    wide = aggregates.author_numbers(ds.scored_events(spark, sf_dir), ds.EVENT_TYPES).na.fill(0.0)
    rounded = {c: F.round(c, 6) for c in wide.columns if c.startswith("avg_score_")}
    return wide.withColumns({**rounded, "sentiment_mean": F.round("sentiment_mean", 8)})


@query(
    "joined_features",
    f"""WITH e AS ({ds.SCORED_EVENTS}), c AS ({ds.COMMENTS})
    SELECT b.author, b.comments, coalesce(round(f.sentiment_mean, 8), 0) AS sentiment_mean,
      coalesce(m.most_common_hour, 0) AS most_common_hour, coalesce(k.subreddit_click, 0) AS subreddit_click
    FROM (SELECT author, count(*) AS comments FROM c GROUP BY 1) b
    LEFT JOIN (SELECT author, avg(sentiment) AS sentiment_mean FROM e WHERE abs(sentiment) >= 0.2 GROUP BY 1) f USING (author)
    LEFT JOIN ({_MODE}) m USING (author)
    LEFT JOIN (SELECT author, count(*) FILTER (subreddit = 'click') AS subreddit_click FROM e GROUP BY 1) k USING (author)""",
)
def joined_features(spark, sf_dir):
    """A chain of left joins on the author, missing numbers as 0."""
    events = ds.scored_events(spark, sf_dir)
    base = aggregates.group_sizes(ds.comments(spark, sf_dir), ["author"], "comments")
    means = aggregates.sentiment_features(filters.strong_scores(events, "sentiment")).select("author", "sentiment_mean")
    hours = aggregates.most_common_hour(events)
    clicks = aggregates.pivot_count(events, "author", "subreddit", ["click"])
    merged = aggregates.merge_features(base, means, hours, clicks)
    return merged.withColumn("sentiment_mean", F.round("sentiment_mean", 8))


@query(
    "renamed_columns",
    f"SELECT id AS post_id, subreddit AS community, score AS ups FROM ({ds.EVENT_ACTIVITY})",
)
def renamed_columns(spark, sf_dir):
    rows = ds.event_activity(spark, sf_dir).drop("author", "created_ts", "year", "month")
    return aggregates.rename(rows, {"id": "post_id", "subreddit": "community", "score": "ups"})


@query(
    "normalised_authors",
    """SELECT lower(regexp_replace(c_name, '^\\s+|\\s+$', '', 'g')) AS author, replace(lower(c_mktsegment), '_', ' ') AS segment,
    c_custkey AS id FROM customer""",
)
def normalised_authors(spark, sf_dir):
    rows = ds.table(spark, sf_dir, "customer")
    return rows.select(
        normalise_author("c_name").alias("author"), spaced(F.lower("c_mktsegment")).alias("segment"), F.col("c_custkey").alias("id")
    )


@query(
    "time_parts",
    f"""SELECT id, CAST(hour(created_ts) AS INT) AS hour, CAST(floor(epoch_us(created_ts) / 1000000.0) AS BIGINT) AS seconds,
    CAST(year(created_ts) AS INT) AS y FROM ({ds.EVENT_ACTIVITY})""",
)
def time_parts(spark, sf_dir):
    """Timestamps from text and back: hour, unix seconds, year."""
    rows = ds.event_activity(spark, sf_dir).withColumn("at", times.parse_timestamp(F.col("created_ts").cast("string")))
    return rows.select("id", times.posting_hour("at").alias("hour"), times.unix_seconds("at").alias("seconds"), F.year("at").alias("y"))


@query(
    "score_arithmetic",
    f"""SELECT id, floor(score / 7) AS sevens, CAST(trunc(score * 0.3::DOUBLE) AS BIGINT) AS part, abs(shifted) AS size,
    CASE WHEN subreddit = 'click' THEN abs(sentiment) ELSE 0.0::DOUBLE - abs(sentiment) END AS combined, shifted AS clamped FROM ({ds.SCORED_EVENTS})""",
)
def score_arithmetic(spark, sf_dir):
    """Floor, truncation, absolute value, sign from a label, clamp."""
    rows = ds.scored_events(spark, sf_dir).withColumn("label", F.when(F.col("subreddit") == "click", "POSITIVE").otherwise("NEGATIVE"))
    return rows.select(
        "id", F.floor(F.col("score") / 7).cast("double").alias("sevens"), (F.col("score") * 0.3).cast("bigint").alias("part"),
        F.abs("shifted").alias("size"), buckets.signed_magnitude("sentiment", "label").alias("combined"),
        buckets.clamp("shifted").alias("clamped"),
    )


@query(
    "activity_level_window",
    f"""WITH e AS ({ds.EVENT_ACTIVITY}) SELECT id, n AS activity_level, n / avg(n) OVER (PARTITION BY subreddit) AS activity_ratio
    FROM (SELECT *, count(*) OVER (PARTITION BY subreddit) AS n FROM e)""",
)
def activity_level_window(spark, sf_dir):
    rows = aggregates.activity_level(ds.event_activity(spark, sf_dir), counted="created_ts")
    return rows.select("id", "activity_level", "activity_ratio")


@query(
    "standardise_pop",
    f"""WITH e AS ({ds.SCORED_EVENTS}), m AS (SELECT avg(score) AS ms, stddev_pop(score) AS ss, avg(sentiment) AS mt,
    stddev_pop(sentiment) AS st FROM e) SELECT id, round((score - ms) / ss, 6) AS score_std, round((sentiment - mt) / st, 6) AS sentiment_std FROM e, m""",
)
def standardise_pop(spark, sf_dir):
    rows = standardise_columns(ds.scored_events(spark, sf_dir), ["score", "sentiment"])
    return rows.select("id", F.round("score_std", 6).alias("score_std"), F.round("sentiment_std", 6).alias("sentiment_std"))


@query(
    "cluster_profile",
    f"""SELECT cluster, round(avg(score), 6) AS score, round(avg(sentiment), 8) AS sentiment, round(avg(hour), 6) AS hour
    FROM (SELECT *, {_CODE.format(x='score - 50')} AS cluster, hour(created_ts) AS hour FROM ({ds.SCORED_EVENTS})) GROUP BY 1""",
)
def cluster_profile(spark, sf_dir):
    """Feature means per cluster, with the score class standing in for a fitted cluster."""
    rows = ds.scored_events(spark, sf_dir).withColumn("cluster", buckets.score_code(F.col("score") - 50))
    out = clustering.cluster_profile(rows.withColumn("hour", times.posting_hour("created_ts")), ["score", "sentiment", "hour"])
    return out.select("cluster", F.round("score", 6).alias("score"), F.round("sentiment", 8).alias("sentiment"), F.round("hour", 6).alias("hour"))


@query(
    "misclassified_rows",
    f"""SELECT id, truth, prediction FROM (SELECT id, {_CODE.format(x='score - 50')} AS truth,
    CASE WHEN sentiment < 0 THEN 1 ELSE 5 END AS prediction FROM ({ds.SCORED_EVENTS})) WHERE truth <> prediction""",
)
def misclassified_rows(spark, sf_dir):
    rows = ds.scored_events(spark, sf_dir).select(
        "id", buckets.score_code(F.col("score") - 50).alias("truth"), F.when(F.col("sentiment") < 0, 1).otherwise(5).alias("prediction")
    )
    return filters.misclassified(rows)
