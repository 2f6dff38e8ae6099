"""Group summaries. All combine before the shuffle, so one very large group costs no more than its partials."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.times import posting_hour
from threadlens.session import written


def value_counts(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per value, most frequent first, missing values left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias(count))
        .orderBy(F.desc(count), column)
    )


def group_sizes(df: DataFrame, keys: Sequence[str], count: str = "post_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count))


def group_means(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def ranked_means(df: DataFrame, key: str, column: str, n: int = 10) -> DataFrame:
    """The n groups with the highest mean."""
    return group_means(df, [key], [column]).orderBy(F.desc(column), key).limit(n)


def score_summary(df: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Mean, sum and maximum of the score per group, one flat column each."""
    return df.groupBy(key).agg(
        F.avg(score).alias(f"{score}_mean"), F.sum(score).alias(f"{score}_sum"), F.max(score).alias(f"{score}_max")
    )


def share_percent(condition: Column) -> Column:
    """Percentage of rows for which the condition holds; use inside `agg`."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double")) * 100


def sentiment_features(df: DataFrame, author: str = "author", sentiment: str = "sentiment") -> DataFrame:
    return df.groupBy(author).agg(*_sentiment_aggs(sentiment))


def _sentiment_aggs(sentiment: str) -> list[Column]:
    return [
        F.avg(sentiment).alias("sentiment_mean"),
        F.min(sentiment).alias("sentiment_min"),
        F.max(sentiment).alias("sentiment_max"),
    ]


def most_common_hour(df: DataFrame, author: str = "author", created: str = "created_ts") -> DataFrame:
    """Each author's most frequent posting hour; the smallest hour wins a tie."""
    per_hour = (
        df.withColumn("_hour", posting_hour(created))
        .where(F.col("_hour").isNotNull())
        .groupBy(author, "_hour")
        .agg(F.count("*").alias("_n"))
    )
    return per_hour.groupBy(author).agg(
        F.max_by("_hour", F.struct("_n", -F.col("_hour"))).alias("most_common_hour")
    )


def distinct_values(df: DataFrame, column: str) -> list:
    """Distinct values of a low-cardinality column in order, for naming pivot columns."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} distinct values; keep it in long form")
    return sorted(r[0] for r in rows)


def pivot_mean(
    df: DataFrame, key: str, column: str, value: str, values: Sequence | None = None,
    prefix: str = "avg_score_", fill: float | None = 0.0,
) -> DataFrame:
    """Mean of `value` per key and category, one prefixed column per category; `fill` marks empty cells."""
    return _pivot(df, key, column, [F.avg(value)], values, prefix, fill)


def pivot_count(
    df: DataFrame, key: str, column: str, values: Sequence | None = None, prefix: str = "subreddit_",
) -> DataFrame:
    """Rows per key and category, one prefixed column per category (one-hot encoding summed)."""
    return _pivot(df, key, column, [F.count(F.lit(1))], values, prefix, 0)


def _pivot(df, key, column, aggs, values, prefix, fill) -> DataFrame:
    values = list(values) if values is not None else distinct_values(df, column)
    wide = df.groupBy(key).pivot(column, values).agg(*aggs)
    wide = wide.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})
    return wide if fill is None else wide.na.fill(fill, [f"{prefix}{v}" for v in values])


def crosstab(df: DataFrame, row: str, column: str, values: Sequence | None = None) -> DataFrame:
    """Counts of two categories, the second across; rows missing either are left out."""
    both = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return _pivot(both, row, column, [F.count(F.lit(1))], values, "", 0)


def prefixed_user_totals(df: DataFrame, author: str = "author", prefix: str = "subreddit_", skip: Sequence[str] = ("subreddit_id",)) -> DataFrame:
    """Per author: mean sentiment, sum of every numeric column with the prefix, number of posts."""
    summed = [c for c in df.columns if c.startswith(prefix) and c not in skip]
    return df.groupBy(author).agg(
        F.avg("sentiment").alias("sentiment"), *[F.sum(c).alias(c) for c in summed], F.count("id").alias("post_count")
    )


def author_numbers(
    df: DataFrame, communities: Sequence[str], author: str = "author", community: str = "subreddit",
    sentiment: str = "sentiment", created: str = "created_ts", score: str = "score",
) -> DataFrame:
    """Sentiment, usual hour, mean score and row count per community, in one aggregation over the rows.

    Equal to joining `sentiment_features`, `most_common_hour`, `pivot_mean` and `pivot_count` on the author,
    but with a single shuffle whose partials are one row per author and input task.
    """
    hours, home = posting_hour(created), F.col(community)
    per_hour = [F.count_if(hours == h).alias(f"_hour_{h}") for h in range(24)]
    per_community = [
        agg
        for c in communities
        for agg in (
            F.avg(F.when(home == c, F.col(score))).alias(f"avg_score_{c}"),
            F.count_if(home == c).alias(f"subreddit_{c}"),
        )
    ]
    wide = df.groupBy(author).agg(*_sentiment_aggs(sentiment), *per_hour, *per_community)
    counts = F.array(*[f"_hour_{h}" for h in range(24)])
    best = F.array_max(counts)
    return wide.select(
        author, "sentiment_mean", "sentiment_min", "sentiment_max",
        F.when(best > 0, F.array_position(counts, best).cast("int") - 1).alias("most_common_hour"),
        *[f"avg_score_{c}" for c in communities],
        *[f"subreddit_{c}" for c in communities],
    )


def merge_features(base: DataFrame, *others: DataFrame, key: str = "author", fill: float = 0.0) -> DataFrame:
    """Left joins on one key, then missing numbers to `fill`; each table holds one row per key."""
    out = base
    for other in others:
        out = out.join(other, key, "left")
    return out.na.fill(fill)


def activity_level(df: DataFrame, community: str = "subreddit", counted: str = "week") -> DataFrame:
    """Add each row's community size and its ratio to the mean size over the community's rows.

    The size is the same on every row of a community, so the ratio is 1 wherever it is defined.
    """
    sizes = df.groupBy(community).agg(F.count(counted).alias("activity_level"))
    sizes = sizes.withColumn("activity_ratio", F.try_divide("activity_level", "activity_level"))
    return df.join(written(sizes, "sizes"), community, "left")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
