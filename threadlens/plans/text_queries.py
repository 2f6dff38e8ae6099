"""Queries for tokens, n-grams and TF-IDF over the whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions.text import tokens
from threadlens.operators import aggregates, lexicons, ngrams, sentiment
from threadlens.plans import datasets as ds
from threadlens.plans import stance_queries, workflows
from threadlens.plans.registry import query
from threadlens.session import written

_STOP = ", ".join(f"'{w}'" for w in ds.STOPWORDS)


def _grams_sql(source: str, keep: str, low: int = 1, high: int = 2) -> str:
    """CTEs t (documents with tokens) and tf (document, n-gram, count)."""
    uni = "toks" if low == 1 else "[]::VARCHAR[]"
    both = f"list_concat({uni}, list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1]))" if high == 2 else uni
    return rf"""t AS (SELECT {keep}, coalesce(list_filter(regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}_]{{2,}}'),
      lambda x: x NOT IN ({_STOP})), []) AS toks FROM ({source})),
    tf AS (SELECT {keep}, ngram, count(*) AS tf FROM (SELECT {keep}, unnest({both}) AS ngram FROM t) GROUP BY ALL)"""


def _weights_sql(source: str, keep: str, by: str = "", cap: int | None = None) -> str:
    """The same with CTE w: L2-normalised weight per document and n-gram."""
    group = f"{by}, " if by else ""
    limit = f" QUALIFY row_number() OVER ({f'PARTITION BY {by} ' if by else ''}ORDER BY sum(tf) DESC, ngram) <= {cap}" if cap else ""
    docs = f"(SELECT {by}, count(*) AS n FROM t GROUP BY 1)" if by else "(SELECT count(*) AS n FROM t)"
    using = f"JOIN n USING ({by})" if by else "CROSS JOIN n"
    return f"""{_grams_sql(source, keep)}, n AS {docs},
    d AS (SELECT {group}ngram, count(*) AS df FROM tf GROUP BY {group}ngram{limit}),
    r AS (SELECT tf.*, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM tf JOIN d USING ({group}ngram) {using}),
    w AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM r)"""


def document_terms(spark, sf_dir, keep=("id", "subreddit")):
    return ngrams.document_terms(ds.document_activity(spark, sf_dir), stopwords=ds.STOPWORDS, keep=keep)


@query("token_counts", f"WITH {_grams_sql(ds.DOCUMENT_ACTIVITY, 'id', 1, 1)} SELECT ngram, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM tf GROUP BY 1")
def token_counts(spark, sf_dir):
    rows = ds.document_activity(spark, sf_dir)
    return ngrams.ngram_counts(ngrams.document_terms(rows, stopwords=ds.STOPWORDS, low=1, high=1))


@query(
    "stopword_table_counts",
    r"""WITH b AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS word FROM benchmark),
    stop AS (SELECT word FROM b GROUP BY 1 ORDER BY count(*) DESC, word LIMIT 40),
    t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS ngram FROM documents)
    SELECT ngram, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t WHERE ngram NOT IN (SELECT word FROM stop) GROUP BY 1""",
)
def stopword_table_counts(spark, sf_dir):
    """Words of the documents without those of a stopword table, here the 40 commonest words of the benchmark."""
    words = ds.table(spark, sf_dir, "benchmark").select(F.explode(tokens("text")).alias("word"))
    table = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(40).select("word")
    terms = ngrams.document_terms(ds.document_activity(spark, sf_dir), stopwords=ngrams.stopwords_from(table), low=1, high=1)
    return ngrams.ngram_counts(terms)


@query("ngram_counts", f"WITH {_grams_sql(ds.DOCUMENT_ACTIVITY, 'id')} SELECT ngram, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM tf GROUP BY 1")
def ngram_counts(spark, sf_dir):
    return ngrams.ngram_counts(document_terms(spark, sf_dir))


@query(
    "capped_vocabulary",
    f"""WITH {_grams_sql(ds.DOCUMENT_ACTIVITY, 'id')} SELECT ngram, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM tf
    GROUP BY 1 ORDER BY sum(tf) DESC, ngram LIMIT 1000""",
)
def capped_vocabulary(spark, sf_dir):
    return ngrams.vocabulary(ngrams.ngram_counts(document_terms(spark, sf_dir)), 1000)


@query(
    "tfidf_documents",
    f"""WITH {_weights_sql(ds.DOCUMENT_ACTIVITY, 'id')} SELECT id, count(*) AS terms, round(sum(weight), 6) AS weight,
    round(sum(weight * weight), 6) AS norm, round(max(weight), 6) AS heaviest FROM w GROUP BY 1""",
)
def tfidf_documents(spark, sf_dir):
    """Per document: number of n-grams, summed and largest weight, squared length."""
    weights = ngrams.tfidf(document_terms(spark, sf_dir, ("id",)))
    return weights.groupBy("id").agg(
        F.count("*").alias("terms"), F.round(F.sum("weight"), 6).alias("weight"),
        F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("norm"), F.round(F.max("weight"), 6).alias("heaviest"),
    )


@query(
    "tfidf_top",
    f"""WITH {_weights_sql(ds.DOCUMENT_ACTIVITY, 'id')} SELECT ngram, round(sum(weight), 6) AS weight FROM w GROUP BY 1
    ORDER BY round(sum(weight), 9) DESC, ngram LIMIT 50""",
)
def tfidf_top(spark, sf_dir):
    totals = ngrams.ngram_totals(ngrams.tfidf(document_terms(spark, sf_dir, ("id",))))
    return ngrams.top_ngrams(totals, 50).withColumn("weight", F.round("weight", 6))


@query(
    "tfidf_capped_top",
    f"""WITH {_weights_sql(ds.DOCUMENT_ACTIVITY, 'id', cap=1000)} SELECT ngram, round(sum(weight), 6) AS weight FROM w GROUP BY 1
    ORDER BY round(sum(weight), 9) DESC, ngram LIMIT 50""",
)
def tfidf_capped_top(spark, sf_dir):
    totals = ngrams.ngram_totals(ngrams.tfidf(document_terms(spark, sf_dir, ("id",)), max_features=1000))
    return ngrams.top_ngrams(totals, 50).withColumn("weight", F.round("weight", 6))


_BY_LANG = "SELECT doc_id AS id, text AS body, lang AS event FROM documents"


@query(
    "tfidf_top_per_event",
    f"""WITH {_weights_sql(_BY_LANG, 'id, event', by='event')} SELECT event, ngram, round(sum(weight), 6) AS weight FROM w GROUP BY event, ngram
    QUALIFY row_number() OVER (PARTITION BY event ORDER BY round(sum(weight), 9) DESC, ngram) <= 10""",
)
def tfidf_top_per_event(spark, sf_dir):
    """Top ten n-grams of every group, weights fitted within the group; the language stands for the event."""
    rows = ds.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("body"), F.col("lang").alias("event"))
    terms = ngrams.document_terms(rows, stopwords=ds.STOPWORDS, keep=("id", "event"))
    totals = ngrams.ngram_totals(ngrams.tfidf(terms, by=["event"]), ["event"])
    return ngrams.top_ngrams(totals, 10, ["event"]).withColumn("weight", F.round("weight", 6))


@query(
    "tfidf_profile_by_community",
    f"""WITH {_weights_sql(ds.DOCUMENT_ACTIVITY, 'id, subreddit')}, top AS (SELECT ngram FROM w GROUP BY 1
    ORDER BY round(sum(weight), 9) DESC, ngram LIMIT 50) SELECT subreddit, ngram, round(sum(weight), 6) AS weight
    FROM w WHERE ngram IN (SELECT ngram FROM top) GROUP BY ALL""",
)
def tfidf_profile_by_community(spark, sf_dir):
    profile = ngrams.ngram_profile(ngrams.tfidf(document_terms(spark, sf_dir)), "subreddit", 50)
    return profile.withColumn("weight", F.round("weight", 6))


def author_terms(spark, sf_dir):
    return ngrams.document_terms(ds.comments(spark, sf_dir), stopwords=ds.STOPWORDS, keep=("id", "author"))


_AUTHOR_TOP = f"""{_weights_sql(ds.COMMENTS, 'id, author')}, top AS (SELECT ngram, row_number() OVER
    (ORDER BY round(sum(weight), 9) DESC, ngram) AS place FROM w GROUP BY ngram QUALIFY place <= 10)"""


@query(
    "tfidf_profile_by_author",
    f"WITH {_AUTHOR_TOP} SELECT author, ngram, round(sum(weight), 6) AS weight FROM w JOIN top USING (ngram) GROUP BY ALL",
)
def tfidf_profile_by_author(spark, sf_dir):
    profile = ngrams.ngram_profile(ngrams.tfidf(author_terms(spark, sf_dir)), "author", 10)
    return profile.withColumn("weight", F.round("weight", 6))


def author_features(spark, sf_dir):
    """N-gram profile, sentiment, usual hour, mean scores and counts in one row per author of a comment."""
    profile = written(ngrams.ngram_profile(ngrams.tfidf(author_terms(spark, sf_dir)), "author", 10), "profile")
    top = [r.ngram for r in ngrams.top_ngrams(ngrams.ngram_totals(profile), 10).collect()]
    wide = ngrams.profile_matrix(profile, "author", top, ds.comments(spark, sf_dir))
    wide = aggregates.rename(wide, {g: f"ngram_{i + 1}" for i, g in enumerate(top)})
    numbers = aggregates.author_numbers(ds.scored_events(spark, sf_dir), ds.EVENT_TYPES)
    return aggregates.merge_features(wide, numbers)


_EACH_SCORE = ", ".join(f"coalesce(round(avg_score_{c}, 6), 0) AS avg_score_{c}" for c in ds.EVENT_TYPES)
_EACH_COUNT = ", ".join(f"coalesce(subreddit_{c}, 0) AS subreddit_{c}" for c in ds.EVENT_TYPES)
_NUMBERS = f"""SELECT author, avg(sentiment) AS sentiment_mean, min(sentiment) AS sentiment_min, max(sentiment) AS sentiment_max,
    {", ".join(f"avg(score) FILTER (subreddit = '{c}') AS avg_score_{c}, count(*) FILTER (subreddit = '{c}') AS subreddit_{c}" for c in ds.EVENT_TYPES)}
    FROM ({ds.SCORED_EVENTS}) GROUP BY 1"""


@query(
    "author_feature_table",
    f"""WITH {_AUTHOR_TOP}, p AS (SELECT author, {", ".join(f"sum(weight) FILTER (place = {i}) AS n{i}" for i in range(1, 11))}
      FROM w JOIN top USING (ngram) GROUP BY 1),
    h AS (SELECT author, CAST(hour(created_ts) AS INT) AS hour, count(*) AS n FROM ({ds.SCORED_EVENTS}) GROUP BY 1, 2
      QUALIFY row_number() OVER (PARTITION BY author ORDER BY n DESC, hour) = 1)
    SELECT a.author, {", ".join(f"coalesce(round(n{i}, 6), 0) AS ngram_{i}" for i in range(1, 11))},
      coalesce(round(sentiment_mean, 8), 0) AS sentiment_mean, coalesce(sentiment_min, 0) AS sentiment_min,
      coalesce(sentiment_max, 0) AS sentiment_max, coalesce(hour, 0) AS most_common_hour, {_EACH_SCORE}, {_EACH_COUNT}
    FROM (SELECT DISTINCT author FROM ({ds.COMMENTS})) a LEFT JOIN p USING (author) LEFT JOIN ({_NUMBERS}) q USING (author) LEFT JOIN h USING (author)""",
)
def author_feature_table(spark, sf_dir):
    wide = author_features(spark, sf_dir)
    digits = {c: 8 if c == "sentiment_mean" else 6 for c in wide.columns if c.startswith(("ngram_", "avg_score_")) or c == "sentiment_mean"}
    return wide.withColumns({c: F.round(c, d) for c, d in digits.items()})


_HOMES = ds.SOURCES[:3]
_FRAME = rf"""src AS (SELECT s.id, 'u' || (s.id % 30) AS author, s.body, s.subreddit, s.sentiment, e.ts AS created_ts, e.value - 50 AS score
    FROM (SELECT *, regexp_replace(body, '^\s+|\s+$', '', 'g') AS t FROM ({stance_queries.SENTIMENT})) s JOIN events e ON (s.id * 10) % (SELECT count(*) FROM events) = e.event_id
    WHERE CASE WHEN t = '' THEN 0 ELSE len(string_split_regex(t, '\s+')) END <= 512 AND abs(s.sentiment) >= 0.2
      AND {stance_queries._group_sql('lower(body)', False)} IS NOT NULL)"""


@query(
    "author_feature_frame",
    f"""WITH {_FRAME}, {_weights_sql('SELECT id, author, body FROM src', 'id, author')},
    top AS (SELECT ngram, row_number() OVER (ORDER BY round(sum(weight), 9) DESC, ngram) AS place FROM w GROUP BY ngram QUALIFY place <= 10),
    p AS (SELECT author, {", ".join(f"sum(weight) FILTER (place = {i}) AS n{i}" for i in range(1, 11))} FROM w JOIN top USING (ngram) GROUP BY 1),
    h AS (SELECT author, CAST(hour(created_ts) AS INT) AS hour, count(*) AS n FROM src GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY author ORDER BY n DESC, hour) = 1),
    q AS (SELECT author, avg(sentiment) AS sentiment_mean, min(sentiment) AS sentiment_min, max(sentiment) AS sentiment_max,
      {", ".join(f"avg(score) FILTER (subreddit = '{c}') AS avg_score_{c}, count(*) FILTER (subreddit = '{c}') AS subreddit_{c}" for c in _HOMES)} FROM src GROUP BY 1)
    SELECT q.author, {", ".join(f"coalesce(round(n{i}, 6), 0) AS ngram_{i}" for i in range(1, 11))}, round(sentiment_mean, 8) AS sentiment_mean,
      round(sentiment_min, 8) AS sentiment_min, round(sentiment_max, 8) AS sentiment_max, hour AS most_common_hour,
      {", ".join(f"coalesce(round(avg_score_{c}, 6), 0) AS avg_score_{c}, subreddit_{c}" for c in _HOMES)}
    FROM q LEFT JOIN p USING (author) LEFT JOIN h USING (author)""",
)
def author_feature_frame(spark, sf_dir):
    """The author features from one frame with all its filters: length, mention and strength."""
    author = F.concat(F.lit(" U"), F.pmod("id", F.lit(30)), F.lit(" "))
    activity = ds.timed_documents(spark, sf_dir).withColumn("author", author)

    def score(rows):
        scored = sentiment.lexicon_polarity(rows, ds.valence_lexicon(spark))
        return scored.withColumn("sentiment", sentiment.combined_sentiment("polarity", "label"))

    entities = lexicons.lexicon_rows(ds.entity_lexicon(spark))
    wide, _ = workflows.author_feature_frame(activity, score, entities, ("A", "B"), _HOMES, ds.STOPWORDS)
    digits = {c: 8 if c.startswith("sentiment_") else 6 for c in wide.columns if c.startswith(("ngram_", "avg_score_", "sentiment_"))}
    return wide.withColumns({c: F.round(c, d) for c, d in digits.items()})
