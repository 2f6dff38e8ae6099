"""Canonical tables built from the test tables, with the same tables as SQL for the oracle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens import schemas
from threadlens.functions.buckets import clamp
from threadlens.operators.sentiment import given_label
from threadlens.operators.trends import milestone_weeks
from threadlens.session import configure, local_table, spread

ANCHOR = dt.date(2024, 1, 20)
MILESTONES = (("C", dt.date(2024, 1, 20)), ("A", dt.date(2024, 1, 5)), ("B", dt.date(2024, 1, 12)))
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SOURCES = tuple(f"src{i}" for i in range(20))

STOPWORDS = ("the", "and", "of", "der", "die", "de", "la", "les")
ENTITIES = ((1, "thing", "A"), (2, "erble", "A"), (3, "ering", "B"), (4, "nicht", "B"))
PHRASES = ((1, "of the", -0.5), (2, "with the", 0.5), (3, "de la", -0.5), (4, "la de", 0.5))
SYNONYMS = (("of the", "to of"), ("de la", "la_la"))
VALENCES = (
    ("with", 1.0), ("from", 2.0), ("que", 3.0), ("und", 1.0), ("was", -1.0), ("are", -2.0), ("des", -3.0), ("den", -1.0)
)
NEGATIONS = ("the", "la", "der")
BOOSTERS = (("of", 1), ("to", 1), ("de", -1), ("in", -1), ("with", 1))

TEXT_TABLES = ("documents", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scan = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan) if name in TEXT_TABLES else scan


def event_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity with numbers and times: one row per event, its type as the community."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("author"),
        F.col("event_type").alias("subreddit"), F.col("ts").alias("created_ts"), F.col("value").alias("score"),
        F.year("ts").alias("year"), F.month("ts").alias("month"),
    )


EVENT_ACTIVITY = """SELECT event_id AS id, CAST(user_id AS VARCHAR) AS author, event_type AS subreddit,
    ts AS created_ts, value AS score, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM events"""


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a sentiment from the centred value and a shift that depends on the type."""
    df = event_activity(spark, sf_dir).withColumn("sentiment", clamp((F.col("score") - 50) / 100))
    shift = F.when(F.col("subreddit") == "purchase", 0.5).when(F.col("subreddit") == "error", -0.5).otherwise(0.0)
    return df.withColumn("shifted", clamp(F.col("sentiment") + shift))


SCORED_EVENTS = f"""SELECT *, greatest(-1.0::DOUBLE, least(1.0::DOUBLE, sentiment + CASE subreddit WHEN 'purchase' THEN 0.5::DOUBLE
    WHEN 'error' THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END)) AS shifted
    FROM (SELECT *, greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (score - 50) / 100)) AS sentiment FROM ({EVENT_ACTIVITY}))"""


def document_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity with text: one row per document, its source as the community."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("body"), F.col("source").alias("subreddit"),
        F.col("n_chars").alias("score"),
    )


DOCUMENT_ACTIVITY = "SELECT doc_id AS id, text AS body, source AS subreddit, n_chars AS score FROM documents"


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the given label; NULL where the label table does not cover them."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    return given_label(document_activity(spark, sf_dir), labels, "id", F.col("quality") == 1)


LABELLED_DOCUMENTS = """SELECT d.doc_id AS id, d.text AS body, d.source AS subreddit, d.n_chars AS score,
    CASE WHEN l.quality = 1 THEN 'POSITIVE' WHEN l.doc_id IS NOT NULL THEN 'NEGATIVE' END AS label
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening turns as submissions: the role as title, the text as selftext."""
    df = table(spark, sf_dir, "conversations").where(F.col("turn") == 0)
    return df.select(
        F.col("conv_id").cast("string").alias("author"), F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("role").alias("title"), F.col("text").alias("selftext"), F.col("role").alias("subreddit"),
    )


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later turns as comments."""
    df = table(spark, sf_dir, "conversations").where(F.col("turn") > 0)
    return df.select(
        F.col("conv_id").cast("string").alias("author"), F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("text").alias("body"), F.col("role").alias("subreddit"),
    )


COMMENTS = """SELECT CAST(conv_id AS VARCHAR) AS author, conv_id || '-' || turn AS id, text AS body, role AS subreddit
    FROM conversations WHERE turn > 0"""
SUBMISSIONS = """SELECT CAST(conv_id AS VARCHAR) AS author, conv_id || '-' || turn AS id, role AS title,
    text AS selftext, role AS subreddit FROM conversations WHERE turn = 0"""


def milestones(spark: SparkSession) -> DataFrame:
    return milestone_weeks(spark, ANCHOR, MILESTONES)


MILESTONE_ROWS = "(VALUES (0, 'A', 2), (1, 'B', 1), (2, 'C', 0)) AS m(place, event, event_week)"


def entity_lexicon(spark: SparkSession) -> DataFrame:
    return local_table(spark, ENTITIES, schemas.ENTITY_LEXICON)


def phrase_lexicon(spark: SparkSession) -> DataFrame:
    return local_table(spark, PHRASES, schemas.PHRASE_LEXICON)


def synonym_table(spark: SparkSession) -> DataFrame:
    return local_table(spark, SYNONYMS, schemas.SYNONYMS)


def valence_lexicon(spark: SparkSession) -> DataFrame:
    return local_table(spark, VALENCES, schemas.VALENCE_LEXICON)


def sql_values(rows) -> str:
    def lit(v) -> str:
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v!r}::DOUBLE" if isinstance(v, float) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")"


def timed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the time and centred value of an event, as activity with text.

    Document n takes event 10n, modulo the number of events, so that every document has one and the times cover the month.
    """
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("created_ts"), (F.col("value") - 50).alias("score"))
    documents = labelled_documents(spark, sf_dir).drop("score")
    count = events.count()
    return documents.join(events, F.pmod(F.col("id") * 10, F.lit(count)) == F.col("event_id")).drop("event_id")
