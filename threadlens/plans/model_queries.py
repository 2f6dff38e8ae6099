"""Queries that fit models; results are checked by rows and invariants."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions import buckets
from threadlens.operators import aggregates, ngrams
from threadlens.operators import sentiment as st
from threadlens.operators.models import classification, clustering
from threadlens.operators.models.features import numeric_columns, reduced_text
from threadlens.plans import datasets as ds
from threadlens.plans import text_queries, workflows
from threadlens.plans.registry import query
from threadlens.session import shared_path, written

_SEVEN = ["sentiment_mean", "most_common_hour", *[f"avg_score_{c}" for c in ds.EVENT_TYPES]]


def _author_table(spark, sf_dir) -> DataFrame:
    """The feature table, computed once: model fits pass over it several times."""
    return written(text_queries.author_features(spark, sf_dir), "authors")


@query("kmeans_authors")
def kmeans_authors(spark, sf_dir):
    """Four clusters over seven standardised author features."""
    numbers = aggregates.author_numbers(ds.scored_events(spark, sf_dir), ds.EVENT_TYPES).na.fill(0.0)
    return clustering.kmeans(numbers, _SEVEN, 4).select("author", "cluster", *_SEVEN)


@query("kmeans_all_features")
def kmeans_all_features(spark, sf_dir):
    """Three clusters over every author feature, with the two-component projection for the chart."""
    wide = _author_table(spark, sf_dir)
    columns = numeric_columns(wide)
    points = clustering.pca_points(clustering.kmeans(wide, columns, 3), columns)
    return points.select("author", "cluster", "pc1", "pc2")


@query("cluster_means")
def cluster_means(spark, sf_dir):
    return clustering.cluster_profile(kmeans_authors(spark, sf_dir), _SEVEN)


@query("pca_points")
def pca_points(spark, sf_dir):
    numbers = aggregates.author_numbers(ds.scored_events(spark, sf_dir), ds.EVENT_TYPES).na.fill(0.0)
    return clustering.pca_points(numbers, numeric_columns(numbers)).select("author", "sentiment_mean", "pc1", "pc2")


@query("pca_points_unscaled")
def pca_points_unscaled(spark, sf_dir):
    numbers = aggregates.author_numbers(ds.scored_events(spark, sf_dir), ds.EVENT_TYPES).na.fill(0.0)
    return clustering.pca_points(numbers, _SEVEN, scale=False).select("author", "pc1", "pc2")


@query("pca_loadings")
def pca_loadings(spark, sf_dir):
    numbers = aggregates.author_numbers(ds.scored_events(spark, sf_dir), ds.EVENT_TYPES).na.fill(0.0)
    return clustering.pca_loadings(numbers, _SEVEN)


def _community_matrix(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    profile = written(ngrams.ngram_profile(ngrams.tfidf(text_queries.document_terms(spark, sf_dir)), "subreddit", 50), "profile")
    names = [r.ngram for r in profile.select("ngram").distinct().orderBy("ngram").collect()]
    wide = ngrams.profile_matrix(profile, "subreddit", names)
    return aggregates.rename(wide, {g: f"ngram_{i + 1}" for i, g in enumerate(names)}), names


@query("kmeans_communities")
def kmeans_communities(spark, sf_dir):
    """Three clusters of communities by their n-gram profiles, with their projection."""
    wide, names = _community_matrix(spark, sf_dir)
    columns = [f"ngram_{i + 1}" for i in range(len(names))]
    points = clustering.pca_points(clustering.kmeans(wide, columns, 3), columns)
    return points.select("subreddit", "cluster", "pc1", "pc2")


@query("community_loadings_top5")
def community_loadings_top5(spark, sf_dir):
    wide, names = _community_matrix(spark, sf_dir)
    loads = clustering.pca_loadings(wide, [f"ngram_{i + 1}" for i in range(len(names))]).where(F.col("place") <= 5)
    words = spark.createDataFrame([(f"ngram_{i + 1}", g) for i, g in enumerate(names)], "feature string, ngram string")
    return loads.join(words, "feature").select("component", "ngram", "loading", "place")


def _post_rows(spark, sf_dir) -> DataFrame:
    """Timed documents with sentiment, written once for the passes of the fits."""
    rows = st.lexicon_polarity(ds.timed_documents(spark, sf_dir), ds.valence_lexicon(spark))
    rows = rows.withColumn("sentiment", st.combined_sentiment("polarity", "label")).drop("polarity")
    return written(rows, "posts")


@query("kmeans_mixed")
def kmeans_mixed(spark, sf_dir):
    """Five clusters over community, words, time and sentiment, unscaled, with the time and sentiment to draw."""
    rows = clustering.kmeans_mixed(_post_rows(spark, sf_dir), stopwords=ds.STOPWORDS)
    return rows.select("id", "cluster", F.unix_seconds(F.col("created_ts").cast("timestamp")).alias("seconds"), "sentiment")


@query("cluster_score_crosstab")
def cluster_score_crosstab(spark, sf_dir):
    rows = clustering.kmeans_mixed(_post_rows(spark, sf_dir), stopwords=ds.STOPWORDS, scale=True)
    return aggregates.crosstab(rows.withColumn("score_code", buckets.score_code("score")), "score_code", "cluster", range(5))


@query("text_components")
def text_components(spark, sf_dir):
    """Whole texts projected to 100 components of their TF-IDF over 1000 n-grams, one row per text and component."""
    rows = ds.document_activity(spark, sf_dir)
    xs = vector_to_array("text_pca")
    made = reduced_text(rows, stopwords=ds.STOPWORDS, reuse=True)(rows)
    return made.select("id", F.posexplode(xs).alias("component", "value"))


@query("rf_event_classifier")
def rf_event_classifier(spark, sf_dir):
    """Forest of 100 trees naming the milestone window of a post; accuracy on train, test and by majority."""
    return workflows.event_classification(_post_rows(spark, sf_dir), ds.ANCHOR, ds.MILESTONES, window=1, stopwords=ds.STOPWORDS)


def _score_model(spark, sf_dir, scale: bool = False) -> workflows.ScorePrediction:
    return workflows.ScorePrediction(_post_rows(spark, sf_dir), stopwords=ds.STOPWORDS, scale=scale)


@query("rf_score")
def rf_score(spark, sf_dir):
    return _score_model(spark, sf_dir).accuracies(["forest"])


@query("gbt_ovr_score")
def gbt_ovr_score(spark, sf_dir):
    """Labels for the unlabelled posts from boosted trees, one model per class (100 rounds each)."""
    return _score_model(spark, sf_dir).predictions("boosting")


@query("rf_predictions_written")
def rf_predictions_written(spark, sf_dir):
    """Labels for the unlabelled posts from the forest, through the sink."""
    return _score_model(spark, sf_dir).write_predictions(shared_path(spark, "predictions"), "forest")


@query("mlp_score")
def mlp_score(spark, sf_dir):
    return _score_model(spark, sf_dir, scale=True).accuracies(["network"])


@query("penalised_mlp_score")
def penalised_mlp_score(spark, sf_dir):
    """Accuracy of the network with a weight penalty of 0.05."""
    return _score_model(spark, sf_dir, scale=True).accuracies(["penalised_network"])


@query("feature_importance_top5")
def feature_importance_top5(spark, sf_dir):
    return _score_model(spark, sf_dir).importances().limit(5)


@query("score_misclassified")
def score_misclassified(spark, sf_dir):
    return _score_model(spark, sf_dir).misclassified("forest")


@query("learned_label")
def learned_label(spark, sf_dir):
    """Labels for every document from a classifier trained on the labelled ones."""
    rows = ds.labelled_documents(spark, sf_dir)
    out = classification.learned_label(rows.where(F.col("label").isNotNull()), rows, stopwords=ds.STOPWORDS)
    return out.select("id", "label")


@query(
    "user_label",
    """SELECT doc_id AS id, CASE WHEN (length(text) - length(regexp_replace(text, '[aeiou]', '', 'g'))) % 2 = 0 THEN 'POSITIVE'
    ELSE 'NEGATIVE' END AS label FROM documents""",
)
def user_label(spark, sf_dir):
    """Labels from a text function of the caller, here the parity of vowels, run in batches."""

    def build():
        return lambda texts: ["POSITIVE" if sum(t.count(v) for v in "aeiou") % 2 == 0 else "NEGATIVE" for t in texts]

    return st.udf_label(ds.document_activity(spark, sf_dir), build).select("id", "label")
