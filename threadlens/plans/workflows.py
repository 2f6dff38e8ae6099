"""End-to-end workflows composed from the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens import schemas
from threadlens.functions.buckets import leaning, score_code
from threadlens.functions.text import normalise_author
from threadlens.operators import aggregates, filters, ingest, lexicons, ngrams, sampling, sentiment, trends
from threadlens.operators.models import classification
from threadlens.operators.models.features import MixedFeatures
from threadlens.operators.models.network import Network
from threadlens.operators.ranking import head_and_rest
from threadlens.plans import datasets as ds
from threadlens.session import written
from threadlens.sources import read_parquet, write_parquet

MAX_SCORE = 500


def extract_activity(
    spark: SparkSession, submissions: str, comments: str, output: str, communities: Sequence[str] = ingest.ELECTION_COMMUNITIES,
    year: int = 2016, cap: int | None = None, files: int | None = None,
) -> None:
    """Raw JSON dumps to one activity table; with `cap`, at most 2 * cap * communities rows, for which `files` may be few."""
    posts = ingest.load_filtered(spark, submissions, schemas.SUBMISSIONS, communities, year, cap)
    replies = ingest.load_filtered(spark, comments, schemas.COMMENTS, communities, year, cap)
    write_parquet(ingest.combine_activity(replies, posts), output, files=files)


def score_activity(
    activity: DataFrame, entities: Sequence, phrases: Sequence[lexicons.Phrase], valences: DataFrame, label: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Activity with label, sentiment, politician_mentioned and shifted, in one plan.

    Texts that hold neither an entity nor a phrase keep zeros and never reach `label`, which adds the label column to the
    others (a model, a table or a function). Nothing is shuffled or written between the steps.
    """
    flagged = sentiment.mention_flags(activity, entities, phrases)

    def scorer(rows: DataFrame) -> DataFrame:
        scored = label(sentiment.lexicon_polarity(rows, valences))
        return sentiment.shift_cases(scored.withColumn("sentiment", sentiment.combined_sentiment("polarity", "label")), phrases)

    hopeful = F.col("politician_mentioned") | F.col("similar_phrase").isNotNull()
    scored = sentiment.score_hopeful(flagged, scorer, hopeful, {"sentiment": F.lit(0.0), "shifted": F.lit(0.0)})
    return scored.drop("similar_phrase", "shifting_phrase", "polarity")


def author_feature_frame(
    activity: DataFrame, score: Callable[[DataFrame], DataFrame], entities: Sequence, groups: tuple[str, str], communities: Sequence[str],
    stopwords: Sequence[str] = (), top: int = 10, longest: int = 512, least: float = 0.2,
) -> tuple[DataFrame, list[str]]:
    """One row per author from one table of activity, after all filters, and the n-grams behind `ngram_1` and so on.

    Texts of up to `longest` words that mention an entity and whose sentiment (added by `score`) is `least` or stronger count;
    authors go by their normalised names. The n-gram weights, sentiment, usual hour, mean scores and row counts come from
    the same rows, which are written once; missing numbers become 0.
    """
    short = filters.drop_long_texts(activity, max_words=longest).withColumn("author", normalise_author("author"))
    marked = sentiment.entity_stance(score(short), entities, groups)
    rows = written(filters.strong_scores(marked, "sentiment", least, flag="politician_mentioned").drop("mentioned_group", "stance"), "author-rows")
    terms = ngrams.document_terms(rows, stopwords=stopwords, keep=("id", "author"))
    profile = written(ngrams.ngram_profile(ngrams.tfidf(terms), "author", top), "author-profile")
    names = [r.ngram for r in ngrams.top_ngrams(ngrams.ngram_totals(profile), top).collect()]
    wide = ngrams.profile_matrix(profile, "author", names, rows)
    wide = aggregates.rename(wide, {g: f"ngram_{i + 1}" for i, g in enumerate(names)})
    return aggregates.merge_features(wide, aggregates.author_numbers(rows, communities)), names


def engagement_by_leaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average all activity per author, and summarise scores by the authors' leaning."""
    rows = ingest.drop_author(ds.scored_events(spark, sf_dir))
    authors = aggregates.group_means(rows, ["author"], ["shifted", "score"])
    return aggregates.score_summary(authors.withColumn("political_leaning", leaning("shifted")), "political_leaning")


def event_classification(
    rows: DataFrame, anchor: dt.date, milestones: Sequence[tuple[str, dt.date]], window: int = 2, size: int = 1000,
    components: int = 100, stopwords: Sequence[str] = (), fit_on_all: bool = False, trees: int = 100, depth: int = 6,
) -> DataFrame:
    """Predict the milestone window of each post; one row per measure: train, test and majority accuracy.

    `fit_on_all` fits the text features on all rows, test rows included; by default on the training rows only.
    """
    spark = rows.sparkSession
    weekly = trends.with_week(rows, anchor)
    labelled = trends.label_events(weekly, trends.milestone_weeks(spark, anchor, milestones), window)
    labelled = written(aggregates.activity_level(labelled), "labelled")
    train, test = sampling.train_test_split(labelled, 0.3)
    features = classification.EventFeatures(labelled if fit_on_all else train, size=size, components=components, stopwords=stopwords)
    train, test = (written(features.transform(p).select("id", "event", "features"), "vectors") for p in (train, test))
    model = classification.LabelledModel(train, "event", lambda inputs, classes: classification.random_forest(trees, depth))
    majority = classification.majority_share(labelled, "event").first()[0]
    measures = [("train", model.accuracy(train)), ("test", model.accuracy(test)), ("majority", float(majority))]
    return spark.createDataFrame(measures, "measure string, accuracy double")


class ScorePrediction:
    """Predict a post's score class from community, words, time and sentiment.

    Posts above the score limit are left out; the first `unlabelled` by key get predictions only. The others
    may lose some communities and be sampled (in total, or per community) before the train/validation split.
    `scale` brings all features to unit deviation, which the network needs: unix seconds saturate it otherwise.
    """

    def __init__(
        self, rows: DataFrame, key: str = "id", unlabelled: int = 200, exclude: Sequence[str] = (), sample: int | None = None,
        per_community: int | None = None, stopwords: Sequence[str] = (), words: int = 100, seed: int = 42,
        scale: bool = False,
    ):
        self.spark, self.seed = rows.sparkSession, seed
        capped = rows.where(F.col("score") < MAX_SCORE).withColumn("score_category", score_code("score"))
        head, rest = head_and_rest(capped, key, unlabelled)
        if exclude:
            rest = rest.where(~ingest.in_set("subreddit", exclude))
        if sample is not None:
            rest = sampling.exact_sample(rest, sample, key, seed)
        if per_community is not None:
            rest = sampling.sample_per_group(rest, "subreddit", per_community, key, seed)
        train, valid = sampling.train_test_split(rest, 0.25, key, seed)
        # Scaling passes over the vectors once more; the networks that need it do not depend on the order of rows.
        self.mixed = MixedFeatures(train, stopwords=stopwords, size=words, scale=scale, reuse=scale)
        # The fits pass over the vectors many times; text features are computed once.
        self.train, self.valid = (
            written(self.mixed.transform(p).select(key, "score_category", "features"), "vectors") for p in (train, valid)
        )
        self.unlabelled = self.mixed.transform(head.drop("score_category"))

    def fit(self, kind: str, **options) -> classification.LabelledModel:
        makers = {
            "forest": lambda i, c: classification.random_forest(min_leaf=20, seed=self.seed, **options),
            "boosting": lambda i, c: classification.boosted_trees(seed=self.seed, **options),
            "network": lambda i, c: classification.neural_network(i, c, seed=self.seed, **options),
            "penalised_network": lambda i, c: Network(i, c, seed=self.seed, **options),
        }
        return classification.LabelledModel(self.train, "score_category", makers[kind])

    def accuracies(self, kinds: Sequence[str] = ("forest", "boosting", "network")) -> DataFrame:
        """Train, validation and majority-class accuracy per model."""
        majority = float(classification.majority_share(self.valid, "score_category").first()[0])
        rows = []
        for kind in kinds:
            model = self.fit(kind)
            rows.append((kind, model.accuracy(self.train), model.accuracy(self.valid), majority))
        return self.spark.createDataFrame(rows, "model string, train double, validation double, majority double")

    def predictions(self, kind: str = "boosting", **options) -> DataFrame:
        """Predicted class of every unlabelled post."""
        return self.fit(kind, **options).predict(self.unlabelled).select("id", F.col("predicted").alias("prediction"))

    def write_predictions(self, path: str, kind: str = "boosting", **options) -> DataFrame:
        """The predictions, written as parquet and read back."""
        write_parquet(self.predictions(kind, **options), path)
        return read_parquet(self.spark, path)

    def misclassified(self, kind: str = "forest") -> DataFrame:
        scored = self.fit(kind).predict(self.valid)
        return filters.misclassified(
            scored.select("id", F.col("score_category").cast("string").alias("truth"), F.col("predicted").alias("prediction"))
        )

    def importances(self) -> DataFrame:
        """Impurity importance of every feature of the forest, largest first."""
        return self.fit("forest").importances(self.mixed.names, self.spark)
