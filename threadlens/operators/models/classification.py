"""Classifiers over event labels, score classes and sentiment labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.models.features import TextVectors, assemble, one_hot, reduced_text
from threadlens.operators.sentiment import NEGATIVE, POSITIVE


def random_forest(trees: int = 100, depth: int = 6, min_leaf: int = 1, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed, featuresCol="features", labelCol="target"
    )


def boosted_trees(rounds: int = 100, depth: int = 6, min_leaf: int = 50, seed: int = 42) -> OneVsRest:
    """Gradient boosting per class against the rest, since the boosted classifier itself is binary."""
    base = GBTClassifier(maxIter=rounds, maxDepth=depth, minInstancesPerNode=min_leaf, seed=seed, featuresCol="features", labelCol="target")
    return OneVsRest(classifier=base, featuresCol="features", labelCol="target", parallelism=4)


def neural_network(inputs: int, classes: int, hidden: Sequence[int] = (8, 4), rounds: int = 200, seed: int = 42):
    """Feed-forward network with logistic hidden units; the solver is l-bfgs and has no L2 term."""
    return MultilayerPerceptronClassifier(
        layers=[inputs, *hidden, classes], maxIter=rounds, seed=seed, featuresCol="features", labelCol="target"
    )


class LabelledModel:
    """A classifier with text labels: indexes them, fits, and turns predictions back into labels."""

    def __init__(self, train: DataFrame, label: str, build):
        """`build(inputs, classes)` returns the estimator for that vector length and class count."""
        self.label = label
        self.indexer = StringIndexer(inputCol=label, outputCol="target", handleInvalid="skip").fit(
            train.withColumn(label, F.col(label).cast("string"))
        )
        indexed = self._indexed(train)
        inputs = indexed.select("features").first()[0].size
        self.model = build(inputs, len(self.indexer.labels)).fit(indexed)

    def _indexed(self, df: DataFrame) -> DataFrame:
        return self.indexer.transform(df.withColumn(self.label, F.col(self.label).cast("string")))

    def predict(self, df: DataFrame, output: str = "predicted") -> DataFrame:
        """Add the predicted label; the rows need no label of their own."""
        scored = self.model.transform(df)
        named = IndexToString(inputCol="prediction", outputCol=output, labels=self.indexer.labels).transform(scored)
        return named.select(*df.columns, output)

    def accuracy(self, df: DataFrame) -> float:
        scored = self.model.transform(self._indexed(df))
        return MulticlassClassificationEvaluator(labelCol="target", metricName="accuracy").evaluate(scored)

    def importances(self, names: Sequence[str], spark) -> DataFrame:
        """Impurity importance per feature of a tree ensemble with its deviation over the trees, largest first."""
        values = self.model.featureImportances.toArray()
        trees = [t.featureImportances.toArray() for t in self.model.trees]
        rows = []
        for i, name in enumerate(names):
            per_tree = [float(t[i]) for t in trees]
            mean = sum(per_tree) / len(per_tree)
            rows.append((name, float(values[i]), (sum((v - mean) ** 2 for v in per_tree) / len(per_tree)) ** 0.5))
        return spark.createDataFrame(rows, "feature string, importance double, deviation double").orderBy(
            F.desc("importance"), "feature"
        )


def majority_share(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always naming the most frequent label, one row."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("majority_share"))


class EventFeatures:
    """Vectors for event classification: reduced text, community one-hot, activity level and ratio.

    Vocabulary and projection are fitted on the training rows; pass all rows as `train` for the leaky variant.
    """

    def __init__(self, train: DataFrame, text: str = "body", community: str = "subreddit", size: int = 1000, components: int = 100, stopwords: Sequence[str] = ()):
        self.add_text = reduced_text(train, text, size, components, stopwords)
        self.encoder = Pipeline(stages=one_hot(community, "community_vector")).fit(train)
        self.assembler = assemble(["text_pca", "community_vector", "activity_level", "activity_ratio"], "features")

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` carries activity_level and activity_ratio (see `activity_level`)."""
        made = self.encoder.transform(self.add_text(df))
        return self.assembler.transform(made).drop("text_pca", "community_vector", "community_vector_index")


def learned_label(train: DataFrame, df: DataFrame, truth: str = "label", text: str = "body", size: int = 1000, stopwords: Sequence[str] = (), output: str = "label") -> DataFrame:
    """Label provider trained on labelled rows: logistic regression over capped TF-IDF."""
    vectors = TextVectors(train, text, size, stopwords)
    ready = vectors.add(train, "features").withColumn("target", (F.col(truth) == POSITIVE).cast("double"))
    model = LogisticRegression(featuresCol="features", labelCol="target", regParam=0.01).fit(ready)
    scored = model.transform(vectors.add(df.drop(output), "features"))
    label = F.when(F.col("prediction") == 1.0, POSITIVE).otherwise(NEGATIVE)
    return scored.withColumn(output, label).select(*[c for c in df.columns if c != output], output)
