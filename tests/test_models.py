import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.operators.models import classification, clustering
from threadlens.operators.models.features import TextVectors, standardise_columns
from threadlens.plans import model_queries, workflows
from threadlens.plans.workflows import ScorePrediction


def _blobs(spark, n=60):
    rng = random.Random(2)
    rows = [(i, c * 10 + rng.gauss(0, 1), rng.gauss(0, 1) * 0.01, 1.0) for i in range(n) for c in [i % 3]]
    return spark.createDataFrame(rows, "id int, a double, b double, flat double")


def test_kmeans_finds_separate_groups(spark):
    out = clustering.kmeans(_blobs(spark), ["a"], 3).collect()
    assert len(out) == 60 and len({(r.id % 3, r.cluster) for r in out}) == 3


def test_projection_is_centred_and_loadings_are_orthonormal(spark):
    df = _blobs(spark)
    points = clustering.pca_points(df, ["a", "b", "flat"]).select("pc1", "pc2").toPandas()
    assert np.allclose(points.mean(), 0, atol=1e-9) and points.pc1.var() >= points.pc2.var()
    loads = clustering.pca_loadings(df, ["a", "b"]).toPandas().pivot(index="feature", columns="component", values="loading").to_numpy()
    assert np.allclose(loads.T @ loads, np.eye(2), atol=1e-9)


def test_constant_column_standardises_to_zero(spark):
    rows = standardise_columns(_blobs(spark), ["flat", "a"]).agg(F.sum("flat_std").alias("z"), F.stddev_pop("a_std").alias("s")).first()
    assert rows.z == 0.0 and rows.s == pytest.approx(1.0)


def test_text_vectors_have_unit_length_and_known_weights(spark):
    df = spark.createDataFrame([(1, "red fox red"), (2, "red dog"), (3, "zebra")], "id int, body string")
    vectors = TextVectors(df, "body", 2)
    assert vectors.vocabulary == ["dog", "red"]
    out = {r.id: r.text_vector.toArray() for r in vectors.add(df).collect()}
    assert np.linalg.norm(out[2]) == pytest.approx(1) and np.allclose(out[1], [0, 1]) and np.allclose(out[3], 0)
    assert out[2][0] / out[2][1] == pytest.approx((np.log(4 / 2) + 1) / (np.log(4 / 3) + 1))


def _posts(spark, n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        good = rng.random() < 0.5
        body = ("bright happy " if good else "gloomy tired ") + rng.choice(["cat", "dog", "owl"])
        rows.append((i, body, f"c{i % 3}", "2016-01-01 00:00:00", 0.5 if good else -0.5, 20.0 if good else -20.0))
    return spark.createDataFrame(rows, "id int, body string, subreddit string, t string, sentiment double, score double").withColumn("created_ts", F.to_timestamp("t"))


def test_score_models_beat_the_majority_on_separable_posts(spark):
    made = ScorePrediction(_posts(spark), unlabelled=50, exclude=["c2"], scale=True)
    rows = made.accuracies(["forest", "network"]).collect()
    assert all(r.validation > r.majority and r.validation > 0.9 for r in rows)
    assert made.predictions("boosting", rounds=2).count() == 50
    top = made.importances().collect()
    assert sum(r.importance for r in top) == pytest.approx(1.0) and top[0].importance >= top[-1].importance
    assert made.misclassified().count() <= 5


def test_learned_labels_follow_the_words(spark):
    df = _posts(spark).withColumn("label", F.when(F.col("sentiment") > 0, "POSITIVE").otherwise("NEGATIVE"))
    out = classification.learned_label(df.where("id < 200"), df.withColumn("truth", F.col("label")))
    assert out.where("truth <> label").count() == 0 and out.count() == 400


def test_mixed_clusters_cover_every_row(spark):
    out = clustering.kmeans_mixed(_posts(spark), k=2, scale=True)
    assert out.groupBy("cluster").count().count() == 2 and out.count() == 400


def test_boosting_runs_all_rounds(spark, monkeypatch):
    rounds = []
    boosted = classification.boosted_trees
    monkeypatch.setattr(classification, "boosted_trees", lambda **options: rounds.append((model := boosted(**options)).getClassifier().getMaxIter()) or model)
    monkeypatch.setattr(classification, "LabelledModel", lambda train, label, make: make(1, 2))
    monkeypatch.setattr(model_queries, "_score_model", lambda *_: (model := object.__new__(workflows.ScorePrediction)).__dict__.update(seed=1, train=None) or model)
    monkeypatch.setattr(workflows.ScorePrediction, "predictions", lambda self, kind="boosting", **options: self.fit(kind, **options))
    model_queries.gbt_ovr_score(spark, "")
    assert rounds == [100]


def test_text_features_of_the_training_rows_are_made_once(spark, plan):
    from threadlens.operators.models.features import MixedFeatures, reduced_text

    df = _posts(spark, 60)
    mixed = MixedFeatures(df, scale=True, reuse=True)
    assert "regexp_extract_all" not in plan(mixed.transform(df)) and "regexp_extract_all" in plan(mixed.transform(df.where("id < 9")))
    again = {r.id: r.features for r in mixed.transform(df.where("id < 9")).collect()}
    assert again == {r.id: r.features for r in mixed.transform(df).collect() if r.id < 9}
    add = reduced_text(df, components=3, reuse=True)
    assert "regexp_extract_all" not in plan(add(df)) and "regexp_extract_all" in plan(add(df.where("id < 9")))
    assert add(df).columns == [*df.columns, "text_pca"] and add(df).count() == 60
    assert {r.id: r.text_pca for r in add(df).where("id < 9").collect()} == {r.id: r.text_pca for r in add(df.where("id < 9")).collect()}
