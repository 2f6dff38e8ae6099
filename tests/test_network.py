import numpy as np
import pytest
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.operators.models.features import sparse_components
from threadlens.operators.models.network import Network, _forward, _gradient


def _rings(spark, n=300):
    """Two classes that no line parts: near the origin, and around it."""
    rng = np.random.default_rng(3)
    angle, radius = rng.uniform(0, 2 * np.pi, n), np.where(np.arange(n) % 2, 2.0, 0.4) + rng.normal(0, 0.1, n)
    rows = [([float(r * np.cos(a)), float(r * np.sin(a))], float(i % 2)) for i, (a, r) in enumerate(zip(angle, radius, strict=True))]
    df = spark.createDataFrame(rows, "x array<double>, target double")
    return df.select(array_to_vector("x").alias("features"), "target")


def test_gradient_agrees_with_small_steps():
    net = Network(3, 3, (4, 2), seed=1)
    flat, _ = net._start()
    rng = np.random.default_rng(0)
    x, target = rng.normal(size=(7, 3)), rng.integers(0, 3, 7)
    whole = _gradient(net._cut(flat), x, target)
    for k in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[k], down[k] = up[k] + 1e-6, down[k] - 1e-6
        slope = (_gradient(net._cut(up), x, target)[-1] - _gradient(net._cut(down), x, target)[-1]) / 2e-6
        assert whole[k] == pytest.approx(slope, abs=1e-6)


def test_network_learns_what_no_line_parts_and_ignores_the_partitioning(spark):
    df = _rings(spark)
    model = Network(2, 2, rounds=120).fit(df.repartition(5))
    assert model.transform(df).where("prediction = target").count() > 285
    assert model.losses[-1] < model.losses[0]
    again = Network(2, 2, rounds=15).fit(df.repartition(5)).losses
    assert Network(2, 2, rounds=15).fit(df.coalesce(1)).losses == pytest.approx(again, abs=1e-6)


def test_larger_penalty_gives_smaller_weights(spark):
    df = _rings(spark)
    norms = [Network(2, 2, l2=l2, rounds=40).fit(df).weight_norm() for l2 in (0.0, 0.5, 20.0)]
    assert norms[0] > norms[1] > norms[2]


def test_null_targets_features_and_empty_tables(spark):
    df = _rings(spark, 40)
    none = df.limit(1).select("features", F.lit(None).cast("double").alias("target"))
    assert Network(2, 2, rounds=5).fit(df.unionByName(none)).losses == pytest.approx(Network(2, 2, rounds=5).fit(df).losses)
    model = Network(2, 2, rounds=1).fit(df)
    empty = spark.createDataFrame([(None,), (Vectors.dense(1.0, 2.0),)], T.StructType([T.StructField("features", VectorUDT())]))
    assert [r.prediction is None for r in model.transform(empty).collect()] == [True, False]
    with pytest.raises(ValueError):
        Network(2, 2).fit(df.limit(0))


def test_probabilities_survive_large_inputs():
    net = Network(2, 2)
    out = _forward(net._cut(net._start()[0]), np.array([[1e9, -1e9], [0.0, 0.0]]))[-1]
    assert np.isfinite(out).all() and np.allclose(out.sum(axis=1), 1)


def test_sparse_components_equal_the_dense_ones_up_to_sign(spark):
    rng = np.random.default_rng(5)
    table = rng.poisson(0.4, (80, 12)) * rng.uniform(0.5, 2, 12)
    rows = [(i, Vectors.sparse(12, {j: float(v) for j, v in enumerate(r) if v})) for i, r in enumerate(table)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("id", T.LongType()), T.StructField("v", VectorUDT())]))
    ours = {r.id: r.pca.toArray() for r in sparse_components(df, "v", 4, "pca")(df).collect()}
    centred = StandardScaler(inputCol="v", outputCol="c", withMean=True, withStd=False).fit(df).transform(df)
    dense = {r.id: r.p.toArray() for r in PCA(k=4, inputCol="c", outputCol="p").fit(centred).transform(centred).collect()}
    a, b = (np.array([m[i] for i in range(80)]) for m in (ours, dense))
    assert np.allclose(np.abs(a), np.abs(b), atol=1e-9) and np.allclose(a.mean(axis=0), 0, atol=1e-9)
    centred_table = table - table.mean(axis=0)
    assert np.allclose(np.sort(a.var(axis=0))[::-1], np.sort(np.linalg.eigvalsh(centred_table.T @ centred_table / 80))[::-1][:4])


def test_steps_read_rows_packed_as_matrices(spark, monkeypatch):
    df = spark.createDataFrame([(float(i), float(-i), i % 2) for i in range(2500)], "a double, b double, target int")
    rows = df.coalesce(1).select("target", array_to_vector(F.array("a", "b")).alias("features"))
    kept, summed = [], Network._summed
    monkeypatch.setattr(Network, "_summed", lambda self, packed, flat: kept.append(packed) or summed(self, packed, flat))
    Network(2, 2, rounds=1).fit(rows)
    assert sorted(r.n for r in kept[0].collect()) == [500, 1000, 1000]
