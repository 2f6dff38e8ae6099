"""K-means, principal components and the tables drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.models.features import MixedFeatures, assemble, standardise


def kmeans(df: DataFrame, columns: Sequence[str], k: int, seed: int = 42, scale: bool = True) -> DataFrame:
    """Add `cluster` from k-means over standardised (or raw) columns."""
    stages = [assemble(columns), standardise()] if scale else [assemble(columns, "features")]
    model = Pipeline(stages=[*stages, KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")]).fit(df)
    return model.transform(df).drop("raw_features", "features")


def kmeans_mixed(df: DataFrame, k: int = 5, seed: int = 42, scale: bool = False, **features) -> DataFrame:
    """Add `cluster` from k-means over community, text, time and sentiment together."""
    made = MixedFeatures(df, scale=scale, reuse=True, **features).transform(df)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(made)
    return model.transform(made).drop("features", "raw_features")


def _fit_pca(df: DataFrame, columns: Sequence[str], k: int, scale: bool):
    stages = [assemble(columns), standardise(scale=scale), PCA(k=k, inputCol="features", outputCol="components")]
    return Pipeline(stages=stages).fit(df)


def pca_points(df: DataFrame, columns: Sequence[str], k: int = 2, scale: bool = True) -> DataFrame:
    """Add coordinates pc1..pck; columns are always centred, and scaled unless told not to."""
    points = _fit_pca(df, columns, k, scale).transform(df)
    xs = vector_to_array("components")
    return points.select(*df.columns, *[xs[i].alias(f"pc{i + 1}") for i in range(k)])


def pca_loadings(df: DataFrame, columns: Sequence[str], k: int = 2, scale: bool = True) -> DataFrame:
    """Long table (component, feature, loading, place by size of loading, signed_place)."""
    matrix = _fit_pca(df, columns, k, scale).stages[-1].pc.toArray()
    rows = []
    for c in range(k):
        loads = [(float(matrix[i, c]), name) for i, name in enumerate(columns)]
        by_size = {n: i + 1 for i, (_, n) in enumerate(sorted(loads, key=lambda v: (-abs(v[0]), v[1])))}
        signed = {n: i + 1 for i, (_, n) in enumerate(sorted(loads, key=lambda v: (-v[0], v[1])))}
        rows += [(c + 1, n, v, by_size[n], signed[n]) for v, n in loads]
    return df.sparkSession.createDataFrame(
        rows, "component int, feature string, loading double, place int, signed_place int"
    )


def cluster_profile(df: DataFrame, columns: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean of every feature per cluster, the cluster's number kept."""
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])
