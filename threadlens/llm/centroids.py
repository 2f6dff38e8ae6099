"""Lloyd clustering of integer vectors; n-simplex bounds say which centroids can be the nearest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.vectors import integers, matrix, rows_of, whole
from threadlens.session import local_table, written

#: Share of the squared lengths involved by which bounds give way; rounding is far below it.
SLACK = 1e-5
_FLATTEST = 0.05
_LONG_MAX = 2**63 - 1


def squared_distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distance of every point (row) to every other (column)."""
    out = np.empty((len(points), len(others)), np.int64)
    for j, other in enumerate(others):
        gap = points - other
        out[:, j] = np.einsum("ij,ij->i", gap, gap)
    return out


class Simplex:
    """The simplex of some pivots: it turns distances to the pivots into the coordinates of an apex over it.

    The distance of two apexes on the same side of the base is at most that of the two vectors, and that of apexes on
    opposite sides is at least as long.
    """

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots
        between = squared_distances(pivots, pivots).astype(float)
        self._legs = between[0, 1:]
        inner = (self._legs[:, None] + self._legs[None, :] - between[1:, 1:]) / 2
        self._unfold = np.linalg.inv(np.linalg.cholesky(inner)).T if len(pivots) > 1 else np.zeros((0, 0))

    def apexes(self, squares: np.ndarray) -> np.ndarray:
        """From squared distances to the pivots: places along the base, and in the last column the height over it."""
        squares = squares.astype(float)
        along = (squares[:, :1] + self._legs - squares[:, 1:]) / 2 @ self._unfold
        return np.column_stack([along, np.sqrt(np.maximum(squares[:, 0] - (along * along).sum(1), 0))])


def choose_pivots(points: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` of the points, each the one highest over the simplex of those before; flat ones are left out."""
    chosen, longest = points[:1], 0.0
    while 0 < len(chosen) < most:
        heights = Simplex(chosen).apexes(squared_distances(points, chosen))[:, -1]
        longest = max(longest, heights.max())
        if heights.max() <= _FLATTEST * longest:
            break
        chosen = np.vstack([chosen, points[heights.argmax()]])
    return chosen


def bounds(apexes: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between vectors (rows) and centroids (columns) from their apexes."""
    squares, others = (apexes * apexes).sum(1)[:, None], (centres * centres).sum(1)[None, :]
    along = squares + others - 2 * apexes[:, :-1] @ centres[:, :-1].T
    heights = 2 * np.outer(apexes[:, -1], centres[:, -1])
    slack = SLACK * (squares + others)
    return along - heights - slack, along + heights + slack


def nearest(points: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each point: the nearest centroid (ties: the smaller number), its squared distance, centroids compared exactly."""
    low, high = bounds(apexes, centres)
    near = low <= high.min(1)[:, None]
    best, where = np.full(len(points), _LONG_MAX), np.zeros(len(points), np.int32)
    for j, centroid in enumerate(centroids):
        rows = np.flatnonzero(near[:, j])
        gap = points[rows] - centroid
        distance = np.einsum("ij,ij->i", gap, gap)
        closer = distance < best[rows]
        best[rows[closer]], where[rows[closer]] = distance[closer], j
    return where, best, near.sum(1)


def cluster_vectors(vectors: DataFrame, clusters: int = 40, rounds: int = 5, dims: int = 64, salt: str = "2:", pivots: int = 60, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per kept vector: key, cluster, distance (squared), compared (centroids compared exactly), cluster_inertia, inertia,
    centroid_sha256.

    Vectors of exactly `dims` components, none null or non-finite, are kept; components become floor(256 * x), held within
    `vectors.LIMIT`. The kept vectors with the smallest sha256 of `salt` and key are the first centroids (ties: by the
    vector; a null key comes last; all, if there are fewer than `clusters`). Each round assigns every vector to its
    nearest centroid (ties: the smaller number) and moves a non-empty centroid to the floor of its vectors' mean; then
    vectors are assigned once more. Repeated rows count each. An empty table gives an empty result. Only `key` and `vector`
    are read of the table. Sums of distances stop at the largest long.

    Exact distances to the pivots, taken once (from the first vectors by hash), are kept as apex coordinates beside the
    vectors; in every round they bound the distances to all centroids, and only centroids that can be the nearest are
    compared. Vectors that spread in all directions need nearly as many pivots as components for close bounds.
    Tasks return sums per cluster; centroids are the only thing the driver holds.
    """
    spark = vectors.sparkSession
    kept = vectors.where((F.size(vector) == dims) & whole(vector)).select(F.col(key).alias("_key"), integers(vector).alias("_point"))
    order = F.sha2(F.concat(F.lit(salt), F.col("_key").cast("string")), 256)
    first = kept.orderBy(order.asc_nulls_last(), "_point").limit(max(clusters, 2 * pivots)).collect()
    kind = vectors.schema[key].dataType
    if not first:
        return spark.createDataFrame([], T.StructType([T.StructField(key, kind)])).selectExpr(key, "0 cluster", "0L distance", "0 compared", "0L cluster_inertia", "0L inertia", "'' centroid_sha256")
    pool = np.array([r["_point"] for r in first], np.int64)
    centroids, simplex = pool[:clusters], Simplex(choose_pivots(pool, pivots))
    width = len(simplex.pivots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(squared_distances(matrix(batch.column(1), dims), simplex.pivots))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), rows_of(apexes, pa.float64())], ["_key", "_point", "_apex"])

    cached = written(kept.mapInArrow(project, T.StructType([*kept.schema.fields, T.StructField("_apex", T.ArrayType(T.DoubleType()))])), "apexes")

    def assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple]:
        centres = simplex.apexes(squared_distances(centroids, simplex.pivots))
        for batch in batches:
            points = matrix(batch.column("_point"), dims)
            yield batch, points, *nearest(points, matrix(batch.column("_apex"), width, float), centroids, centres)

    def sums_under(centroids: np.ndarray) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
            for _, points, where, _, _ in assigned(batches, centroids):
                member = where[None, :] == np.arange(len(centroids))[:, None]
                count += member.sum(1)
                total += (member.astype(float) @ points.astype(float)).astype(np.int64)
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), rows_of(total[used], pa.int64())], ["cluster", "n", "total"])

        parts = cached.mapInArrow(work, "cluster int, n long, total array<long>")
        return parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(dims)]).alias("total"))

    for _ in range(rounds):
        moved = centroids.copy()
        for row in sums_under(centroids).collect():
            moved[row["cluster"]] = [int(t) // row["n"] for t in row["total"]]
        centroids = moved

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, where, best, compared in assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(where, pa.int32()), pa.array(best), pa.array(compared, pa.int32())], [key, "cluster", "distance", "compared"])

    fields = [T.StructField(key, kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()), T.StructField("compared", T.IntegerType())]
    members = written(cached.mapInArrow(label, T.StructType(fields)), "members")
    spread = {r["cluster"]: int(r["total"]) for r in members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    inertia = min(sum(spread.values()), _LONG_MAX)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()), T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())]
    return members.join(local_table(spark, [(j, min(total, _LONG_MAX), inertia, digests[j]) for j, total in sorted(spread.items())], T.StructType(facts)), "cluster").select(
        key, "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid_sha256")
