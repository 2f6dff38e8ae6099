"""A feed-forward classifier with a weight penalty, trained from gradients that Spark adds up over all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.session import written

Layers = list[tuple[np.ndarray, np.ndarray]]


def _forward(layers: Layers, x: np.ndarray) -> list[np.ndarray]:
    """Activations of every layer: logistic units inside, class probabilities at the end."""
    out = [x]
    for i, (weights, bias) in enumerate(layers):
        z = out[-1] @ weights + bias
        if i < len(layers) - 1:
            out.append(1 / (1 + np.exp(-np.clip(z, -500, 500))))
        else:
            e = np.exp(z - z.max(axis=1, keepdims=True))
            out.append(e / e.sum(axis=1, keepdims=True))
    return out


def _gradient(layers: Layers, x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Sum over the rows of the gradient of the log loss, and the loss itself as the last number."""
    acts = _forward(layers, x)
    rows = np.arange(len(target))
    loss = -np.log(np.maximum(acts[-1][rows, target], 1e-300)).sum()
    error = acts[-1].copy()
    error[rows, target] -= 1
    parts: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        parts = [(acts[i].T @ error).ravel(), error.sum(axis=0), *parts]
        if i:
            error = error @ layers[i][0].T * acts[i] * (1 - acts[i])
    return np.concatenate([*parts, [loss]])


#: Rows that are kept together as one matrix.
_PACKED_ROWS = 1000


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `x` and `target` as matrices of up to `_PACKED_ROWS` rows, which every step reads without unpacking them by value."""
    for batch in batches:
        for at in range(0, batch.num_rows, _PACKED_ROWS):
            part = batch.slice(at, _PACKED_ROWS)
            x, target = (c.to_numpy(zero_copy_only=False) for c in (part.column("x").flatten(), part.column("target")))
            yield pa.RecordBatch.from_pydict({"n": pa.array([part.num_rows], pa.int64()), "x": [x.astype(np.float64).tobytes()], "target": [target.astype(np.int32).tobytes()]})


class Network:
    """Estimator in the manner of MLlib's: `fit` on rows with `features` (vector) and `target` (class number).

    Every step runs over all rows: each task adds up its rows' gradient, Spark adds up the tasks' sums place by place, and
    the driver, which only ever holds numbers as many as weights, moves the weights (adaptive moments). The penalty is `l2`
    times half the squared weights for each `batch` rows; biases are not penalised. Training ends early when the penalised
    loss stays within `tolerance` for ten steps. Rows whose target or features are null are left out; without rows it raises.
    """

    def __init__(self, inputs: int, classes: int, hidden: Sequence[int] = (8, 4), l2: float = 0.05, batch: int = 200, rounds: int = 200, rate: float = 0.05, tolerance: float = 1e-5, seed: int = 42):
        self.sizes = [inputs, *hidden, classes]
        self.l2, self.rounds, self.rate, self.tolerance, self.seed = l2 / batch, rounds, rate, tolerance, seed

    def _cut(self, flat: np.ndarray) -> Layers:
        layers, at = [], 0
        for a, b in zip(self.sizes, self.sizes[1:], strict=False):
            layers.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return layers

    def _start(self) -> tuple[np.ndarray, np.ndarray]:
        """First weights, and a mask of those that are penalised."""
        rng = np.random.default_rng(self.seed)
        flat, mask = [], []
        for a, b in zip(self.sizes, self.sizes[1:], strict=False):
            bound = np.sqrt(2.0 / (a + b))
            flat += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
            mask += [np.ones(a * b), np.zeros(b)]
        return np.concatenate(flat), np.concatenate(mask)

    def _summed(self, rows: DataFrame, flat: np.ndarray) -> np.ndarray:
        layers, width = self._cut(flat), self.sizes[0]

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(flat) + 1)
            for batch in batches:
                for x, target in zip(batch.column("x"), batch.column("target")):
                    matrix = np.frombuffer(x.as_buffer(), np.float64).reshape(-1, width)
                    total += _gradient(layers, matrix, np.frombuffer(target.as_buffer(), np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "value"])

        sums = rows.mapInArrow(work, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(len(flat) + 1)
        for r in sums:
            out[r["place"]] = r["value"]
        return out

    def fit(self, df: DataFrame) -> NetworkModel:
        known = df.where("target is not null and features is not null").select(vector_to_array("features").alias("x"), F.col("target").cast("int").alias("target"))
        rows = written(known.mapInArrow(_packed, "n bigint, x binary, target binary"), "network")
        n = rows.agg(F.sum("n")).first()[0]
        if not n:
            raise ValueError("no rows to train on")
        flat, mask = self._start()
        first, second, best, idle = np.zeros(len(flat)), np.zeros(len(flat)), np.inf, 0
        losses = []
        for step in range(1, self.rounds + 1):
            total = self._summed(rows, flat)
            losses.append(float(total[-1] / n + self.l2 / 2 * (mask * flat) @ flat))
            idle = 0 if losses[-1] < best - self.tolerance else idle + 1
            best = min(best, losses[-1])
            if idle >= 10:
                break
            gradient = total[:-1] / n + self.l2 * mask * flat
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient * gradient
            flat = flat - self.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        return NetworkModel(self._cut(flat), losses)


class NetworkModel:
    """Trained weights by layer, and the penalised loss before every step."""

    def __init__(self, layers: Layers, losses: list[float]):
        self.layers, self.losses = layers, losses

    def weight_norm(self) -> float:
        return float(np.sqrt(sum((w * w).sum() for w, _ in self.layers)))

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with `prediction`, the likeliest class (ties: smallest number); null where features are null."""
        layers = self.layers

        @F.pandas_udf("double")
        def likeliest(x: pd.Series) -> pd.Series:
            out = pd.Series(np.nan, index=x.index, dtype="object")
            known = x.notna()
            if known.any():
                out[known] = _forward(layers, np.stack(x[known].to_list()))[-1].argmax(axis=1).astype(float)
            return out.where(known, None)

        return df.withColumn("prediction", likeliest(F.when(F.col("features").isNotNull(), vector_to_array("features"))))
