"""Locally weighted regression of weekly counts (Cleveland 1979)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


#: Points that are fitted at a time: this bounds the memory of the windows beside them.
CHUNK_CELLS = 2_000_000


def _windows(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For rising x: where the k nearest points of each point start, and the distance of the farthest of these."""
    n, at = len(x), np.arange(len(x))
    low, high = np.maximum(at - k + 1, 0), np.minimum(at, n - k)
    while (low < high).any():  # the first start at which the left end is no farther than the point behind the right end
        middle = (low + high) // 2
        moves = (x - x[middle] > x[np.minimum(middle + k, n - 1)] - x) & (low < high)
        low, high = np.where(moves, middle + 1, low), np.where(moves, high, np.minimum(middle, high))
    return low, np.maximum(x - x[low], x[low + k - 1] - x)


def _fits(x: np.ndarray, y: np.ndarray, robust: np.ndarray, starts: np.ndarray, reach: np.ndarray, k: int, fit: np.ndarray) -> np.ndarray:
    """Weighted straight lines through the windows, each at its own point; points without weight keep `fit`."""
    out = fit.copy()
    step = max(1, CHUNK_CELLS // k)
    for a in range(0, len(x), step):
        rows = slice(a, a + step)
        near = starts[rows, None] + np.arange(k)
        d = x[near] - x[rows, None]
        far = reach[rows, None]
        w = np.where(far > 0, np.clip(1 - (np.abs(d) / np.where(far > 0, far, 1)) ** 3, 0, None) ** 3, d == 0) * robust[near]
        total = w.sum(1)
        some = total > 0
        share = w / np.where(some, total, 1)[:, None]
        mean_d, mean_y = (share * d).sum(1), (share * y[near]).sum(1)
        gap = d - mean_d[:, None]
        spread = (share * gap * gap).sum(1) * total
        slope = np.divide((share * gap * (y[near] - mean_y[:, None])).sum(1) * total, spread, out=np.zeros(len(total)), where=spread > 1e-12)
        out[rows] = np.where(some, mean_y - slope * mean_d, out[rows])
    return out


def _smooth(x: np.ndarray, y: np.ndarray, frac: float, passes: int) -> np.ndarray:
    """Fitted values of one series with rising x."""
    n = len(x)
    if n == 0:
        return y.copy()
    k = min(n, max(int(frac * n + 1e-10), 2))
    starts, reach = _windows(x, k)
    robust, fit = np.ones(n), y.copy()
    exact = 1e-9 * max(1.0, float(np.abs(y).max(initial=0.0)))  # residuals up to this are rounding
    for step in range(passes + 1):
        fit = _fits(x, y, robust, starts, reach, k, fit)
        apart = np.abs(y - fit)
        scale = np.median(apart)
        if scale <= exact and (apart > exact).any():  # most points lie on the curve: the others set the scale
            scale = np.median(apart[apart > exact])
        if step == passes or scale <= exact:
            break
        robust = np.clip(1 - ((y - fit) / (6 * scale)) ** 2, 0, None) ** 2
    return fit


def lowess(
    df: DataFrame, group: str = "subreddit", x: str = "week", y: str = "post_count", frac: float = 0.2, passes: int = 3
) -> DataFrame:
    """Smoothed series per group of weekly counts.

    The input is already aggregated to one row per group and week, so a group's size is the number of weeks
    in the data, whatever the number of posts. The k nearest of a point are a run of the sorted series, found by bisection,
    and the lines of all points are fitted as arrays, some windows at a time. Of several points at one place, k at most count.
    """

    def per_group(points: pd.DataFrame) -> pd.DataFrame:
        points = points.dropna(subset=[x, y]).sort_values(x)
        xs, ys = points[x].to_numpy(float), points[y].to_numpy(float)
        return pd.DataFrame({group: points[group], x: points[x], "smoothed": _smooth(xs, ys, frac, passes)})

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = f"`{group}` {kinds[group]}, `{x}` {kinds[x]}, smoothed double"
    return df.select(group, x, y).groupBy(group).applyInPandas(per_group, schema)
