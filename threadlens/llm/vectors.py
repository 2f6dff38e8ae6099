"""Integer forms of embedding vectors, in Spark and in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components are held within plus and minus this, so that sums of products of 64 components stay exact in 64 bits.
LIMIT = 2**23


def whole(vector: str | Column) -> Column:
    """True for vectors without null, NaN and infinite components; a null vector gives null."""
    return ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def integers(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component x as double, held within `LIMIT`."""
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))).cast("int"))


def matrix(lists: pa.Array, width: int, kind: type = np.int64) -> np.ndarray:
    """One row for each list; all lists have `width` values."""
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def rows_of(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list for each row of a matrix."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * (values.shape[1] if values.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))
