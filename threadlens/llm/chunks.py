"""Work that is done once for each distinct chunk of text in a Python worker, and batches of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Memo(dict):
    """Results of a pure function by its argument; emptied when it holds `limit` of them, which bounds memory only."""

    def __init__(self, work: Callable, limit: int):
        super().__init__()
        self._work, self._limit = work, limit

    def __missing__(self, key):
        value = self._work(key)
        if len(self) >= self._limit:
            self.clear()
        self[key] = value
        return value


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most_chars: int = 4_000_000, most_rows: int = 1000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of rows with a bounded amount of text each (one row at least), and their texts; null becomes the empty text."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        cuts, size = [0], 0
        for i, n in enumerate(pc.fill_null(pc.utf8_length(column), 0).to_pylist()):
            if i > cuts[-1] and (size + n > most_chars or i - cuts[-1] >= most_rows):
                cuts.append(i)
                size = 0
            size += n
        if len(column):
            for start, end in zip(cuts, [*cuts[1:], len(column)], strict=True):
                yield batch.slice(start, end - start), ["" if t is None else t for t in column.slice(start, end - start).to_pylist()]


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    """One list of int32 for each little-endian string of 32-bit ids."""
    ends = np.zeros(len(encoded) + 1, np.int32)
    np.cumsum([len(e) // 4 for e in encoded], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(encoded), "<i4")))
