"""Hard negatives by inner product: intervals from rotated one-bit codes filter the rows, integers decide."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.vectors import integers, matrix, whole
from threadlens.session import written

PACK_ROWS, PACK_ANCHORS = 4096, 256
BITS_EACH, PLANES = 8, 6
#: About so many packs of anchors are held by one task, with their best rows; further anchors go to further tasks.
KEPT_PACKS = 128
#: Tasks for each core, packs in a tile at least (a task's first packs are scored with few scores to go by), and how many
#: tiles of rows cost as much to shuffle, by what their tasks give out, as one more copy of the rows.
TASKS_PER_CORE, TILE_PACKS, TILES_PER_COPY = 2, 2, 29
_LAST, _LOW, _HIGH = np.iinfo(np.int64).max, -(2**62), 2**62


def rotation(dims: int, bits: int, seed: int = 12) -> np.ndarray:
    """bits x dims with orthonormal columns: turns a vector into `bits` directions without changing inner products."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dims)))[0]


@dataclass
class Codes:
    """Signs of rotated unit vectors, packed into words, with the length of the code's vector and its cosine with the vector."""

    words: np.ndarray
    length: np.ndarray
    align: np.ndarray
    norm: np.ndarray

    @classmethod
    def of(cls, heads: np.ndarray, turn: np.ndarray) -> Codes:
        norm = np.sqrt((heads.astype(float) ** 2).sum(1))
        unit = heads / np.where(norm > 0, norm, 1)[:, None]
        signs = unit @ turn.T >= 0
        back = np.where(signs, 1.0, -1.0) / np.sqrt(len(turn)) @ turn
        length = np.sqrt((back * back).sum(1))
        return cls(np.packbits(signs, axis=1).view(np.uint64), length, (back * unit).sum(1) / length, norm)


def intervals(codes: Codes, anchors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of coded vectors (rows) with anchors (columns).

    With u and q the unit vectors, c the code's unit vector, t = <c, u> and b = <c, q>, the rests of u and q beside c have
    lengths sqrt(1 - t^2) and sqrt(1 - b^2), so <u, q> is within the product of these of t * b. b is estimated by popcounts
    of the code against the bit planes of the rotated anchor; the length of what rounding to planes takes away widens it.
    """
    norm = np.sqrt((anchors.astype(float) ** 2).sum(1))
    turned = anchors / np.where(norm > 0, norm, 1)[:, None] @ turn.T
    base = turned.min(1)
    step = np.maximum(turned.max(1) - base, 1e-12) / (2**PLANES - 1)
    levels = np.rint((turned - base[:, None]) / step[:, None]).astype(np.uint8)
    rounded = base[:, None] + step[:, None] * levels
    missed = np.sqrt(((turned - rounded) ** 2).sum(1))
    counts = np.zeros((len(codes.words), len(anchors)))
    for plane in range(PLANES):
        bits = np.packbits((levels >> plane) & 1, axis=1).view(np.uint64)
        held = np.zeros(counts.shape, np.uint16)
        for word in range(bits.shape[1]):
            held += np.bitwise_count(codes.words[:, word, None] & bits[None, :, word])
        counts += held * float(2**plane)
    ones = np.bitwise_count(codes.words).sum(1, dtype=np.int64)
    estimate = (2 * (ones[:, None] * base + counts * step) - rounded.sum(1)) / np.sqrt(len(turn)) / codes.length[:, None]
    wide = missed / codes.length[:, None]
    rest = np.sqrt(np.maximum(1 - codes.align**2, 0))[:, None] * np.sqrt(1 - np.clip(np.abs(estimate) - wide, 0, 1) ** 2)
    middle, half = codes.align[:, None] * estimate, np.abs(codes.align)[:, None] * wide + rest + 1e-9
    scale = codes.norm[:, None] * norm
    return scale * (middle - half), scale * (middle + half)


@dataclass
class Pack:
    """Some rows: row numbers, ids (a null one comes last), labels, the first `dims` components, and those behind them."""

    row: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    heads: np.ndarray
    tails: dict[int, np.ndarray]

    @classmethod
    def of(cls, row: pa.Array, ids: pa.Array, label: pa.Array, points: pa.Array, dims: int) -> Pack:
        widths = points.value_lengths().to_numpy(zero_copy_only=False)
        if (widths == dims).all():
            heads, tails = matrix(points, dims), {}
        else:
            lists = [np.array(p, np.int64) for p in points.to_pylist()]
            heads, tails = np.zeros((len(lists), dims), np.int64), {i: p[dims:] for i, p in enumerate(lists) if len(p) > dims}
            for i, p in enumerate(lists):
                heads[i, : len(p[:dims])] = p[:dims]
        return cls(row.to_numpy(), ids.fill_null(_LAST).to_numpy(), label.to_numpy(), heads, tails)

    def tail_norms(self) -> np.ndarray:
        out = np.zeros(len(self.row))
        for i, tail in self.tails.items():
            out[i] = np.sqrt((tail.astype(float) ** 2).sum())
        return out

    def scores(self, rows: np.ndarray, head: np.ndarray, tail: np.ndarray | None) -> np.ndarray:
        """Exact inner products of some rows with one anchor; components that one of the two lacks count as 0."""
        out = self.heads[rows] @ head
        if tail is not None and self.tails:
            for k, i in enumerate(rows):
                if (own := self.tails.get(int(i))) is not None:
                    n = min(len(own), len(tail))
                    out[k] += int(own[:n] @ tail[:n])
        return out


class Best:
    """The first `n` rows (higher scores, then smaller ids) of each anchor and slot of one pack of anchors."""

    def __init__(self, anchors: Pack, windows: np.ndarray, n: int):
        self.anchors, self.windows, self.n = anchors, windows, n
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.floor = windows[:, :, 0].astype(float)

    def meet(self, pack: Pack, codes: Codes, turn: np.ndarray, same: bool) -> int:
        """Takes the rows of a pack whose label is the anchor's, or is not; returns how many were scored."""
        low, high = intervals(codes, self.anchors.heads, turn)
        rest = np.outer(pack.tail_norms(), self.anchors.tail_norms()) + 1e-6
        low, high = low - rest, high + rest
        fits = (pack.label[:, None] == self.anchors.label) == same
        fits &= pack.row[:, None] != self.anchors.row
        survives = np.zeros((self.windows.shape[1], *fits.shape), bool)
        for slot in range(self.windows.shape[1]):
            least, most = self.windows[:, slot, 0], self.windows[:, slot, 1]
            floor = self.floor[:, slot]
            if len(low) >= self.n:  # rows surely inside: the n-th highest lower bound of them is one for the n-th score
                surely = np.where(fits & (low >= least) & (high <= most), low, -np.inf)
                floor = np.maximum(floor, np.partition(surely, -self.n, axis=0)[-self.n])
            survives[slot] = fits & (high >= floor) & (low <= most)
        scored = 0
        for q in np.flatnonzero(survives.any((0, 1))):
            rows = np.flatnonzero(survives[:, :, q].any(0))
            scores = pack.scores(rows, self.anchors.heads[q], self.anchors.tails.get(int(q)))
            scored += len(rows)
            for slot, (least, most) in enumerate(self.windows[q]):
                inside = (scores >= max(least, self.floor[q, slot])) & (scores <= most)
                if inside.any():
                    self._keep(int(q), slot, scores[inside], pack.ids[rows[inside]])
        return scored

    def _keep(self, q: int, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if (q, slot) in self.found:
            old = self.found[q, slot]
            scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
        first = np.lexsort((ids, -scores))[: self.n]
        self.found[q, slot] = scores[first], ids[first]
        if len(first) == self.n:
            self.floor[q, slot] = scores[first[-1]]

    def rows(self) -> pa.RecordBatch:
        keys = [(self.anchors.row[q], slot, s, None if i == _LAST else i) for (q, slot), (scores, ids) in self.found.items() for s, i in zip(scores.tolist(), ids.tolist(), strict=True)]
        columns = list(zip(*keys, strict=True)) if keys else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor", "slot", "score", "other"])


_COLUMNS = ["row", "ids", "label", "points"]


def grid(rows: int, anchors: int, cores: int) -> tuple[int, int]:
    """In how many tiles of rows and groups of anchors tables are cut, so that each pair of them is a task's work."""
    wanted = TASKS_PER_CORE * cores
    groups = max(1, -(-anchors // (KEPT_PACKS * PACK_ANCHORS)), math.isqrt(wanted // TILES_PER_COPY))
    return max(1, min(-(-wanted // groups), -(-rows // (TILE_PACKS * PACK_ROWS)))), groups


def _share(count: int) -> Column:
    """A number below `count` for each row."""
    return F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")


def _each(count: int) -> Column:
    """All numbers below `count`, in a row of their own each."""
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def _packs(batch: pa.RecordBatch, most: int, dims: int) -> Iterator[tuple[Pack, pa.RecordBatch]]:
    """Parts of about equal size of a batch, each with at most so many rows."""
    size = max(1, -(-batch.num_rows // max(1, -(-batch.num_rows // most))))
    for start in range(0, batch.num_rows, size):
        part = batch.slice(start, size)
        yield Pack.of(*(part.column(c) for c in _COLUMNS), dims), part


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first n rows of each anchor and slot, with their places."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("other"))
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def mine_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), dims: int = 64,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null label, a null vector or a null or non-finite component take no part. Components become floor(256 * x),
    held within `vectors.LIMIT`; a row's score is its inner product with the anchor, where components that one of two
    vectors lacks count as 0 (an empty vector scores 0). Anchors are rows whose key is divisible by `every`. Higher scores come first, ties by smaller
    key, a null key last. An anchor's positives are its first other rows of the same label; for each, the first rows of
    other labels with share[0] * positive <= share[1] * score <= share[1] * positive are returned. Repeated rows count as
    rows of their own. Empty tables give an empty result. Only the three named columns are read.

    Tiles of rows meet groups of anchors in a task each, once for the positives and once for the negatives: the anchors
    come first and are held, the rows run past them in packs with their one-bit codes, and tasks give out only their
    first rows. All of this goes by shuffles, the driver holds counts only. Codes cover the first `dims` components; the
    lengths of what lies behind widen the interval.
    """
    turn = rotation(dims, BITS_EACH * dims)
    kept = vectors.where(F.col(label).isNotNull() & whole(vector)).select(
        F.col(key).cast("long").alias("ids"), F.col(label).cast("int").alias("label"), integers(vector).alias("points"))
    numbered = written(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    anchors = numbered.where(F.col("ids") % every == 0)
    total, asking = numbered.agg(F.count("*"), F.count_if(F.col("ids") % every == 0)).first()
    tiles, groups = grid(total, asking, vectors.sparkSession.sparkContext.defaultParallelism)

    def meetings(asked: DataFrame, same: bool, n: int) -> DataFrame:
        """Every anchor with every row: anchor, slot, score, other of the best rows of each tile."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: list[Best] = []
            for batch in batches:
                first = batch.num_rows - int(np.count_nonzero(batch.column("met")))  # anchors come before the rows they meet
                for asking, part in _packs(batch.slice(0, first), PACK_ANCHORS, dims):
                    windows = part.column("windows").flatten().to_numpy().reshape(part.num_rows, -1, 2)
                    kept.append(Best(asking, windows, n))
                for pack, _ in _packs(batch.slice(first), PACK_ROWS, dims) if kept else ():
                    codes = Codes.of(pack.heads, turn)
                    for best in kept:
                        best.meet(pack, codes, turn, same)
            for best in kept:
                yield best.rows()

        held = asked.select(F.lit(0).alias("met"), *_COLUMNS, "windows", _share(groups).alias("group"), _each(tiles).alias("tile"))
        met = numbered.select(F.lit(1).alias("met"), *_COLUMNS, F.lit(None).cast("array<long>").alias("windows"), _each(groups).alias("group"), _share(tiles).alias("tile"))
        cells = held.union(met).repartitionById(tiles * groups, F.col("tile") * groups + F.col("group")).sortWithinPartitions("met")
        return _first(cells.drop("group", "tile").mapInArrow(work, "anchor long, slot int, score long, other long"), n)

    if not total:
        return numbered.selectExpr("ids anchor_id", "ids positive_id", "0 rank", "ids negative_id", "ids positive_score", "ids negative_score")
    near = meetings(anchors.withColumn("windows", F.array(F.lit(_LOW).cast("long"), F.lit(_HIGH).cast("long"))), True, positives)
    chosen = near.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "score", "other"))).alias("near"))
    asked = written(anchors.join(written(chosen, "positives").hint("merge"), "row"), "anchors")
    none = f"array({_HIGH}L, {_LOW}L)"
    window = f"array((p.score * {share[0]} + if(p.score > 0, {share[1] - 1}, 0)) div {share[1]}, p.score)"  # the least whole score, and the most
    filled = f"concat(transform(near, p -> {window}), array_repeat({none}, {positives} - size(near)))"
    far = meetings(asked.withColumn("windows", F.expr(f"flatten({filled})")), False, negatives)
    positive = F.get("near", F.col("slot"))
    return far.join(asked.select(F.col("row").alias("anchor"), "ids", "near").hint("merge"), "anchor").select(
        F.col("ids").alias("anchor_id"), positive["other"].alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), positive["score"].alias("positive_score"), F.col("score").alias("negative_score"))
