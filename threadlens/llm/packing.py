"""Packing of tokenised documents into sequences: best-fit decreasing per partition, certified by lower bounds."""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadlens.llm.bpe import byte_names
from threadlens.llm.chunks import Memo, slices
from threadlens.llm.common import texts
from threadlens.session import written

_PLAIN = "ɐ"
_REMEMBERED = 600_000


class ChunkTokenizer:
    """Ids of a tokenizers file whose pieces never cross white space, chunk by chunk (between spaces and line ends).

    Each distinct chunk is given to the library once. Chunks of characters below U+0250 are lower-cased and cut into pieces
    here, so that only distinct pieces go to the library's model; all others go to the library as they are.
    """

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        self._name = {b: c for c, b in byte_names().items()}
        # Fixed value: the pattern that the vocabulary file names.
        self._cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self._model = self._library.model
        self._pieces, self.chunks = Memo(self._piece, _REMEMBERED), Memo(self._chunk, _REMEMBERED)

    def _piece(self, piece: str) -> bytes:
        return array("i", [t.id for t in self._model.tokenize("".join(map(self._name.__getitem__, piece.encode())))]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if max(chunk) < _PLAIN and "<|" not in chunk and chunk.isprintable() and unicodedata.is_normalized("NFC", chunk):
            return b"".join(map(self._pieces.__getitem__, self._cut.findall(chunk.lower())))
        return array("i", self._library.encode(chunk, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def load(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every document, `end` after its last id.

    A document longer than `capacity` is cut into pieces of it, the last as long as remains. Null and empty texts have the
    end id alone. Repeated rows stay.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, last, width = load(path), array("i", [end]).tobytes(), 4 * capacity
        for rows, strings in slices(batches):
            out: list[tuple] = []
            for doc, text in zip(rows.column(0).to_pylist(), strings, strict=True):
                ids = tokenizer.encode(text) + last
                out += [(doc, k, k * capacity, len(cut) // 4, cut) for k, at in enumerate(range(0, len(ids), width)) for cut in (ids[at : at + width],)]
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return texts(docs).mapInArrow(work, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Fewest bins that `lengths` can need, the best of three families of dual feasible functions."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    sizes = np.arange(capacity + 1)
    best = -(-int((count * sizes).sum()) // capacity)
    many, mass = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(count * sizes)])
    for small in range(1, capacity // 2 + 1):  # lengths over capacity - small fill a bin, those under small weigh nothing
        large = int(many[-1] - many[capacity - small + 1])
        best = max(best, large - (-int(mass[capacity - small + 1] - mass[small]) // capacity))
    for k in range(1, 21):  # k + 1 times the length, rounded down to whole bins where it is no multiple
        scaled = (k + 1) * sizes
        whole = scaled % capacity == 0
        weight = np.where(whole, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((count * weight).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each length, longest first into the fullest bin that takes it, and the number of bins."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    free, used = 0, 0  # bit r of `free`: a bin has just r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = free >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = open_bins[room].pop()
            if not open_bins[room]:
                free ^= 1 << room
        else:
            room, bin_, used = capacity, used, used + 1
        bins[i], offsets[i] = bin_, capacity - room
        left = room - size
        if left:
            if not open_bins[left]:
                free |= 1 << left
            open_bins[left].append(bin_)
    return bins, offsets, used


def pack(pieces: DataFrame, capacity: int = 2048, partition_rows: int = 50_000, rounds: int = 3) -> DataFrame:
    """`pieces` with sequence_id and offset: as few sequences of `capacity` as found, gapless from offset 0.

    Pieces shorter than `capacity` are dealt over partitions of about `partition_rows`, each packed best-fit decreasing. A
    lower bound from dual feasible functions certifies a partition that meets it. The others exchange their pieces (are
    dealt anew among themselves) and are packed again, as long as that saves sequences, `rounds` times at most. Partitions
    stay of one size, so tasks grow in number, not in length. Ties go by row; an empty table gives an empty one.
    """
    columns = pieces.columns
    table = written(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    short = table.where(F.col("length") < capacity).select("_row", F.col("length").cast("long").alias("_length"))
    deal = lambda df, n, turn: df.withColumn("_part", F.pmod(F.xxhash64("_row", F.lit(turn)), F.lit(n)) + turn * (1 << 32))

    def work(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_row")
        lengths = part["_length"].to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        return pd.DataFrame({"_row": part["_row"], "_length": lengths, "_part": part["_part"], "_bin": bins, "_offset": offsets, "_bins": used, "_gap": used - lower_bound(lengths, capacity)})

    schema = "_row bigint, _length bigint, _part bigint, _bin bigint, _offset bigint, _bins bigint, _gap bigint"
    run = lambda df: written(df.groupBy("_part").applyInPandas(work, schema), "packed")
    packed = run(deal(short, max(1, -(-short.count() // partition_rows)), 0))
    for turn in range(1, rounds + 1):
        open_ = packed.where("_gap > 0")
        sizes = open_.where("_bin = 0 and _offset = 0").agg(F.count("*").alias("parts"), F.sum("_bins").alias("bins")).first()
        if sizes["parts"] < 2:
            break
        again = run(deal(open_.select("_row", "_length"), sizes["parts"], turn))
        if again.where("_bin = 0 and _offset = 0").agg(F.sum("_bins")).first()[0] >= sizes["bins"]:
            break
        packed = packed.where("_gap <= 0").unionByName(again)
    places = packed.select("_row", (F.col("_part") * (1 << 20) + F.col("_bin")).alias("sequence_id"), F.col("_offset").alias("offset"))
    placed = table.drop("sequence_id", "offset").join(places, "_row", "left")
    return placed.select(
        *[c for c in columns if c not in ("sequence_id", "offset")], F.coalesce("sequence_id", -1 - F.col("_row")).alias("sequence_id"), F.coalesce("offset", F.lit(0)).cast("long").alias("offset")
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048) -> DataFrame:
    """Every piece of every document with its ids and place; see `token_pieces` and `pack`."""
    return pack(token_pieces(docs, path, capacity), capacity)
