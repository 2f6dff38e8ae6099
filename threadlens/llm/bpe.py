"""Byte-level BPE: encoding by a queue of merge ranks over a linked list of symbols, decoding by the vocabulary's strings."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from threadlens.llm.chunks import Memo, id_lists, slices
from threadlens.llm.common import texts

#: The pattern that cuts text into pieces, as byte-level BPE vocabularies of this kind define it.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
_BLANK = regex.compile(r"\p{White_Space}")
_PLACE = (1 << 32) - 1
_REMEMBERED = 600_000


def _pair(a: int, b: int) -> int:
    return a << 32 | b


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte: itself where it prints, else one from 256 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary file of the tokenizers library with byte-level BPE, without normalizer or prefix space."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, byte_of = spec["model"]["vocab"], byte_names()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        self._byte_id = [0] * 256
        for name, b in byte_of.items():
            self._byte_id[b] = ids[name]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self._left, self._right = [ids[a] for a, _ in merges], [ids[b] for _, b in merges]
        self._joined = [ids[a + b] for a, b in merges]
        self._turn = {_pair(a, b): r << 32 for r, (a, b) in enumerate(zip(self._left, self._right, strict=True))}
        self._cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._pieces = Memo(self._piece, _REMEMBERED)
        self._names = pa.array([self.strings.get(i, b"") for i in range(max(self.strings) + 1)], pa.large_binary())
        self._runs = Memo(self._whole, _REMEMBERED // 10)
        self._chunks, self._first = Memo(lambda c: self._chunk(c, " "), _REMEMBERED), Memo(lambda c: self._chunk(c, ""), _REMEMBERED)

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece. Neighbours wait in a queue by merge rank, then place; a pair that is no longer there is skipped."""
        raw = piece.encode()
        symbols = [*map(self._byte_id.__getitem__, raw)]
        n, turn_of, left, right, joined = len(symbols), self._turn.get, self._left, self._right, self._joined
        queue = [turn + i for i, turn in enumerate(map(turn_of, map(_pair, symbols, symbols[1:]))) if turn is not None]
        if not queue:
            return array("i", symbols).tobytes()
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heapify(queue)
        while queue:
            turn = heappop(queue)
            i, rank = turn & _PLACE, turn >> 32
            j = after[i]
            if j == n or symbols[i] != left[rank] or symbols[j] != right[rank]:
                continue
            symbol = symbols[i] = joined[rank]
            symbols[j] = -1
            k, h = after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                if (turn := turn_of(symbol << 32 | symbols[k])) is not None:
                    heappush(queue, turn + i)
            if h >= 0 and (turn := turn_of(symbols[h] << 32 | symbol)) is not None:
                heappush(queue, turn + h)
        return array("i", [s for s in symbols if s >= 0]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, _PIECE.findall(text)))

    def _whole(self, text: str) -> bytes:
        """Any text: special tokens are cut out first, what lies between them is cut into pieces."""
        if self._cut is None:
            return self._plain(text)
        out, at = [], 0
        for m in self._cut.finditer(text):
            out += [self._plain(text[at : m.start()]), array("i", [self.special[m[0]]]).tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def _chunk(self, chunk: str, space: str) -> bytes | None:
        """Ids of what stands between two spaces, or None where its pieces depend on what lies around it."""
        if not chunk or _BLANK.match(chunk) or _BLANK.match(chunk[-1]) or self._cut and self._cut.search(chunk):
            return None
        return self._plain(space + chunk)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids. Pieces never cross from one chunk to the next, so chunks are looked up one by one."""
        first, *rest = chunks = text.split(" ")
        coded = [self._first[first], *map(self._chunks.__getitem__, rest)]
        try:
            return b"".join(coded)
        except TypeError:  # a chunk that is None: runs of these are cut as they stand, with the spaces before them
            out, i = [], 0
            while i < len(coded):
                if coded[i] is not None:
                    out.append(coded[i])
                    i += 1
                    continue
                start = i
                while i < len(coded) and coded[i] is None:
                    i += 1
                out.append(self._runs[("" if start == 0 else " ") + " ".join(chunks[start:i])])
            return b"".join(out)

    def decode(self, ids: pa.ListArray) -> list[str]:
        """The text of each list of ids: their strings stand one after the other in one buffer, and the lists cut it."""
        ends = ids.offsets.to_numpy()
        strings = pc.take(self._names, ids.values.slice(ends[0], ends[-1] - ends[0]))
        cuts = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, 8 * strings.offset)
        joined, cuts = strings.buffers()[2], cuts[ends - ends[0]].tolist()
        whole = memoryview(joined) if joined is not None else memoryview(b"")
        return [str(whole[a:b], "utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) of every whole text, and decoded, the text that the ids give back.

    Null and empty texts have no ids. Special tokens written out in a text become their ids, as the tokenizers library
    does by default. Rows are worked on where they lie; repeated rows stay.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for rows, strings in slices(batches):
            ids = id_lists([bpe.encode(t) for t in strings])
            yield pa.RecordBatch.from_arrays([rows.column(0), ids, pa.array(bpe.decode(ids), pa.string())], ["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(work, "doc_id bigint, ids array<int>, decoded string")
