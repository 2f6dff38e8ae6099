"""Lexicons of any size against whole texts: one scan of a text finds the exact parts of all entries, Spark decides.

Entries are read in blocks of bounded size. A block goes to the workers with its column, as an automaton of its entries (or
of pieces of them) that passes over a text once, however many entries there are. After `STAGED_BLOCKS` blocks the rows are
written to the shared folder, so neither the driver nor a plan ever holds more of the lexicon.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import groupby, islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.session import written

BLOCK_ENTRIES = 50_000
STAGED_BLOCKS = 8
#: Letters are counted in so many classes; words of a text and places in it are worked on so many at a time.
_CLASSES, _PART_WORDS, _PART_PLACES = 32, 20_000, 50_000


def entry_blocks(entries: DataFrame | Sequence[tuple], size: int = BLOCK_ENTRIES) -> Iterator[list[tuple]]:
    """The entries in order of their first column, at most `size` at a time."""
    rows = (tuple(r) for r in entries.orderBy(*entries.columns).toLocalIterator()) if isinstance(entries, DataFrame) else iter(entries)
    while block := list(islice(rows, size)):
        yield block


def scanned(kind: str, arrow: pa.DataType, build: Callable[[], Callable], source: Column) -> Column:
    """What `build()`, called once in a task, makes of each value of `source`; null stays null."""

    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = build()
        for column in columns:
            yield pa.array([None if v is None else work(v) for v in column.to_pylist()], arrow)

    return F.arrow_udf(scan, kind)(source)


def with_blocks(df: DataFrame, entries: DataFrame | Sequence[tuple], column: Callable[[list[tuple]], dict[str, Column]], names: Sequence[str], size: int) -> DataFrame:
    """Add `names`, each from the first block (in order) for which `column` gives a value that is not null.

    Columns of other names that `column` gives are there for these to read, and go again.
    """
    out, waiting = df.withColumns({n: F.lit(None).cast("string") for n in names}), 0
    for block in entry_blocks(entries, size):
        if waiting == STAGED_BLOCKS:
            out, waiting = written(out, "lexicon-blocks"), 0
        found = column(block)
        steps = {c: v for c, v in found.items() if c not in names}
        staged = out.withColumns(steps) if steps else out
        out = staged.withColumns({n: F.coalesce(F.col(n), found[n]) for n in names}).drop(*steps)
        waiting += 1
    return out


class TermScanner:
    """The first entry, by order, one of whose terms a text holds."""

    def __init__(self, block: Sequence[tuple]):
        best: dict[str, tuple] = {}
        for ordinal, phrase, term in block:
            best[term] = min(best.get(term, (ordinal, phrase)), (ordinal, phrase))
        self._always = best.pop("", None)  # every text holds the empty term
        self._terms = ahocorasick.Automaton()
        for term, entry in best.items():
            self._terms.add_word(term, entry)
        self._terms.make_automaton()
        self._first = min(best.values(), default=None)

    def __call__(self, text: str) -> str | None:
        found = self._always
        if self._first is not None:
            for _, entry in self._terms.iter(text):
                if found is None or entry < found:
                    found = entry
                    if entry == self._first:
                        break
        return found and found[1]


class PieceScanner:
    """Windows of words of a text that can be within `edits` of a target: of about its length, around an unchanged piece,
    and with about its letters.

    A target is cut into one piece more than edits, so a window within the edits holds one of them, at most `edits`
    characters from its place in the target; and neither has more than `edits` letters that the other lacks. Windows have
    the target's word count or up to `spread` words less or more. With `miss`, a window may only be as many edits away as
    that share of the longer text, which for windows no longer than the target is less than `edits`.
    """

    def __init__(self, block: Sequence[tuple], spread: int, every: bool = False, miss: float | None = None):
        """`block` has place, phrase, target and edits; `every` takes all windows of about the length, for checks."""
        self._miss = None if every else miss
        self._entries = [e for e in block if e[2]]
        targets = [e[2] for e in self._entries]
        self._edits, self._sizes = np.array([e[3] for e in self._entries], np.int64), np.array([len(t) for t in targets], np.int64)
        n = np.array([len(t.split()) for t in targets], np.int64)
        self._least, self._most = np.maximum(n - spread, 1), n + spread
        self._letters = np.array([np.bincount(_classes(t), minlength=_CLASSES) for t in targets], np.int32).reshape(-1, _CLASSES)
        self._all = [k for k, e in enumerate(self._entries) if every or e[3] >= len(e[2])]
        rest = set(range(len(targets))) - set(self._all)
        cuts = {k: [len(targets[k]) * i // (e + 1) for i in range(e + 2)] for k in rest for e in (int(self._edits[k]),)}
        pieces = sorted((targets[k][a:b], k, a) for k in rest for a, b in zip(cuts[k], cuts[k][1:]))
        self._entry, self._offset = np.array([p[1] for p in pieces], np.int64), np.array([p[2] for p in pieces], np.int64)
        self._pieces = ahocorasick.Automaton()
        at = 0
        for piece, same in groupby(pieces, key=lambda p: p[0]):
            count = len(list(same))
            self._pieces.add_word(piece, (len(piece), at, count))
            at += count
        self._pieces.make_automaton()

    def __call__(self, joined: str) -> list[dict]:
        """`joined` has the words of a text with one space between them; long texts are worked on in overlapping parts."""
        words, more = joined.split(), int(self._most.max(initial=0))
        found = {x for at in range(0, len(words) if self._entries else 0, _PART_WORDS) for x in self._windows(words[at : at + _PART_WORDS + more])}
        return [{"place": self._entries[k][0], "phrase": self._entries[k][1], "target": self._entries[k][2], "window": w} for k, w in sorted(found)]

    def _windows(self, words: list[str]) -> Iterator[tuple[int, str]]:
        joined = " ".join(words)
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        if not (near := [*self._near(joined)]):
            return
        entry, low, high, first, behind = (np.concatenate(c) for c in zip(*near))
        letters, seen = np.zeros((len(joined) + 1, _CLASSES), np.int32), set()
        letters[np.arange(1, len(joined) + 1), _classes(joined)] = 1
        np.cumsum(letters, axis=0, out=letters)
        before, upto = letters[starts], letters[ends]
        for part in range(0, len(entry), _PART_PLACES):
            cut = slice(part, part + _PART_PLACES)
            i, of = _spans(np.searchsorted(starts, low[cut]), np.searchsorted(starts, high[cut], "right"))
            of += part
            j, where = _spans(i + self._least[entry[of]] - 1, np.minimum(i + self._most[entry[of]], len(words)))
            i, of = i[where], of[where]
            k, length = entry[of], ends[j] - starts[i]
            fits = (np.abs(length - self._sizes[k]) <= self._allowed(k, length)) & (starts[i] <= first[of]) & (behind[of] <= ends[j])
            cell, k = np.divmod(np.unique((i[fits] * len(words) + j[fits]) * len(self._entries) + k[fits]), len(self._entries))
            i, j = np.divmod(cell, len(words))
            gap = upto[j] - before[i] - self._letters[k]
            alike = np.maximum(np.maximum(gap, 0).sum(1), np.maximum(-gap, 0).sum(1)) <= self._allowed(k, ends[j] - starts[i])
            seen.update(zip(k[alike].tolist(), starts[i[alike]].tolist(), ends[j[alike]].tolist()))
        yield from ((k, joined[a:b]) for k, a, b in seen)

    def _allowed(self, k: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Most edits between targets and windows of these lengths."""
        if self._miss is None:
            return self._edits[k]
        return np.minimum(self._edits[k], (self._miss * np.maximum(length, self._sizes[k]) + 1e-9).astype(np.int64))

    def _near(self, joined: str) -> Iterator[tuple[np.ndarray, ...]]:
        """Entries, the ranges in which their windows can start, and where the unchanged pieces lie."""
        if self._all:
            k, at = np.array(self._all), np.full(len(self._all), len(joined))
            yield k, 0 * at, at, at, 0 * at
        hits = [(end, *found) for end, found in self._pieces.iter(joined)] if len(self._pieces) else []
        if hits:
            end, size, at, count = np.array(hits, np.int64).T
            piece, of = _spans(at, at + count)
            first, edits = (end + 1 - size)[of] - self._offset[piece], self._edits[self._entry[piece]]
            yield self._entry[piece], first - edits, first + edits, (end + 1 - size)[of], end[of] + 1


def _classes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) % _CLASSES


def _spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each low to below its high, and the place of the pair that each belongs to."""
    n = np.maximum(high - low, 0)
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n), of
