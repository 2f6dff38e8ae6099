"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, cached_property
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.chunks import Memo, slices
from threadlens.llm.common import fold, small_batches, texts
from threadlens.session import written

#: Labelled rows that the classifier is fitted on, at most; taken in hash order of the id.
MAX_EXAMPLES = 20_000
_PREFIXES = range(4, 9)
_WORD = re.compile(r"[^\W_]+")
#: What `_WORD` leaves out, as spaces, for texts of ASCII alone.
_SPACED = "".join(chr(i) if chr(i).isalnum() else " " for i in range(128))
_LOW = np.int64(0xFFFFFFFF)
_HALF, _STEM = 1 << 63, 0xFFFFFF << 40
_BLOCK = 64
_NEIGHBOURS = 30
#: Terms that the index has as a matrix too, at most; queries that are multiplied with it at once; what rounding can make of
#: products of vectors of length 1 over so many terms in 32 bits, with room to spare, and what a further term adds to that.
_COMMON, _BATCH, _SLACK, _ROUNDING = 512, 128, 1e-4, 2.4e-7
#: Words whose places a worker keeps; this bounds memory only.
_KNOWN = 200_000
#: Examples whose common terms are multiplied at once.
_WIDE = 4096
#: Examples whose vectors the driver weighs at once.
_PART = 500
#: Examples left by bounds are scored on their own if they are at most one in so many.
_FEW = 256


def _hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"))


def beginning(letters: str) -> int:
    """The number of a beginning of 4 to 8 letters."""
    first = _hash(letters[: _PREFIXES[0]])
    return ((first | 1) if len(letters) == _PREFIXES[0] else (first & _STEM | _hash(letters) & ~_STEM | 1)) - _HALF


def numbers_of(word: str, stems: frozenset[int] | None = None) -> list[int]:
    """Numbers of a word in lower case, and of its beginnings of 4 to 8 letters, which stand for them in vectors.

    A word has an even number, a beginning an odd one, whose highest bits are those of its first four letters (its stem).
    With `stems`, only beginnings of these stems are listed.
    """
    out = [(_hash(word) & -2) - _HALF]
    if len(word) > _PREFIXES[0]:
        first = _hash(word[: _PREFIXES[0]])
        stem = first & _STEM
        if stems is None or stem in stems:
            out += [(first | 1) - _HALF, *[(stem | _hash(word[:n]) & ~_STEM | 1) - _HALF for n in _PREFIXES[1:] if n < len(word)]]
    return out


@cache
def _in_words() -> np.ndarray:
    """Whether `_WORD` takes a code point."""
    return np.fromiter(map(str.isalnum, map(chr, range(0x110000))), bool, 0x110000)


def words_of(text: str) -> list[str]:
    """The runs of letters and digits of a text in lower case, as `_WORD` finds them."""
    lower = text.lower()
    if lower.isascii():
        return lower.translate(_SPACED).split()
    points = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_in_words().take(points), points, np.uint32(32)).tobytes().decode("utf-32-le", "surrogatepass").split()


def counts_of(text: str, known: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the distinct terms of a text, rising, and how often each stands there."""
    words = Counter(words_of(text))
    found = list(map(known.__getitem__, words))
    sizes = list(map(len, found))
    numbers = np.fromiter(chain.from_iterable(found), np.int64, sum(sizes))
    order = np.argsort(numbers)
    numbers, counts = numbers[order], np.repeat(np.fromiter(words.values(), np.int64, len(words)), sizes)[order]
    first = np.flatnonzero(np.concatenate([numbers[:1] == numbers[:1], numbers[1:] != numbers[:-1]]))
    return numbers[first], np.add.reduceat(counts, first) if len(first) else counts


class _Words(dict):
    """Words numbered as they come; those that are new stand in `new` until their places are known (`extend`)."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.sizes, self.starts, self.places = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def numbered(self, words: list[list[str]]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, sum(map(len, words)))

    def extend(self, sizes: np.ndarray, places: np.ndarray) -> None:
        """Take the number of places of each new word, and all their places."""
        self.starts = np.concatenate([self.starts, len(self.places) + np.cumsum(sizes) - sizes])
        self.sizes, self.places = np.concatenate([self.sizes, sizes]), np.concatenate([self.places, places])
        self.new = []

    def forget(self) -> None:
        self.clear()
        self.__init__()


class BlockMaxIndex:
    """Postings of weighted examples, in blocks of neighbouring ids; the commonest terms have their largest weight per block."""

    def __init__(self, rows: list[list[tuple[int, float]]], n_terms: int):
        flat = [x for row in rows for x in row]
        self.build(np.cumsum([0, *map(len, rows)]), np.array([t for t, _ in flat], np.int64), np.array([w for _, w in flat], float), n_terms)

    @classmethod
    def of(cls, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int) -> BlockMaxIndex:
        index = cls.__new__(cls)
        index.build(starts, terms, weights, n_terms)
        return index

    def build(self, starts: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int) -> None:
        self.n, self.blocks = len(starts) - 1, -(-(len(starts) - 1) // _BLOCK)
        self.starts, self.row_terms, self.row_weights = starts, terms.astype(np.int32, copy=False), weights.astype(np.float32, copy=False)
        by_term = np.argsort(self.row_terms, kind="stable")
        #: Example and bits of the weight of each posting, side by side, so that a list is one piece.
        postings = np.empty((len(by_term), 2), np.int32)
        postings[:, 0] = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(starts))[by_term]
        postings[:, 1] = self.row_weights.view(np.int32)[by_term]
        del by_term
        self.postings = postings.view(np.int64).ravel()
        sizes = np.bincount(self.row_terms, minlength=n_terms)
        self.cuts = np.concatenate([[0], np.cumsum(sizes)])
        frequent = np.flatnonzero(sizes >= max(_BLOCK, self.blocks))
        frequent = frequent[np.argsort(-sizes[frequent], kind="stable")[:_COMMON]]
        self.column = np.full(n_terms, -1, np.int32)
        self.column[frequent] = np.arange(len(frequent))
        self.frequent = frequent
        self.largest = np.zeros((len(frequent), self.blocks), np.float32)
        self.blank, self.asked = np.zeros(n_terms), np.zeros(n_terms, bool)
        for k in range(len(frequent)):
            ids, weights = self._list(k)
            np.maximum.at(self.largest[k], ids // _BLOCK, weights)

    def _list(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Examples and weights of the postings of a common term."""
        t = self.frequent[k]
        pairs = self.postings[self.cuts[t] : self.cuts[t + 1]].view(np.int32)
        return pairs[::2], pairs[1::2].copy().view(np.float32)

    @cached_property
    def dense(self) -> np.ndarray:
        """The common terms' weights as a matrix."""
        dense = np.zeros((self.n, len(self.frequent)), np.float32)
        for k in range(len(self.frequent)):
            ids, weights = self._list(k)
            dense[ids, k] = weights
        return dense

    @cached_property
    def _room(self) -> tuple[np.ndarray, np.ndarray]:
        return np.empty((_BATCH, self.blocks * _BLOCK), np.float32), np.empty((_BATCH, _WIDE), np.float32)

    def rest(self) -> None:
        """Give up what is quickly made again, so that a worker that waits holds less."""
        for name in ("dense", "_room"):
            self.__dict__.pop(name, None)

    def nearest(self, query: list[tuple[int, float]], votes: np.ndarray, enough: float) -> list[tuple[float, int]]:
        """(cosine, example) from the nearest on until their votes reach `enough`; ties by example."""
        return self.closest([(np.array([t for t, _ in query], np.int64), np.array([w for _, w in query], float))], votes, enough)[0]

    def closest(self, queries: list[tuple[np.ndarray, np.ndarray]], votes: np.ndarray, enough: float, less: list[int | None] | None = None) -> list[list[tuple[float, int]]]:
        """`nearest` for (terms, weights) of several queries; the example in `less`, if any, has a vote less for its query.

        Postings of all but the commonest terms are added up first, in 32 bits. Where the blocks' bounds of the common terms
        cannot lift more than a few of the examples over those found, these alone are left; the other queries get the common
        terms' part by one product of matrices. Both are off by less than the slack. What is left is scored from its own
        vectors, so results do not depend on the queries they came with.
        """
        need = int(enough) + 1
        less = less or [None] * len(queries)
        which: list[np.ndarray | None] = [None] * len(queries)
        scores, product = self._held(len(queries))
        common = np.zeros((len(queries), len(self.frequent)), np.float32)
        slack = [_SLACK + _ROUNDING * len(terms) for terms, _ in queries]
        for q, (terms, weights) in enumerate(queries):
            column = self.column[terms]
            rare = column < 0
            self._add(scores[q], terms[rare], weights[rare])
            common[q, column[~rare]] = weights[~rare]
        if common.shape[1] and self.n > 8 * need:
            for q, rest in enumerate(common @ self.largest):
                floor = self._floor(scores[q], need) - slack[q]
                if floor > rest.min():
                    found = np.flatnonzero((scores[q] + np.repeat(rest, _BLOCK))[: self.n] >= floor)
                    if _FEW * len(found) <= self.n:
                        which[q] = found
        open_ = [q for q in range(len(queries)) if which[q] is None]
        if open_ and common.shape[1]:
            asked = common[open_]
            for a in range(0, self.n, _WIDE):
                some = self.dense[a : a + _WIDE]
                for q, added in zip(open_, np.matmul(asked, some.T, out=product[: len(open_), : len(some)]), strict=True):
                    scores[q, a : a + len(some)] += added
        for q in open_:
            which[q] = self._found(scores[q], need, slack[q])
        return [self._best(*query, found, votes, enough, i) for query, found, i in zip(queries, which, less, strict=True)]

    def _held(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores of `n` queries, all 0, and room for products of common terms; up to _BATCH queries use the same memory again."""
        if n > _BATCH:
            return np.zeros((n, self.blocks * _BLOCK), np.float32), np.empty((n, _WIDE), np.float32)
        scores, product = self._room
        scores[:n] = 0.0
        return scores[:n], product

    def _add(self, score: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        """Add to every example's score what the postings of these terms give."""
        start, end = self.cuts[terms], self.cuts[terms + 1]
        if len(terms):
            found = np.concatenate([self.postings[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
            added = np.repeat(weights.astype(np.float32), end - start)
            added *= found.view(np.float32)[1::2]
            found &= _LOW
            np.add.at(score, found, added)

    def _floor(self, score: np.ndarray, need: int) -> float:
        """A score that `need` examples reach: the largest of that rank, or among the largest of each of many groups."""
        tops = score.reshape(_BLOCK, -1).max(axis=0) if self.blocks > 4 * need else score
        return float(np.partition(tops, len(tops) - need)[len(tops) - need])

    def _found(self, score: np.ndarray, need: int, slack: float) -> np.ndarray:
        """The examples that may be among the `need` nearest, with scores off by less than `slack`."""
        if self.n <= need:
            return np.flatnonzero(score)
        found = np.flatnonzero(score >= floor) if (floor := self._floor(score, need) - slack) > 0 else np.flatnonzero(score)
        if len(found) > need:
            near = score[found]
            found = found[near >= np.partition(near, len(near) - need)[len(near) - need] - slack]
        return found

    def _best(self, terms: np.ndarray, weights: np.ndarray, which: np.ndarray, votes: np.ndarray, enough: float, less: int | None) -> list[tuple[float, int]]:
        """`nearest` among the examples in `which`, from their own vectors."""
        if not len(which):
            return []
        need = int(enough) + 1
        dense = self.blank
        dense[terms], self.asked[terms] = weights, True
        start, end = self.starts[which], self.starts[which + 1]
        held = np.concatenate([self.row_terms[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        at = np.flatnonzero(self.asked.take(held))
        owner = np.repeat(np.arange(len(which)), end - start)[at]
        place = at + (end - np.cumsum(end - start))[owner]
        exact = np.bincount(owner, dense.take(held[at]) * self.row_weights.take(place), len(which))
        dense[terms], self.asked[terms] = 0.0, False
        if len(which) > need:
            top = np.flatnonzero(exact >= np.partition(exact, len(exact) - need)[len(exact) - need])
            which, exact = which[top], exact[top]
        order = np.lexsort((which, -exact))
        which, exact = which[order], exact[order]
        best, total = [], 0.0
        for score, i, n in zip(exact.tolist(), which.tolist(), votes[which].tolist(), strict=True):
            if score <= 0 or total >= enough:
                break
            best.append((score, i))
            total += n - (i == less)
        return best


def _kept(terms: np.ndarray, counts: np.ndarray, telling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words and the telling beginnings."""
    keep = terms & 1 == 0
    if len(telling):  # rising, like the terms
        at = np.minimum(np.searchsorted(telling, terms), len(telling) - 1)
        keep |= telling[at] == terms
    return (terms, counts.astype(np.int32, copy=False)) if keep.all() else (terms[keep], counts[keep].astype(np.int32))


def _digest(terms: np.ndarray, counts: np.ndarray) -> bytes:
    return blake2b(terms.tobytes() + counts.astype(np.int32).tobytes(), digest_size=16).digest()


class ToxicityModel:
    """TF-IDF vectors of labelled examples over all their words; fitted on at most MAX_EXAMPLES rows.

    Terms that are commoner among toxic examples by six standard errors or more, and which five examples have, weigh as many
    times as much as they are errors apart; beginnings of words count only so. Every word counts.

    The driver holds each vector once, and sends all of them once, for calibration and scoring (`sent`); every worker builds
    the index from them.
    """

    def __init__(self, examples: Iterable[tuple[int, int, np.ndarray, np.ndarray]], total: int, toxic: int, telling: np.ndarray):
        """`examples` have id, label, and term numbers and counts as of `counts_of`; `telling` are the beginnings that count."""
        clean = total - toxic
        self.telling = telling
        self.base = (toxic + 1) / (total + 2)
        self.unknown = np.log(1 + total) + 1
        self.steps = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
        grouped: dict[bytes, list] = {}
        # Two growing buffers instead of two small arrays for each example, whose memory would not be given back.
        all_terms, all_counts = array("q"), array("i")
        for doc, label, terms, counts in examples:
            terms, counts = self.kept(terms, counts)
            digest = _digest(terms, counts)
            if digest not in grouped:
                grouped[digest] = [0, 0, doc, len(all_terms), len(terms)]
                all_terms.frombytes(terms.tobytes())
                all_counts.frombytes(counts.tobytes())
            g = grouped[digest]
            g[0], g[1], g[2] = g[0] + 1, g[1] + label, min(g[2], doc)
        seen = [(*g, digest) for digest, g in grouped.items() if g[4]]
        none = np.zeros(0, np.int64)
        empty = grouped.get(_digest(none, none), [0, 0])
        self.without_terms = (empty[1] + self.base) / (empty[0] + 1)
        seen.sort(key=lambda g: (g[1] / g[0], g[5]))
        self.votes, self.toxic, self.doc = np.array([g[0] for g in seen], float), np.array([g[1] for g in seen], float), [g[2] for g in seen]
        self.place = {g[5]: i for i, g in enumerate(seen)}
        # Some rows at a time: only the terms, their places and the weights are ever held for all of them.
        parts = [slice(a, a + _PART) for a in range(0, len(seen), _PART)]
        starts, per_row = np.array([g[3] for g in seen], np.int64), [np.array([g[4] for g in seen[part]], np.int64) for part in parts]
        del grouped, seen

        def rows(flat: np.ndarray, part: slice, sizes: np.ndarray) -> np.ndarray:
            return np.concatenate([flat[a : a + n] for a, n in zip(starts[part].tolist(), sizes.tolist(), strict=True)])

        flat = np.frombuffer(all_terms, np.int64) if all_terms else none
        self.terms = np.unique(np.concatenate([np.unique(rows(flat, part, sizes)) for part, sizes in zip(parts, per_row, strict=True)] or [none]))
        n, bad = np.zeros(len(self.terms)), np.zeros(len(self.terms))
        columns, at = np.zeros(len(flat), np.int32), 0
        for part, sizes in zip(parts, per_row, strict=True):
            column = np.searchsorted(self.terms, rows(flat, part, sizes))
            n += np.bincount(column, np.repeat(self.votes[part], sizes), len(n))
            bad += np.bincount(column, np.repeat(self.toxic[part], sizes), len(bad))
            columns[at : at + len(column)], at = column, at + len(column)
        del flat, all_terms
        share = n / max(total, 1)
        error = np.sqrt(share * (1 - share) * (1 / max(toxic, 1) + 1 / max(clean, 1)))
        z = np.divide(bad / max(toxic, 1) - (n - bad) / max(clean, 1), error, out=np.zeros(len(n)), where=error > 0)
        self.factor = (np.log((1 + total) / (1 + n)) + 1) * np.where((z >= 6) & (n >= 5), z, np.where(self.terms & 1, 0.0, 1.0))
        n_used = int(sum((self.factor[columns[a : a + 1_000_000]] > 0).sum() for a in range(0, len(columns), 1_000_000)))
        places, weighed, lengths = np.zeros(n_used, np.int32), np.zeros(n_used, np.float32), [np.zeros(1, np.int64)]
        flat = np.frombuffer(all_counts, np.int32) if all_counts else none
        read = put = 0
        for part, sizes in zip(parts, per_row, strict=True):
            counts = rows(flat, part, sizes)
            column, read = columns[read : read + len(counts)], read + len(counts)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            weights = (1 + np.log(counts)) * self.factor[column]
            weights /= np.sqrt(np.bincount(owner, weights * weights, len(sizes)))[owner]
            used = weights > 0
            lengths.append(np.bincount(owner[used], minlength=len(sizes)))
            end = put + int(used.sum())
            places[put:end], weighed[put:end], put = column[used], weights[used], end
        self._vectors = np.cumsum(np.concatenate(lengths)), places[:put], weighed[:put]

    @cached_property
    def _beginnings(self) -> tuple[Memo, Memo]:
        """Whether four letters are the stem of a telling beginning; the number of a beginning, None if it does not tell."""
        telling = self.telling.tolist()
        stems, numbers = frozenset(n + _HALF & _STEM for n in telling), frozenset(telling)
        return Memo(lambda letters: _hash(letters) & _STEM in stems, 50_000), Memo(lambda letters: n if (n := beginning(letters)) in numbers else None, 50_000)

    @cached_property
    def _counts(self) -> tuple[list[float], list[float]]:
        """Votes and toxic votes as Python's numbers."""
        return self.votes.tolist(), self.toxic.tolist()

    @cached_property
    def index(self) -> BlockMaxIndex:
        return BlockMaxIndex.of(*self._vectors, len(self.terms))

    def rest(self, keep_index: bool) -> None:
        """Let a worker that waits hold less."""
        if keep_index:
            self.index.rest()
        else:
            self.__dict__.pop("index", None)
            self.__dict__.pop("known", None)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("index", "known", "_beginnings", "_counts", "_sent")}

    def sent(self, spark: SparkSession) -> Broadcast:
        """The model on the executors, sent at the first call; `steps` go with each task, as they are fitted later."""
        if "_sent" not in self.__dict__:
            self._sent = spark.sparkContext.broadcast(self)
        return self._sent

    @cached_property
    def known(self) -> _Words:
        """Places of the words that this worker met, whichever task they came in; emptied at _KNOWN of them."""
        return _Words()

    def kept(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _kept(terms, counts, self.telling)

    def _place(self, known: _Words) -> None:
        """Where the terms have each new word, -1 if no example has it, and its telling beginnings."""
        told, tells = self._beginnings
        numbers = np.fromiter(map(_hash, known.new), np.uint64, len(known.new))
        numbers = ((numbers & np.uint64(_HALF * 2 - 2)) ^ np.uint64(_HALF)).view(np.int64)
        at, sizes = self._at(numbers), np.ones(len(numbers), np.int64)
        more = [i for i, word in enumerate(known.new) if len(word) > _PREFIXES[0] and told[word[: _PREFIXES[0]]]]
        if more:
            begun = [[t for n in _PREFIXES if n < len(word) and (t := tells[word[:n]]) is not None] for word in map(known.new.__getitem__, more)]
            found = self._at(np.fromiter(chain.from_iterable(begun), np.int64))
            owner = np.repeat(more, list(map(len, begun)))[found >= 0]
            at = np.insert(at, owner + 1, found[found >= 0])
            sizes += np.bincount(owner, minlength=len(sizes))
        known.extend(sizes, at)

    def _at(self, numbers: np.ndarray) -> np.ndarray:
        """Where the terms have numbers, -1 for those they lack."""
        at = np.searchsorted(self.terms, numbers)
        at[self.terms.take(at, mode="clip") != numbers if len(self.terms) else slice(None)] = -1
        return at

    def asked(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The vector of a text: places of terms, rising, and weights; None for a text without words."""
        return self.all_asked([text])[0]

    def all_asked(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """`asked` of texts, all counted, placed and weighed together."""
        words, known = list(map(words_of, texts)), self.known
        met = len(known)
        numbers = known.numbered(words)
        if met and len(known) > _KNOWN:
            known.forget()
            numbers = known.numbered(words)
        if known.new:
            self._place(known)
        owner = np.repeat(np.arange(len(texts)), list(map(len, words)))
        keys, counts = np.unique(owner * max(len(known), 1) + numbers, return_counts=True)
        owner, numbers = np.divmod(keys, max(len(known), 1))
        sizes = known.sizes[numbers]
        nth = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = known.places[np.repeat(known.starts[numbers], sizes) + nth]
        owner, counts = np.repeat(owner, sizes), np.repeat(counts, sizes)
        keys = owner * (len(self.terms) + 1) + at
        order = np.argsort(keys)
        keys, at, owner, counts = keys[order], at[order], owner[order], counts[order]
        first = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], (keys[1:] != keys[:-1]) | (at[1:] < 0)]))
        at, owner, counts = at[first], owner[first], np.add.reduceat(counts, first) if len(first) else counts
        weights = (1 + np.log(counts)) * np.where(at < 0, self.unknown, self.factor.take(at, mode="clip") if len(self.factor) else 0.0)
        lengths = np.sqrt(np.bincount(owner, weights * weights, len(texts)))
        lengths[lengths == 0] = 1.0
        used = np.flatnonzero((at >= 0) & (weights > 0))
        at, weights = at[used], (weights / lengths[owner])[used]
        ends = np.searchsorted(owner[used], np.arange(len(texts) + 1)).tolist()
        return [(at[a:b], weights[a:b]) if some else None for some, a, b in zip(words, ends, ends[1:], strict=False)]

    def raw(self, found: list[tuple[np.ndarray, np.ndarray]], own: list[int]) -> list[tuple[float, list[int]]]:
        """`votes_near` of examples with terms, by term numbers and counts, without the votes of their own labels, `own`."""
        queries, less = [], []
        for terms, counts in found:
            terms, counts = self.kept(terms, counts)
            at = np.searchsorted(self.terms, terms)
            weights = (1 + np.log(counts)) * self.factor[at]
            weights = weights / np.sqrt(weights @ weights)
            queries.append((at[weights > 0], weights[weights > 0]))
            less.append(self.place[_digest(terms, counts)])
        return self.votes_near(queries, less, own)

    def votes_near(self, queries: list[tuple[np.ndarray, np.ndarray]], less: list[int | None], own: list[int] | None = None) -> list[tuple[float, list[int]]]:
        """Votes of the nearest examples of vectors, and up to three of them; an example in `less` has a vote of the label in `own` less."""
        out, (all_votes, all_toxic) = [], self._counts
        for start in range(0, len(queries), _BATCH):
            part = slice(start, start + _BATCH)
            for k, near in enumerate(self.index.closest(queries[part], self.votes, _NEIGHBOURS, less[part]), start):
                weight, bad, left, evidence = self.base, self.base * self.base, float(_NEIGHBOURS), []
                for s, i in near:
                    votes, toxic = all_votes[i] - (i == less[k]), all_toxic[i] - (own[k] if i == less[k] else 0)
                    if votes > 0:
                        n = min(votes, left)
                        close = n / (1.05 - min(s, 1.0))
                        weight, bad, left = weight + close, bad + close * toxic / votes, left - n
                        evidence.append(self.doc[i])
                out.append((bad / weight, evidence[:3]))
        return out

    def scores(self, texts: list[str], steps: tuple[np.ndarray, np.ndarray]) -> list[tuple[float, list[int]]]:
        """Chance of label 1 for every text, calibrated by `steps`, and up to three nearest examples as evidence."""
        vectors = [v for start in range(0, len(texts), _BATCH) for v in self.all_asked(texts[start : start + _BATCH])]
        queries = [v for v in vectors if v is not None]
        raw = iter(self.votes_near(queries, [None] * len(queries)))
        out = []
        for vector in vectors:
            vote, evidence = (None, []) if vector is None else next(raw)
            out.append((float(self.without_terms) if vote is None else float(np.clip(np.interp(vote, *steps), 0.0, 1.0)), evidence))
        return out


def _isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising means of y by x (pooled adjacent violators), each smoothed by one example of either class."""
    pools: list[list[float]] = []
    for i in np.argsort(x, kind="stable"):
        pools.append([x[i] * n[i], y[i] * n[i], n[i]])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    means = np.array([(p[1] + 1) / (p[2] + 2) for p in pools])
    return np.array([p[0] / p[2] for p in pools]), np.maximum.accumulate(means)


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> ToxicityModel:
    """Fit on labelled documents outside fold 0, `max_examples` of them at most (in hash order of the id).

    A document with two labels counts as toxic if one says so. Each example's vote without its own label calibrates scores.
    """
    small_batches(docs.sparkSession)
    chosen = written(
        labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples), "chosen"
    )
    examples = texts(docs).join(chosen, "doc_id").select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Memo(numbers_of, 100_000)
        for rows, strings in slices(batches):
            found = [counts_of(text, known) for text in strings]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:2], pa.array([t.tobytes() for t, _ in found], pa.binary()), pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary())], ["doc_id", "toxic", "terms", "counts"]
            )

    vectors = written(examples.mapInArrow(counted, "doc_id bigint, toxic int, terms binary, counts binary"), "examples")
    sizes = {r["toxic"]: r["n"] for r in vectors.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, total = sizes.get(1, 0), sum(sizes.values())
    if not 0 < toxic < total:
        return ToxicityModel([], total, toxic, np.zeros(0, np.int64))

    def beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label in (0, 1):
                rows = [t[t & 1 == 1] for t in (np.frombuffer(r["terms"], np.int64) for r in batch.to_pylist() if r["toxic"] == label)]
                terms, n = np.unique(np.concatenate(rows or [np.zeros(0, np.int64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(n * label, pa.int64()), pa.array(n, pa.int64())], ["term", "bad", "n"])

    by_term = vectors.mapInArrow(beginnings, "term bigint, bad bigint, n bigint").groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).where("n >= 5").where(F.col("n") < total)
    share, clean = F.col("n") / total, total - toxic
    error = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    telling = by_term.where((F.col("bad") / toxic - (F.col("n") - F.col("bad")) / clean) / error >= 6).select("term").collect()
    telling = np.array(sorted(r["term"] for r in telling), np.int64)

    def lessened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_kept(np.frombuffer(t, np.int64), np.frombuffer(n, np.int32), telling) for t, n in zip(*[batch.column(i).to_pylist() for i in (2, 3)], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([t.tobytes() for t, _ in found], pa.binary()), pa.array([n.tobytes() for _, n in found], pa.binary())], batch.schema.names
            )

    # Beginnings that do not tell, most of the numbers, stay with the executors.
    vectors = written(vectors.mapInArrow(lessened, vectors.schema), "kept")
    rows = ((r["doc_id"], r["toxic"], np.frombuffer(r["terms"], np.int64), np.frombuffer(r["counts"], np.int32)) for r in vectors.toLocalIterator())
    model = ToxicityModel(rows, total, toxic, telling)
    if not len(model.votes):
        return model

    shared = model.sent(docs.sparkSession)

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = [(r["toxic"], np.frombuffer(r["terms"], np.int64), np.frombuffer(r["counts"], np.int32)) for r in batch.to_pylist() if r["terms"]]
            votes = model.raw([(t, n) for _, t, n in rows], [label for label, _, _ in rows])
            yield pa.RecordBatch.from_arrays([pa.array([label for label, _, _ in rows], pa.int32()), pa.array([v for v, _ in votes], pa.float64())], ["toxic", "raw"])

    votes = vectors.mapInArrow(voted, "toxic int, raw double").groupBy("raw", "toxic").agg(F.count("*").alias("n")).orderBy("raw", "toxic").collect()
    model.steps = _isotonic(np.array([v["raw"] for v in votes]), np.array([v["toxic"] for v in votes], float), np.array([v["n"] for v in votes], float))
    return model


def with_scores(df: DataFrame, model: ToxicityModel, keep_index: bool = True) -> DataFrame:
    """`df` with score and evidence (ids of the nearest labelled examples); columns of these names are replaced.

    Every whole text is compared; equal texts are looked up once in a worker. A null or empty text, like any without words,
    gets the share of toxic ones among examples without words. Rows stay where they lie. Without `keep_index`, every task
    builds the index anew (about a second) and workers give it up, for steps that more work on the same executors follows.
    """
    kept = df.drop("score", "evidence")
    fields = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.LongType()))])

    shared, steps = model.sent(df.sparkSession), model.steps

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scored = {}
        try:
            yield from scored_rows(model, scored, batches)
        finally:
            model.rest(keep_index)

    def scored_rows(model: ToxicityModel, scored: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, strings in slices(batches):
            if len(scored) >= 200_000:
                scored.clear()
            digests = [blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest() for text in strings]
            new = {d: text for d, text in zip(digests, strings, strict=True) if d not in scored}
            scored.update(zip(new, model.scores(list(new.values()), steps), strict=True))
            found = [scored[d] for d in digests]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array([s for s, _ in found], pa.float64()), pa.array([e for _, e in found], pa.list_(pa.int64()))], [*rows.schema.names, "score", "evidence"]
            )

    return kept.mapInArrow(work, fields)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence of every document; labels of fold 0 are never read."""
    scored = with_scores(texts(docs), fit(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def reject_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents that score below `limit`, with their own columns."""
    marked = docs.withColumnsRenamed({c: f"_own_{c}" for c in ("score", "evidence") if c in docs.columns})
    kept = with_scores(marked, fit(docs, labels), keep_index=False).where(F.col("score") < limit).drop("score", "evidence")
    return kept.withColumnsRenamed({f"_own_{c}": c for c in ("score", "evidence") if c in docs.columns}).select(docs.columns)
