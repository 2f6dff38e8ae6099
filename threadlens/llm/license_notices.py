"""Licence notices with typing errors: exact seeds by the pigeonhole rule, bounded-error matching around them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from threadlens.llm.chunks import slices
from threadlens.llm.common import texts

_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: One edit for so many characters of a notice.
CHARS_AN_EDIT = 10
_GRAM = 3

#: label, phrase: found exactly, as words
PHRASES = (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license"))

#: label, notice, names that must stand unchanged. Openings and key sentences of widespread licences, in their public wording.
NOTICES = (
    ("gpl", "gnu general public license", ()),
    ("lgpl", "gnu lesser general public license", ("lesser",)),
    ("agpl", "gnu affero general public license", ("affero",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the", ()),
    ("apache", "licensed under the apache license", ()),
    ("apache", "apache license version 2 0", ()),
    ("mit", "released under the mit license", ("mit",)),
    ("mit", "licensed under the mit license", ("mit",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ()),
    ("cc-by", "licensed under cc by", ("cc", "by")),
    ("cc-by", "creative commons attribution", ()),
    ("cc0", "creative commons zero", ("zero",)),
    ("cc0", "has waived all copyright and related or neighboring rights to this work", ()),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ()),
    ("bsd", "released under the bsd license", ("bsd",)),
    ("bsd", "licensed under the bsd license", ("bsd",)),
    ("mpl", "mozilla public license", ()),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ()),
    ("epl", "eclipse public license", ()),
    ("unlicense", "this is free and unencumbered software released into the public domain", ()),
    ("reserved", "all rights reserved", ()),
)


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    names: tuple[str, ...]

    @property
    def edits(self) -> int:
        return len(self.text) // CHARS_AN_EDIT

    def pieces(self) -> list[tuple[int, str]]:
        """Offsets and texts of one piece more than edits; a run within so many edits holds one of them unchanged."""
        n = self.edits + 1
        cuts = [len(self.text) * i // n for i in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def grams(self) -> list[str]:
        return [self.text[i : i + _GRAM] for i in range(len(self.text) - _GRAM + 1)]

    def pattern(self) -> regex.Pattern:
        return regex.compile(rf"(?e)(?<= )(?:{regex.escape(self.text, special_only=True)}){{e<={self.edits}}}(?= )")


class NoticeScanner:
    """Finds notices in texts given as words with one space before, between and behind them."""

    def __init__(self, notices: Sequence[tuple[str, str, Sequence[str]]]):
        self.notices = [Notice(label, text, tuple(names)) for label, text, names in notices]
        self._patterns = [n.pattern() for n in self.notices]
        self._grams = [n.grams() for n in self.notices]
        self._seeds = ahocorasick.Automaton()
        places: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(self.notices):
            for offset, piece in notice.pieces():
                places.setdefault(piece, []).append((k, offset))
        for piece, where in places.items():
            self._seeds.add_word(piece, (len(piece), where))
        self._seeds.make_automaton()

    def windows(self, joined: str) -> dict[int, list[list[int]]]:
        """For each notice the parts of the text in which a run within its edits can lie; overlapping parts are merged."""
        out: dict[int, list[list[int]]] = {}
        for end, (size, where) in self._seeds.iter(joined):
            for k, offset in where:
                notice = self.notices[k]
                at = end + 1 - size - offset
                out.setdefault(k, []).append([max(0, at - notice.edits), at + len(notice.text) + 2 * notice.edits + 1])
        for k, parts in out.items():
            merged = [(parts := sorted(parts))[0]]
            for a, b in parts[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            out[k] = merged
        return out

    def _can_hold(self, k: int, part: str) -> bool:
        """An edit takes away at most `_GRAM` of a notice's grams, so a part that lacks more holds no run within its edits."""
        there = {part[i : i + _GRAM] for i in range(len(part) - _GRAM + 1)}
        return sum(g not in there for g in self._grams[k]) <= _GRAM * self.notices[k].edits

    def matches(self, joined: str, windows: dict[int, list[list[int]]]) -> list[tuple[int, int, int, int]]:
        """start, end, edits and notice of the runs in these parts; of runs that overlap, the better one for its length stays."""
        found = []
        for k, parts in windows.items():
            notice, pattern = self.notices[k], self._patterns[k]
            for a, b in parts:
                if not self._can_hold(k, joined[a:b]):
                    continue
                for m in pattern.finditer(joined, a, b):
                    if all(f" {name} " in f" {m[0]} " for name in notice.names):
                        found.append((m.start(), m.end(), sum(m.fuzzy_counts), k))
        kept: list[tuple[int, int, int, int]] = []
        last = 0
        group: list[tuple[int, int, int, int]] = []
        for m in [*sorted(found), None]:
            if group and (m is None or m[0] >= last):
                taken: list[tuple[int, int, int, int]] = []
                for x in sorted(group, key=lambda x: (x[2] / len(self.notices[x[3]].text), x[0] - x[1], x)):
                    if all(x[1] <= y[0] or y[1] <= x[0] or self.notices[x[3]].label == self.notices[y[3]].label for y in taken):
                        taken.append(x)
                kept, group = kept + taken, []
            if m is not None:
                group.append(m)
                last = max(last, m[1])
        return sorted(kept)


@lru_cache(maxsize=4)
def scanner(notices: tuple) -> NoticeScanner:
    return NoticeScanner(notices)


def places(joined: str, phrase: str) -> Iterator[int]:
    """Starts, in words, of the places where the words of `phrase` stand one after the other."""
    at, word, seen = joined.find(f" {phrase} "), 0, 0
    while at >= 0:
        word, seen = word + joined.count(" ", seen, at), at
        yield word
        at = joined.find(f" {phrase} ", at + 1)


def scan_text(text: str, phrases: Sequence[tuple[str, str]], finder: NoticeScanner, whole: bool = False) -> tuple:
    """All of a document's columns but its id. `whole` matches the whole text instead of the parts around seeds, for checks."""
    words = _WORDS.findall(text.encode().lower().decode())  # bytes: A-Z only
    joined = f" {' '.join(words)} " if words else " "
    base = [(at, label) for label, phrase in phrases for at in places(joined, phrase)]
    labels = {label for _, label in base}
    parts = {k: [[0, len(joined)]] for k in range(len(finder.notices))} if whole else finder.windows(joined)
    spans, score, word, seen = [], 1.0 if base else 0.0, 0, 0
    more = set(labels)
    for start, end, edits, k in finder.matches(joined, parts):
        word, seen = word + joined.count(" ", seen, start - 1), start - 1
        notice = finder.notices[k]
        spans.append(f"{notice.label}:{word}:{word + joined.count(' ', start, end) + 1}:{edits}")
        more.add(notice.label)
        score = max(score, 1 - edits / len(notice.text))
    starts = [at for at, _ in base]
    return len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(more)), score, ",".join(spans)


_COLUMNS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
    "spans": pa.string(),
}


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[tuple[str, str, Sequence[str]]] = NOTICES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans of every document.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased; null texts are empty. `n_base`
    counts the places where the words of a phrase stand one after the other. A notice is found where a run of whole words
    is within one edit for each `CHARS_AN_EDIT` of its characters and holds its names unchanged: an exact piece of the notice
    locates it, the regex library's bounded-error matching confirms it. Of overlapping runs with different labels, the one
    with fewer edits for its length stays, then the longer one. `spans` lists label:first word:word behind:edits by place. `score` is 1 with
    a phrase, else the highest share of a notice's characters without an edit, else 0. Texts without words get zeros, nulls
    and empty strings; long texts are read whole; repeated rows stay; other columns are not read.
    """
    phrases, notices = tuple(phrases), tuple((a, b, tuple(c)) for a, b, c in notices)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = scanner(notices)
        for rows, strings in slices(batches):
            columns = list(zip(*(scan_text(t, phrases, finder) for t in strings), strict=True))
            yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(c, t) for c, t in zip(columns, _COLUMNS.values(), strict=True)]], ["doc_id", *_COLUMNS])

    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    schema = ", ".join(f"{name} {kinds[t]}" for name, t in _COLUMNS.items())
    return texts(docs).mapInArrow(work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {schema}")
