"""Matching of texts against ordered lexicon tables.

Entity and phrase lexicons of tens to hundreds of entries are read once (their size is checked) and become literals
inside the row expression, so matching needs no shuffle and keeps the entry order. For lexicons of any size
`with_first_substring` and `with_fuzzy_phrase` scan a text once for all entries of a block, and `with_first_term` joins the
texts' runs of words with the lexicon.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.text import WORD_PATTERN, _col, ngrams, tokens
from threadlens.operators.lexicon_scan import BLOCK_ENTRIES, PieceScanner, TermScanner, scanned, with_blocks
from threadlens.session import written

MAX_INLINE_ENTRIES = 5000
MIN_SIMILARITY = 80.0


def lexicon_rows(table: DataFrame, order: str | None = "ordinal") -> list:
    """All entries of a lexicon in order; fails when it is too large to sit inside an expression."""
    picked = (table.orderBy(order) if order else table).limit(MAX_INLINE_ENTRIES + 1).collect()
    if len(picked) > MAX_INLINE_ENTRIES:
        raise ValueError(f"lexicon has more than {MAX_INLINE_ENTRIES} entries")
    return picked


@dataclass(frozen=True)
class Phrase:
    ordinal: int
    phrase: str
    shift: float
    synonyms: tuple[str, ...] = ()


def load_phrases(phrases: DataFrame, synonyms: DataFrame | None = None) -> list[Phrase]:
    """Phrase entries in order with their synonyms."""
    extra: dict[str, list[str]] = {}
    if synonyms is not None:
        for row in lexicon_rows(synonyms, None):
            extra.setdefault(row.phrase, []).append(row.synonym)
    return [Phrase(r.ordinal, r.phrase, r.shift, tuple(sorted(extra.get(r.phrase, ())))) for r in lexicon_rows(phrases)]


def expand_synonyms(phrases: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Each phrase with itself and all its synonyms: (ordinal, phrase, term), underscores as spaces."""
    own = phrases.select("ordinal", "phrase", F.col("phrase").alias("term"))
    other = phrases.select("ordinal", "phrase").join(
        synonyms.select("phrase", F.translate("synonym", "_", " ").alias("term")), "phrase"
    )
    return own.unionByName(other).distinct()


def haystack(text: Column | str, boundary: bool = False) -> Column:
    """The text in the form terms are looked up in: lower case, or with `boundary` its words between spaces."""
    lowered = F.lower(_col(text))
    if not boundary:
        return lowered
    words = F.array_join(F.regexp_extract_all(lowered, F.lit(WORD_PATTERN), F.lit(0)), " ")
    return F.concat(F.lit(" "), words, F.lit(" "))


def holds(hay: Column | str, term: str, boundary: bool = False) -> Column:
    """Substring test on a haystack, or whole-word test when it was built with `boundary`."""
    term = term.lower()
    return _col(hay).contains(f" {' '.join(term.split())} " if boundary else term)


def first_hit(hay: Column | str, entries: Sequence[tuple[Sequence[str], object]], boundary: bool = False) -> Column:
    """Value of the first entry one of whose terms the haystack holds, else NULL; later entries are not tested."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for terms, value in entries:
        out = out.when(reduce(or_, (holds(hay, t, boundary) for t in terms)), value)
    return out


def first_entity_group(hay: Column | str, entities: Sequence, groups: Sequence[str], boundary: bool = False) -> Column:
    """Group of the first matching entity, all terms of one group tried before the next group's; NULL if none."""
    return first_hit(hay, [([e.term], e.grp) for g in groups for e in entities if e.grp == g], boundary)


def first_phrase(hay: Column | str, phrases: Sequence[Phrase]) -> Column:
    """First phrase that, itself or by a synonym, is a substring of the text."""
    return first_hit(hay, [([p.phrase, *p.synonyms], p.phrase) for p in phrases])


def with_first_term(
    df: DataFrame, terms: DataFrame, sizes: Sequence[int], key: str = "id", text: str = "body", name: str = "phrase"
) -> DataFrame:
    """Add the phrase of the first term, by ordinal, that the text holds as whole words, else NULL.

    `terms` has (ordinal, phrase, term), as from `expand_synonyms`, and may be of any size: the distinct runs of words of
    each text, of the word counts in `sizes`, are joined with the terms. Terms of other word counts never match. `key`
    names a row; rows that share it share the result. Case does not matter.
    """
    words = tokens(text, WORD_PATTERN)
    runs = F.array_distinct(F.flatten(F.array(*[ngrams(F.col("_words"), n) for n in sizes])))
    spoken = terms.select("ordinal", "phrase", F.array_join(tokens("term", WORD_PATTERN), " ").alias("_run"))
    met = df.select(key, words.alias("_words")).select(key, F.explode(runs).alias("_run")).join(spoken, "_run")
    first = met.groupBy(key).agg(F.min_by("phrase", F.struct("ordinal", "phrase")).alias(name))
    return df.drop(name).join(written(first, "terms"), key, "left")


def similarity(a: Column, b: Column) -> Column:
    """Edit similarity 0 to 100: one minus the edit distance over the longer length."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.lit(100.0) * (F.lit(1.0) - F.levenshtein(a, b) / longer)


def _max_edits(length: int, threshold: float) -> int:
    """Most edits a window may be away from a phrase of this length and still reach the threshold.

    With d edits the longer string has at most length + d characters, so d <= (1-t)(length+d).
    """
    miss = 1.0 - threshold / 100.0
    return int(miss * length / (1.0 - miss) + 1e-9)


_NEAR = "array<struct<place:bigint,phrase:string,target:string,window:string>>"
_NEAR_ARROW = pa.list_(pa.struct([("place", pa.int64()), ("phrase", pa.string()), ("target", pa.string()), ("window", pa.string())]))


def with_fuzzy_phrase(
    df: DataFrame,
    phrases: Sequence[Phrase] | DataFrame,
    text: str = "body",
    name: str = "phrase",
    threshold: float = MIN_SIMILARITY,
    strict: bool = True,
    blocked: bool = True,
    loose_name: str | None = None,
    spread: int = 1,
    block: int = BLOCK_ENTRIES,
) -> DataFrame:
    """Add the first phrase in lexicon order that some run of the text's words resembles, else NULL.

    Similarity must exceed the threshold, or reach it when not `strict`; `loose_name` adds a second column for
    the latter from the same windows. `phrases` may be a table (ordinal, phrase) of any size.

    Windows have the phrase's word count or up to `spread` words less or more, so that words written as one or cut in two
    are met. One scan of a text finds the windows that hold an unchanged piece of any phrase near its place: a window
    within k edits must hold one of k+1 pieces, so nothing is lost (`blocked=False` compares every window of about the
    phrase's length, for checks), and the time hardly depends on the number of phrases. A text without words never
    matches, a phrase without words neither.
    """
    if isinstance(phrases, DataFrame):
        entries = phrases.where(F.col("phrase").isNotNull()).select("ordinal", "phrase", F.array_join(F.split(F.trim(F.lower("phrase")), r"\s+"), " ").alias("target"))
    else:
        entries = [(i, p.phrase, " ".join(p.phrase.lower().split())) for i, p in enumerate(phrases)]
    names = [name, *([loose_name] if loose_name else [])]

    def found(rows: list[tuple]) -> dict[str, Column]:
        targets = [(place, phrase, target, _max_edits(len(target), threshold)) for place, phrase, target in rows]
        near = scanned(_NEAR, _NEAR_ARROW, lambda: PieceScanner(targets, spread, not blocked, 1.0 - threshold / 100.0), F.col("_joined"))
        score = F.transform(near, lambda c: F.struct(c["place"].alias("place"), c["phrase"].alias("phrase"), similarity(c["window"], c["target"]).alias("score")))

        def first(strictly: bool) -> Column:
            reached = F.filter(F.col("_scored"), lambda c: c["score"] > threshold if strictly else c["score"] >= threshold)
            return F.array_min(F.transform(reached, lambda c: F.struct(c["place"].alias("place"), c["phrase"].alias("phrase"))))["phrase"]

        return {"_scored": score, name: first(strict)} | ({loose_name: first(False)} if loose_name else {})

    staged = df.drop(*names).withColumn("_joined", F.array_join(tokens(text, WORD_PATTERN), " "))
    return with_blocks(staged, entries, found, names, block).drop("_joined")


def with_first_substring(
    df: DataFrame, terms: DataFrame, text: str = "body", name: str = "phrase", boundary: bool = False, block: int = BLOCK_ENTRIES
) -> DataFrame:
    """Add the phrase of the first term, by ordinal, that the text holds as a substring (with `boundary` as words), else NULL.

    `terms` has (ordinal, phrase, term), as from `expand_synonyms`, and may be of any size: the same result as `first_phrase`,
    from one scan of a text for all terms of a block. Case does not matter. NULL text gives NULL, an empty term is in
    every text, NULL terms are left out; equal ordinals go by phrase.
    """
    term = F.lower("term")
    if boundary:
        term = F.concat(F.lit(" "), F.array_join(F.split(F.trim(term), r"\s+"), " "), F.lit(" "))
    entries = terms.where("term is not null").select("ordinal", "phrase", term.alias("term"))
    found = lambda rows: {name: scanned("string", pa.string(), lambda: TermScanner(rows), F.col("_hay"))}
    return with_blocks(df.drop(name).withColumn("_hay", haystack(text, boundary)), entries, found, [name], block).drop("_hay")


def phrase_shift(phrase: Column | str, phrases: Sequence[Phrase]) -> Column:
    """Shift of a matched phrase, 0 without a match."""
    out = None
    for p in phrases:
        hit = _col(phrase) == p.phrase
        out = F.when(hit, p.shift) if out is None else out.when(hit, p.shift)
    return F.lit(0.0) if out is None else out.otherwise(F.lit(0.0))
