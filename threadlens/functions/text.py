"""Text expressions: null-aware joins, cleaning, tokens and n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters by Unicode class, at least two of them (the usual vectoriser token rule).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_strict(title: Column | str, body: Column | str) -> Column:
    """Title and text with a space; NULL when either part is NULL."""
    return F.concat(_col(title), F.lit(" "), _col(body))


def concat_lenient(title: Column | str, body: Column | str) -> Column:
    """Title and text with a space; a NULL text counts as empty, a NULL title gives NULL."""
    return F.concat(_col(title), F.lit(" "), F.coalesce(_col(body), F.lit("")))


def strip(c: Column | str) -> Column:
    """Remove whitespace of any kind at both ends (`trim` removes spaces only)."""
    return F.regexp_replace(_col(c), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def normalise_author(c: Column | str) -> Column:
    return F.lower(strip(c))


def truncate(c: Column | str, length: int = 512) -> Column:
    """First `length` characters."""
    return F.substring(_col(c), 1, length)


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words; 0 for blank text."""
    text = strip(c)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, r"[\s\p{Z}]+")))


def spaced(c: Column | str) -> Column:
    """Underscores to spaces, as in multi-word lemma names."""
    return F.translate(_col(c), "_", " ")


def alternation(terms: Sequence[str]) -> str:
    """Case-insensitive regex that matches any of the terms literally."""
    return "(?iu)" + "|".join(_quote(t) for t in terms)


def _quote(term: str) -> str:
    return "".join("\\" + ch if not (ch.isalnum() or ch.isspace() or ch == "_") else ch for ch in term)


def tokens(c: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    """Lower-cased tokens in order; an empty array for NULL text."""
    found = F.regexp_extract_all(F.lower(_col(c)), F.lit(pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def drop_words(toks: Column, words: Sequence[str]) -> Column:
    """Tokens without the stopwords, duplicates and order kept."""
    lowered = sorted({w.lower() for w in words})
    return F.filter(toks, lambda t: ~t.isin(lowered)) if lowered else toks


def ngrams(toks: Column, n: int) -> Column:
    """Contiguous n-grams joined by one space; empty when there are fewer than n tokens."""
    if n == 1:
        return toks
    count = F.greatest(F.size(toks) - (n - 1), F.lit(0))
    grams = F.slice(toks, F.lit(1), count)
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(toks, F.lit(k + 1), count), lambda a, b: F.concat(a, F.lit(" "), b))
    return grams


def ngram_range(toks: Column, low: int, high: int) -> Column:
    return F.concat(*[ngrams(toks, n) for n in range(low, high + 1)]) if high > low else ngrams(toks, low)
