"""Categorical and numeric mappings of scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.text import _col

# Score categories in ascending order; the code of a category is its place, from 1.
SCORE_CATEGORIES = ("very_negative", "slightly_negative", "neutral", "slightly_positive", "very_positive")


def _score_case(c: Column | str, values: tuple) -> Column:
    s = _col(c)
    return (
        F.when(s < -10, values[0])
        .when(s < 0, values[1])
        .when(s == 0, values[2])
        .when((s > 0) & (s <= 10), values[3])
        .otherwise(values[4])
    )


def score_category(c: Column | str) -> Column:
    """Five-way score label; a missing score falls into the last class."""
    return _score_case(c, SCORE_CATEGORIES)


def score_code(c: Column | str) -> Column:
    """The same classes as 1 to 5."""
    return _score_case(c, (1, 2, 3, 4, 5))


def sentiment_category(c: Column | str) -> Column:
    """'positive' from zero upwards, else 'negative'."""
    return F.when(_col(c) >= 0, "positive").otherwise("negative")


def leaning(c: Column | str, positive: str = "Republican", negative: str = "Democratic", zero: str = "Neutral") -> Column:
    """Three-way label by sign; zero and missing are neutral."""
    return F.when(_col(c) > 0, positive).when(_col(c) < 0, negative).otherwise(zero)


def clamp(c: Column | str, low: float = -1.0, high: float = 1.0) -> Column:
    x = _col(c)
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def signed_magnitude(polarity: Column | str, label: Column | str, positive: str = "POSITIVE") -> Column:
    """Magnitude of the polarity with the sign of the label; any label but `positive` gives minus."""
    size = F.abs(_col(polarity))
    return F.when(_col(label) == positive, size).otherwise(F.lit(0.0) - size)


def nan_to_null(c: Column | str) -> Column:
    x = _col(c)
    return F.when(~F.isnan(x), x)


def differs(a: Column | str, b: Column | str) -> Column:
    """a != b with a missing value on either side counted as different, even when both are missing."""
    return ~same(a, b)


def same(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(_col(a) == _col(b), F.lit(False))


def nonzero(c: Column | str) -> Column:
    """Not zero, with missing values kept."""
    return _col(c).isNull() | (_col(c) != 0)
