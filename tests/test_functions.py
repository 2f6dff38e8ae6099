import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadlens.functions import buckets, hashing, text, times


def one(spark, expr, **values):
    kinds = {int: "bigint", float: "double", str: "string", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "x int"
    row = spark.createDataFrame([tuple(values.values()) or (1,)], schema)
    return row.select(expr.alias("r")).first().r


@pytest.mark.parametrize("score,code", [(-11, 1), (-10, 2), (-1, 2), (0, 3), (1, 4), (10, 4), (11, 5)])
def test_score_classes(spark, score, code):
    assert one(spark, buckets.score_code("s"), s=score) == code
    assert one(spark, buckets.score_category("s"), s=score) == buckets.SCORE_CATEGORIES[code - 1]


def test_missing_score_is_in_the_last_class(spark):
    assert one(spark, buckets.score_code(F.lit(None).cast("int"))) == 5


@pytest.mark.parametrize("x,label", [(0.0, "positive"), (-0.01, "negative"), (0.5, "positive")])
def test_sentiment_category(spark, x, label):
    assert one(spark, buckets.sentiment_category("x"), x=x) == label


@pytest.mark.parametrize("x,label", [(0.1, "Republican"), (-0.1, "Democratic"), (0.0, "Neutral")])
def test_leaning(spark, x, label):
    assert one(spark, buckets.leaning("x"), x=x) == label


def test_missing_leaning_is_neutral(spark):
    assert one(spark, buckets.leaning(F.lit(None).cast("double"))) == "Neutral"


@pytest.mark.parametrize("p,label,want", [(0.6, "NEGATIVE", -0.6), (-0.4, "POSITIVE", 0.4), (0.0, "NEGATIVE", 0.0)])
def test_signed_magnitude(spark, p, label, want):
    got = one(spark, buckets.signed_magnitude("p", "l"), p=p, l=label)
    assert got == want and str(got) != "-0.0"


@pytest.mark.parametrize("x,want", [(1.3, 1.0), (-1.2, -1.0), (0.4, 0.4)])
def test_clamp(spark, x, want):
    assert one(spark, buckets.clamp("x"), x=x) == want
    assert one(spark, buckets.clamp(F.lit(None).cast("double"))) is None


def test_equality_with_gaps(spark):
    null = F.lit(None).cast("double")
    assert one(spark, buckets.differs(null, null)) is True
    assert one(spark, buckets.same(F.lit(1.0), F.lit(1.0))) is True
    assert one(spark, buckets.nonzero(null)) is True
    assert one(spark, buckets.nonzero(F.lit(0.0))) is False
    assert one(spark, buckets.nan_to_null(F.lit(float("nan")))) is None


ELECTION = dt.date(2016, 11, 8)


@pytest.mark.parametrize(
    "at,weeks",
    [("2016-11-08 00:00:00", 0), ("2016-11-07 12:00:00", 0), ("2016-11-08 05:00:00", -1), ("2016-11-01 00:00:00", 1), ("2016-10-31 12:00:00", 1)],
)
def test_weeks_to_anchor(spark, at, weeks):
    assert one(spark, times.weeks_to(ELECTION, F.to_timestamp("t")), t=at) == weeks


def test_unix_text(spark):
    assert one(spark, times.unix_seconds(times.from_unix_text("t")), t="1478563200") == 1478563200
    assert one(spark, times.from_unix_text("t", lenient=True), t="soon") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, times.from_unix_text("t"), t="soon")


def test_null_rules_of_the_two_concats(spark):
    assert one(spark, text.concat_strict("a", "b"), a="a", b=None) is None
    assert one(spark, text.concat_lenient("a", "b"), a="a", b=None) == "a "


@pytest.mark.parametrize("body,n", [("  a  b\tc\n", 3), ("", 0), ("   ", 0), ("one", 1)])
def test_word_count(spark, body, n):
    assert one(spark, text.word_count("b"), b=body) == n


def test_tokens_and_ngrams(spark):
    toks = text.drop_words(text.tokens("b"), ["the"])
    assert one(spark, text.ngram_range(toks, 1, 2), b="The cat, a Élan of the cat") == [
        "cat", "élan", "of", "cat", "cat élan", "élan of", "of cat",
    ]
    assert one(spark, text.ngrams(text.tokens("b"), 3), b="aa bb") == []
    assert one(spark, text.tokens("b"), b=None) == []


def test_small_text_helpers(spark):
    assert one(spark, text.normalise_author("a"), a="\t Ann_B \n") == "ann_b"
    assert one(spark, text.spaced("a"), a="gun_control") == "gun control"
    assert one(spark, text.truncate("a", 3), a="abcdef") == "abc"
    assert one(spark, F.col("a").rlike(text.alternation(["J.R.", "x+y"])), a="about j.r. here") is True
    assert one(spark, F.col("a").rlike(text.alternation(["J.R."])), a="JXRX") is False


def test_hash_fraction_is_repeatable_and_close(spark):
    ids = spark.range(20_000)
    kept = ids.where(hashing.below_fraction("id", 0.3, 1))
    assert kept.count() == kept.count()
    assert abs(kept.count() / 20_000 - 0.3) < 0.02
    assert ids.where(hashing.below_fraction("id", 1.0, 1)).count() == 20_000
