import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadlens.operators import ngrams

DOCS = [(1, "a", "red fox red"), (2, "a", "red dog"), (3, "b", "the the"), (4, "b", None), (5, "b", "Fox red fox")]


def brute(docs, stop=("the",), n=(1, 2)):
    bags = {}
    for i, _, text in docs:
        toks = [t for t in (text or "").lower().split() if t not in stop]
        bags[i] = Counter(" ".join(toks[j : j + k]) for k in n for j in range(len(toks) - k + 1))
    df = Counter(g for bag in bags.values() for g in bag)
    out = {}
    for i, bag in bags.items():
        raw = {g: c * (math.log((1 + len(docs)) / (1 + df[g])) + 1) for g, c in bag.items()}
        length = math.sqrt(sum(v * v for v in raw.values())) or 1
        out.update({(i, g): v / length for g, v in raw.items()})
    return out


def frame(spark):
    return spark.createDataFrame(DOCS, "id int, grp string, body string")


def test_weights_match_a_direct_computation(spark):
    terms = ngrams.document_terms(frame(spark), stopwords=["the"])
    got = {(r.id, r.ngram): r.weight for r in ngrams.tfidf(terms).collect()}
    assert got == pytest.approx(brute(DOCS))


def test_group_fits_are_separate(spark):
    terms = ngrams.document_terms(frame(spark), stopwords=["the"], keep=("id", "grp"))
    got = {(r.id, r.ngram): r.weight for r in ngrams.tfidf(terms, by=["grp"]).collect()}
    want = {}
    for g in "ab":
        want.update(brute([d for d in DOCS if d[1] == g]))
    assert got == pytest.approx(want)


def test_counts_and_capped_vocabulary(spark):
    counts = ngrams.ngram_counts(ngrams.document_terms(frame(spark), stopwords=["the"], low=1, high=1))
    assert {r.ngram: (r.tf, r.df) for r in counts.collect()} == {"red": (4, 3), "fox": (3, 2), "dog": (1, 1)}
    assert [r.ngram for r in ngrams.vocabulary(counts, 2).collect()] == ["red", "fox"]


def test_capped_rows_have_unit_length(spark):
    terms = ngrams.document_terms(frame(spark), stopwords=["the"])
    norms = ngrams.tfidf(terms, max_features=3).groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert norms and all(r.n == pytest.approx(1.0) for r in norms)


def test_ties_are_alphabetical(spark):
    totals = spark.createDataFrame([("b", 1.0), ("a", 1.0 + 1e-13), ("c", 2.0)], "ngram string, weight double")
    assert [r.ngram for r in ngrams.top_ngrams(totals, 2).collect()] == ["c", "a"]


def test_profile_and_matrix(spark):
    weights = ngrams.tfidf(ngrams.document_terms(frame(spark), stopwords=["the"], keep=("id", "grp")))
    profile = ngrams.ngram_profile(weights, "grp", 1)
    assert {r.ngram for r in profile.collect()} == {"red"}
    wide = ngrams.profile_matrix(profile, "grp", ["red", "owl"], spark.createDataFrame([("a",), ("z",)], "grp string"))
    rows = {r.grp: (r.red, r.owl) for r in wide.collect()}
    assert rows["a"][0] > 0 and rows["z"] == (0.0, 0.0)


def test_term_counting_needs_no_shuffle_and_the_join_is_never_a_blind_broadcast(spark, plan):
    terms = ngrams.document_terms(frame(spark).repartition(8), stopwords=["the"])
    assert plan(terms).count("Exchange") == 1
    assert "ShuffledHashJoin" in plan(ngrams.tfidf(terms))
    assert "TakeOrderedAndProject" in plan(ngrams.top_ngrams(ngrams.ngram_totals(ngrams.tfidf(terms)), 5))
