import math
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadlens.operators import ngrams, term_blocks
from threadlens.plans import datasets as ds
from threadlens.plans import text_queries

ROWS = [
    (1, "a", "x", "red fox red"), (2, "a", "y", "red dog"), (3, "b", "x", ""), (4, "b", "y", None), (5, "b", "x", "Fox red fox, größe"),
    (6, "a", "x", "fox"), (6, "a", "y", "fox dog"), (None, "b", "x", "owl red"), (None, "b", "y", "owl owl"), (7, None, "x", "red owl"),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "id int, grp string, home string, body string").repartition(3)


def plain(rows, cap=None):
    """Weight by place of the row and n-gram; rows of one id share a length."""
    bags = {}
    for i, (_, _, _, text) in enumerate(rows):
        toks = (text or "").lower().replace(",", "").split()
        bags[i] = Counter(toks + [" ".join(p) for p in zip(toks, toks[1:])])
    df, total = Counter(g for bag in bags.values() for g in bag), sum(bags.values(), Counter())
    kept = sorted(total, key=lambda g: (-total[g], g))[:cap]
    raw = {(i, g): c * (math.log((1 + len(rows)) / (1 + df[g])) + 1) for i, bag in bags.items() for g, c in bag.items() if g in kept}
    lengths = defaultdict(float)
    for (i, _), v in raw.items():
        lengths[rows[i][0]] += v * v
    return sorted((str(rows[i][0]), rows[i][2], g, bags[i][g], round(v / math.sqrt(lengths[rows[i][0]]), 9)) for (i, g), v in raw.items())


def got(weights):
    return sorted((str(r.id), r.home, r.ngram, r.tf, round(r.weight, 9)) for r in weights.collect())


@pytest.mark.parametrize("cap", [None, 3])
def test_weights_over_blocks_match_a_direct_computation(spark, cap):
    terms = ngrams.document_terms(frame(spark), keep=("id", "home"))
    assert got(ngrams.tfidf(terms, max_features=cap)) == plain(ROWS, cap)


@pytest.mark.parametrize("cap", [None, 3])
def test_groups_have_their_own_weights_and_rows_without_a_group_none(spark, cap):
    terms = ngrams.document_terms(frame(spark), keep=("id", "grp", "home"))
    want = sorted(row for g in "ab" for row in plain([r for r in ROWS if r[1] == g], cap))
    assert got(ngrams.tfidf(terms, by=["grp"], max_features=cap)) == want


def test_no_rows_give_no_weights(spark):
    terms = ngrams.document_terms(frame(spark).where("id > 99"))
    assert ngrams.tfidf(terms).count() == 0 and ngrams.ngram_counts(terms).count() == 0


def test_pieces_hold_whole_rows_in_order(monkeypatch):
    monkeypatch.setattr(term_blocks, "BLOCK_GRAMS", 4)
    grams = [["a"] * n for n in (1, 2, 0, 9, 1, 1, 3, 0)]
    batches = [pa.RecordBatch.from_pydict({"grams": pa.array(g, pa.list_(pa.string()))}) for g in (grams[:5], grams[5:6], grams[6:])]
    sizes = [[len(g) for g in p.column("grams").to_pylist()] for p in term_blocks._pieces(iter(batches))]
    assert sizes == [[1, 2, 0, 9], [1, 1, 3], [0]]


def test_a_text_has_the_same_bucket_in_every_block():
    texts = ["", "a", "b", "größe", "a b", "x" * 300]
    places = {}
    for some in (texts, texts[::-1], texts[2:4]):
        order, sizes = term_blocks._bucket_order(pa.array(["pad", *some], pa.string()).slice(1), 7)
        for bucket, place in zip([b for b, n in enumerate(sizes) for _ in range(n)], order.tolist()):
            assert places.setdefault(some[place], bucket) == bucket
    packed = term_blocks._packed_texts(pa.array(["pad", *texts], pa.string()).slice(1))
    assert term_blocks._unpacked_texts(*packed).to_pylist() == texts


def test_weights_are_spelled_out_without_sorting_or_shuffling_documents_and_ngrams(spark, plan):
    shown = plan(ngrams.tfidf(ngrams.document_terms(frame(spark).dropDuplicates(["id"]))))
    assert "Window" not in shown and shown.index("MapInArrow") < shown.index("ShuffledHashJoin") < shown.index("Exchange")


def test_counts_are_added_up_in_blocks_before_the_shuffle(spark, plan):
    counts = text_queries.ngram_counts(spark, "/root/testdata/sf0.001")
    assert "MapInArrow" in plan(counts) and "Generate" not in plan(counts)
    body = ds.document_activity(spark, "/root/testdata/sf0.001")
    long = ngrams.long_terms(ngrams.document_terms(body, stopwords=ds.STOPWORDS)).groupBy("ngram").agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
    assert counts.exceptAll(long).isEmpty() and counts.count() == long.count()
