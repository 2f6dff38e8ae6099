"""N-gram counts and TF-IDF in long form: one row per (document, n-gram), never a dense matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.text import TOKEN_PATTERN, drop_words, ngram_range, tokens
from threadlens.operators.lexicons import lexicon_rows
from threadlens.operators.ranking import top_per_group
from threadlens.operators.term_blocks import all_weights, block_entries, bucket_count, counted_terms, picked_weights, term_blocks, weighted_terms
from threadlens.session import written


def default_stopwords(language: str = "english") -> list[str]:
    """Spark's own list of a language (needs a running session)."""
    return StopWordsRemover.loadDefaultStopWords(language)


def stopwords_from(table: DataFrame) -> list[str]:
    """The distinct words of a stopword table (`schemas.STOPWORDS`), in lower case; its size is checked."""
    return [r.word for r in lexicon_rows(table.select(F.lower("word").alias("word")).dropna().distinct(), "word")]


def document_terms(
    df: DataFrame,
    text: str = "body",
    stopwords: Sequence[str] = (),
    low: int = 1,
    high: int = 2,
    pattern: str = TOKEN_PATTERN,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """Each document's n-grams as they stand (`grams`), and with their counts as an array column `terms` of (ngram, tf).

    Counting happens inside the row, by sorting the document's n-grams and measuring the runs, so no shuffle
    is needed to get from text to term frequencies. What only asks which n-grams a document has reads `grams`, and the
    counting falls away.
    """
    grams = (
        df.select(*keep, drop_words(tokens(text, pattern), stopwords).alias("_tokens"))
        .select(*keep, ngram_range(F.col("_tokens"), low, high).alias("grams"))
        .select(*keep, "grams", F.sort_array("grams").alias("_grams"))
    )
    g = F.col("_grams")
    starts = grams.select(
        *keep, "grams", "_grams",
        F.filter(
            F.transform(g, lambda x, i: F.when((i == 0) | (x != F.get(g, i - 1)), i)), lambda p: p.isNotNull()
        ).alias("_starts"),
    )
    s = F.col("_starts")
    return starts.select(
        *keep, "grams",
        F.transform(
            s,
            lambda p, i: F.struct(
                F.get(g, p).alias("ngram"),
                (F.coalesce(F.get(s, i + 1), F.size(g)) - p).cast("bigint").alias("tf"),
            ),
        ).alias("terms"),
    )


def long_terms(terms: DataFrame) -> DataFrame:
    """One row per document and n-gram.

    The outer form keeps the optimizer from inferring a non-empty filter on `terms`, which it would push below
    the staged columns and so repeat the whole text expression inside itself.
    """
    return terms.select(*_keys(terms), F.inline_outer("terms")).where(F.col("ngram").isNotNull())


def _keys(terms: DataFrame) -> list[str]:
    return [c for c in terms.columns if c not in ("grams", "terms")]


def ngram_counts(terms: DataFrame) -> DataFrame:
    """Corpus count and document count per n-gram, added up within blocks of documents before the shuffle."""
    return counted_terms(terms).groupBy("ngram").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def vocabulary(counts: DataFrame, size: int) -> DataFrame:
    """The `size` n-grams with the highest corpus count, ties in alphabetical order."""
    return counts.orderBy(F.desc("tf"), "ngram").limit(size)


def tfidf(
    terms: DataFrame, by: Sequence[str] = (), max_features: int | None = None, key: str = "id"
) -> DataFrame:
    """TF-IDF weights in long form: raw counts times ln((1+N)/(1+df)) + 1, each document scaled to length 1.

    With `by`, a separate fit per group of those columns (which `terms` must carry); rows without a group have no weights.
    The documents' terms are written once in blocks (`term_blocks`), whose distinct n-grams meet in buckets to count documents.
    With `max_features` the n-gram table has a fixed size and, without `by`, is broadcast. The weights go back to the blocks as
    packed lists by a hinted shuffle join, and are spelled out per document and n-gram without a further shuffle. Only where a
    `key` repeats, whose rows share one length, are the rows brought together by it.
    """
    by = list(by)
    keys = _keys(terms)
    blocks = written(term_blocks(terms.dropna(subset=by) if by else terms, keys, by), "term-blocks")
    buckets = None
    if max_features is None:
        buckets = bucket_count(blocks)
        weights = all_weights(blocks, buckets, by)
    else:
        entries = block_entries(blocks, by)
        counts = entries.groupBy(*by, "ngram").agg(F.sum("df").alias("_df"), F.sum("tf").alias("_total"))
        order = [F.desc("_total"), F.col("ngram")]
        counts = top_per_group(counts, by, order, max_features) if by else counts.orderBy(*order).limit(max_features)
        if by:
            counts = counts.join(written(blocks.groupBy(*by).agg(F.sum("docs").alias("_docs")), "docs"), by)
        docs = F.col("_docs") if by else blocks.agg(F.sum("docs").alias("n")).select("n").scalar()
        idf = counts.select(*by, "ngram", (F.log((docs + 1) / (F.col("_df") + 1)) + 1).alias("_idf"))
        weights = picked_weights(entries.join(idf.hint("shuffle_hash") if by else F.broadcast(idf), [*by, "ngram"]))
    weights = written(weights, "block-weights")
    lone = blocks.select(*by, F.explode(F.transform("rows", lambda r: r[key])).alias("_key")).groupBy(*by, "_key").count().where("count > 1").isEmpty()
    rows = weighted_terms(blocks, weights, keys, buckets, scaled=lone)
    if lone:
        return rows
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*by, key)))
    return rows.withColumn("weight", F.col("weight") / length)


def ngram_totals(weights: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Summed weight per n-gram, within each group of `by` when given."""
    return weights.groupBy(*by, "ngram").agg(F.sum("weight").alias("weight"))


def top_ngrams(totals: DataFrame, n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The n n-grams of highest weight, per group when `by` is given; ties in alphabetical order.

    Weights are compared after rounding to 9 digits, so that the order of summation cannot break a tie.
    """
    order = [F.desc(F.round("weight", 9)), F.col("ngram")]
    return top_per_group(totals, list(by), order, n) if by else totals.orderBy(*order).limit(n)


def ngram_profile(weights: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Weight per key and n-gram for the corpus-wide top n, in long form.

    The ranking comes first, so that totals per key are only made of the top n. `weights` is read twice.
    """
    top = written(top_ngrams(ngram_totals(weights), n).select("ngram"), "top")
    return ngram_totals(weights.join(F.broadcast(top), "ngram", "left_semi"), [key]).select("ngram", key, "weight")


def profile_matrix(profile: DataFrame, key: str, ngrams: Sequence[str], keys: DataFrame | None = None) -> DataFrame:
    """The profile with one column per n-gram, zeros where absent; `keys` adds keys that use none of them."""
    wide = profile.groupBy(key).pivot("ngram", list(ngrams)).agg(F.first("weight"))
    if keys is not None:
        wide = keys.select(key).distinct().join(wide, key, "left")
    return wide.na.fill(0.0)
