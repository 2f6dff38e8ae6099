"""Quality rules whose cutoffs are chosen on labelled holdouts with a guaranteed limit on false rejections."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.common import indices, texts
from threadlens.session import written

_SPACE = r"[ \t-\r]+"
#: Rule to its cutoffs, laxest last; a document is rejected where the measure is above the cutoff.
CUTOFFS = {
    "symbols_per_word": [0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9, 1.5, 3.0],
    "duplicate_lines": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9],
    "repeated_words": [0.02, 0.04, 0.06, 0.08, 0.1, 0.12, 0.14, 0.16, 0.18],
    "long_words": [7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0, 50.0],
    "short_words": [-4.0, -3.8, -3.5, -3.2, -3.0, -2.8, -2.5, -2.0, -1.5],
    "few_words": [-100.0, -80.0, -60.0, -50.0, -40.0, -30.0, -20.0, -15.0, -12.0],
}


def _with_repeats(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words inside 5-word windows that occur twice or more.

    Equal windows meet when their digests are sorted with their places; then the stretches that they cover are added up.
    Each array is a column of its own, so that no lambda computes it anew.
    """
    words, ordered, starts = F.col("words"), F.col("ordered"), F.col("starts")
    same = lambda j, k: F.get(ordered, j)["h"].eqNullSafe(F.get(ordered, k)["h"])
    out = df.withColumn("hashes", F.when(F.col("n") >= 5, F.transform(F.sequence(F.lit(0), F.col("n") - 5), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)]))))
    out = out.withColumn("ordered", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    out = out.withColumn("starts", F.filter(indices(F.size("ordered")), lambda j: same(j, j - 1) | same(j, j + 1)))
    out = out.withColumn("starts", F.sort_array(F.transform("starts", lambda j: F.when(F.get(ordered, j)["h"].isNotNull(), F.get(ordered, j)["i"]))))
    covered = F.aggregate(indices(F.size(starts)), F.lit(0).cast("long"), lambda n, j: n + F.least(F.lit(5), F.coalesce(F.get(starts, j + 1) - F.get(starts, j), F.lit(5))))
    return out.withColumn("n_repeat_words", F.when(F.size(starts) > 0, covered).otherwise(0).cast("long")).drop("hashes", "ordered", "starts")


def text_measures(docs: DataFrame, *more: str) -> DataFrame:
    """Counts of every whole text: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Words are runs of characters other than space, tab to carriage return. A null text counts as empty, with 0 everywhere.
    """
    split = texts(docs, *more).withColumn("words", F.array_remove(F.split("text", _SPACE), "")).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    ).withColumn("n", F.size("words"))
    counted = split.select(
        "doc_id", *more, "words", "n", F.col("n").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    return _with_repeats(counted).drop("words", "n")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _measures() -> Column:
    """The rules of CUTOFFS in their order, each with the number of its cutoffs that the document exceeds."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    value = {
        "symbols_per_word": F.col("n_symbols") / words, "duplicate_lines": F.col("n_dup_lines") / lines, "repeated_words": F.col("n_repeat_words") / words,
        "long_words": F.col("word_chars") / words, "short_words": -F.col("word_chars") / words, "few_words": -F.col("n_words").cast("double"),
    }
    return F.array(*[
        F.struct(F.lit(rule).alias("rule"), sum(((value[rule] > c).cast("int") for c in cutoffs), F.lit(0)).alias("level")) for rule, cutoffs in CUTOFFS.items()
    ])


def _log_gamma(z: Column) -> Column:
    """Stirling's series 8 above z, taken back by the recurrence; exact to about 1e-14 from z = 1 on."""
    x = z + 8
    series = (x - 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5))
    return series - sum((F.log(z + k) for k in range(8)), F.lit(0.0))


def binomial_tail(hits: Column, trials: Column, rate: Column) -> Column:
    """P(X <= hits) for X binomial(trials, rate) where hits < trials * rate, else 1: the exact test of `rate or more`.

    Starts at the probability of `hits` and adds the smaller ones down to 0, or until they no longer count.
    """
    log_p = (
        _log_gamma(trials + 1.0) - _log_gamma(hits + 1.0) - _log_gamma(trials - hits + 1.0) + hits * F.log(rate) + (trials - hits) * F.log(1 - rate)
    )
    steps = F.least(hits.cast("double"), F.ceil(12 * F.sqrt(trials)) + 100).cast("int")
    total = F.aggregate(
        indices(steps), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda a, j: F.struct(
            (a["term"] * (hits - j) * (1 - rate) / ((trials - hits + j + 1) * rate)).alias("term"),
            (a["sum"] + a["term"] * (hits - j) * (1 - rate) / ((trials - hits + j + 1) * rate)).alias("sum"),
        ),
    )["sum"]
    return F.when(hits < trials * rate, F.least(F.exp(log_p) * total, F.lit(1.0))).otherwise(F.lit(1.0))


def certified_cutoffs(labelled: DataFrame, risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """stratum, rule, level (number of the strictest certified cutoff, from 1), hits, trials, p_value.

    `labelled` has stratum, good (boolean) and the counts of `text_measures`. A cutoff is certified where the exact
    binomial test rejects a false-rejection rate of `risk` / rules or more among good documents of the stratum. Cutoffs
    of a rule are tested from the laxest on, up to the first that fails (fixed sequence), and `error` is divided by rules
    and strata (Bonferroni): with probability 1 - `error`, no stratum loses more than `risk` of its good documents.
    A certified cutoff is used only if it rejects a larger part of the bad than of the good. Strata without enough labels
    get none. Null labels are left out.
    """
    rows = labelled.where("good is not null").select("stratum", "good", F.explode(_measures()).alias("m")).select("stratum", "good", "m.rule", "m.level")
    counts = written(rows.groupBy("stratum", "rule", "level").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")), "levels")
    strata = max(1, counts.select("stratum").distinct().count())
    totals = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("trials"), F.sum("bad").alias("bad_trials"))
    levels = len(next(iter(CUTOFFS.values())))
    above = counts.select("stratum", "rule", "good", "bad", F.explode(indices(F.col("level"))).alias("k")).groupBy("stratum", "rule", "k").agg(
        F.sum("good").alias("hits"), F.sum("bad").alias("bad_hits")
    )
    tests = (
        totals.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))).join(above, ["stratum", "rule", "k"], "left")
        .fillna(0, ["hits", "bad_hits"])
    )
    tried = tests.withColumn("p_value", binomial_tail(F.col("hits"), F.col("trials"), F.lit(risk / len(CUTOFFS))))
    passed = F.col("p_value") <= error / len(CUTOFFS) / strata
    sequence = Window.partitionBy("stratum", "rule").orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, 0)
    useful = F.col("bad_hits") * F.col("trials") > F.col("hits") * F.col("bad_trials")
    chosen = tried.withColumn("certified", F.min(passed).over(sequence)).where(F.col("certified") & useful)
    return chosen.groupBy("stratum", "rule").agg(F.min_by(F.struct((F.col("k") + 1).alias("level"), "hits", "trials", "p_value"), "k").alias("c")).select("stratum", "rule", "c.*")


def quality_verdicts(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """Counts of every document, base_failed, kept, and the rules it broke.

    Documents are measured once and written; a document labelled twice counts as good if one label says so. Null strata are
    one stratum. Without labels no cutoff is certified and `kept` is the opposite of `base_failed`. Repeated rows stay.
    """
    measured = written(text_measures(docs.withColumn("_stratum", F.coalesce(F.col(stratum).cast("string"), F.lit(""))), "_stratum"), "measures").withColumnRenamed("_stratum", "stratum")
    good = labels.where("doc_id is not null").groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
    cutoffs = certified_cutoffs(measured.join(good, "doc_id").where(~base_failed()), risk, error)
    by_stratum = written(cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "level"))).alias("cutoffs")), "cutoffs")
    broken = F.transform(F.filter(_measures(), lambda m: m["level"] >= F.coalesce(F.element_at(F.col("cutoffs"), m["rule"]), F.lit(99))), lambda m: m["rule"])
    judged = measured.join(by_stratum, "stratum", "left").withColumn("broken_rules", F.when(F.col("cutoffs").isNull(), F.array().cast("array<string>")).otherwise(broken))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"),
        (~base_failed() & (F.size("broken_rules") == 0)).alias("kept"), "broken_rules",
    )
