"""Secrets in text: fixed patterns, and strings that a character Markov model finds random rather than ordinary."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.common import texts

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
#: The characters of keys and identifiers; what is not among them has index 0, the start of a string too.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_STATES = len(ALPHABET) + 1
_CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
_STRING = r"[A-Za-z0-9+/_=-]{12,}"
#: Words of two letters or more, joined by signs or capitals, and up to three digits at the end.
_ORDINARY = r"^(?:[+/_=-]*[A-Z]?[a-z]{2,})+[+/_=-]*[0-9]{0,3}$"


def _pairs(token: Column) -> Column:
    """A number for each pair of neighbouring characters, the start included."""
    codes = F.transform(F.split(token, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c))
    return F.transform(codes, lambda c, i: F.coalesce(F.get(codes, i - 1), F.lit(0)) * _STATES + c)


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def train_model(docs: DataFrame, prior: float = 8.0) -> np.ndarray:
    """Log-likelihood ratio, random against ordinary, of each transition; a flat array of states x states.

    Labelled samples are taken from all documents: values, access keys and hex strings that the fixed patterns find are
    random; other strings of 12 or more of the same characters are ordinary if they are made of words (`_ORDINARY`), and
    unlabelled if not. Only counts of transitions are gathered (as
    many as there are pairs of characters). A transition's chance leans on its character's own frequency as `prior` counts
    would, so that rare starting characters tell something too. Without samples both models are uniform and the ratio is 0.
    """
    text = texts(docs).select("text")
    is_secret = F.lit("|".join((ASSIGN, ACCESS, HEX)))
    marked = text.withColumn("values", F.array_union(
        F.filter(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 12), F.array_union(_found(F.col("text"), ACCESS), _found(F.col("text"), HEX))
    ))
    rest = F.when(F.size("values") > 0, F.regexp_replace("text", is_secret, F.lit(" "))).otherwise(F.col("text"))
    samples = marked.select(F.explode(F.array(
        F.struct(F.lit(1).alias("secret"), F.col("values").alias("tokens")), F.struct(F.lit(0).alias("secret"), F.filter(_found(rest, _STRING), lambda t: t.rlike(_ORDINARY)).alias("tokens"))
    )).alias("s")).select("s.secret", F.explode("s.tokens").alias("token"))
    counted = samples.select("secret", F.explode(_pairs(F.col("token"))).alias("pair")).groupBy("secret", "pair").count().collect()
    counts = np.full((2, _STATES, _STATES), 0.0)
    for row in counted:
        counts[row["secret"], row["pair"] // _STATES, row["pair"] % _STATES] += row["count"]
    alone = counts.sum(axis=1, keepdims=True) + 1
    chances = np.log((counts + prior * alone / alone.sum(axis=2, keepdims=True)) / (counts.sum(axis=2, keepdims=True) + prior))
    return (chances[1] - chances[0]).ravel()


def _score(token: Column, model: np.ndarray) -> Column:
    table = F.array(*[F.lit(round(float(x), 6)) for x in model])
    return F.aggregate(_pairs(token), F.lit(0.0), lambda s, p: s + F.get(table, p))


def _spans(text: Column, pattern: str, kind: str, keep) -> tuple[Column, Column, Column]:
    """Matches, the text between them, and from both the (start, rank, stop, kind) of the matches that `keep` accepts."""
    found, gaps = _found(text, pattern), F.split(text, pattern, -1)
    number, empty = KINDS.index(kind), F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")

    def step(a: Column, pair: Column) -> Column:
        match = pair["match"]
        start = a["at"] + F.length(pair["gap"])
        span = F.struct(start.alias("start"), F.lit(number).alias("rank"), (start + F.length(match)).alias("stop"), F.lit(kind).alias("kind"))
        return F.struct((start + F.length(match)).alias("at"), F.when(keep(match), F.concat(a["spans"], F.array(span))).otherwise(a["spans"]).alias("spans"))

    return found, F.when(F.size(f"_{kind}") > 0, gaps).otherwise(F.array().cast("array<string>")), F.aggregate(
        F.zip_with(f"_{kind}", F.slice(f"_{kind}_gaps", 1, F.size(f"_{kind}")), lambda m, g: F.struct(m.alias("match"), g.alias("gap"))),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")), step,
    )["spans"]


def with_spans(docs: DataFrame, text: str, model: np.ndarray, threshold: float = 12.0) -> DataFrame:
    """Adds base_spans and spans, arrays of (start, rank, stop, kind) in code points, ordered by start, then kind.

    base_spans are those of the fixed patterns. spans adds `random` ones: strings of 16 or more key characters, at least
    `threshold` nats likelier under the random model, that touch no base span. Null and empty texts have no spans.
    """
    rules = {
        "assign": (ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12), "access": (ACCESS, lambda m: F.lit(True)),
        "hex": (HEX, lambda m: F.lit(True)), "random": (_CANDIDATE, lambda m: _score(m, model) >= threshold),
    }
    out = docs
    for kind, (pattern, keep) in rules.items():
        found, gaps, spans = _spans(F.coalesce(F.col(text), F.lit("")), pattern, kind, keep)
        out = out.withColumn(f"_{kind}", found).withColumn(f"_{kind}_gaps", gaps).withColumn(f"_{kind}", spans).drop(f"_{kind}_gaps")
    out = out.withColumn("base_spans", F.sort_array(F.concat("_assign", "_access", "_hex")))
    free = F.filter(F.col("_random"), lambda r: ~F.exists("base_spans", lambda b: (b["start"] < r["stop"]) & (r["start"] < b["stop"])))
    return out.withColumn("spans", F.sort_array(F.concat("base_spans", free))).drop(*[f"_{kind}" for kind in KINDS])


def written_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame, threshold: float = 12.0) -> DataFrame:
    """Every document with its spans; trained on all of `docs`. Repeated rows stay; a null text counts as empty."""
    found = with_spans(texts(docs), "text", train_model(docs), threshold)
    number = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, KINDS[:3]), F.sha2(written_spans(F.col("base_spans")), 256).alias("base_sha256"), written_spans(F.col("spans")).alias("spans"))


def redact_secrets(docs: DataFrame, threshold: float = 12.0, mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of `text` replaced by `mark` (touching spans by one); rows without spans stay as they are."""
    found = with_spans(docs, "text", train_model(docs), threshold)

    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["at"]
        piece = F.concat(F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.lit(mark))
        return F.struct(F.greatest(a["at"], s["stop"]).alias("at"), F.when(new, F.concat(a["out"], piece)).otherwise(a["out"]).alias("out"))

    cut = F.aggregate(F.col("spans"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return found.withColumn("text", F.when(F.size("spans") > 0, cut).otherwise(F.col("text"))).drop("spans", "base_spans")
