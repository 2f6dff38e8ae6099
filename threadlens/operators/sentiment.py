"""Sentiment polarity, label providers and the stance rules built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.functions.buckets import clamp, signed_magnitude
from threadlens.functions.text import TOKEN_PATTERN, WORD_PATTERN, _col, tokens
from threadlens.operators.lexicons import (
    MAX_INLINE_ENTRIES, Phrase, first_entity_group, first_phrase, haystack, holds, lexicon_rows, phrase_shift, with_fuzzy_phrase,
)
from threadlens.session import written

# Fixed value: damping constant of the compound score (Hutto & Gilbert 2014).
COMPOUND_ALPHA = 15.0
POSITIVE = "POSITIVE"
NEGATIVE = "NEGATIVE"


def compound(total: Column) -> Column:
    """Valence sum squeezed into (-1, 1)."""
    return total / F.sqrt(total * total + F.lit(COMPOUND_ALPHA))


def valence_sum(text: Column | str, lexicon: Sequence[tuple[str, float]]) -> Column:
    """Sum of the valences of the text's tokens, for a lexicon small enough to sit in the expression.

    Words of equal valence form one hashed set, so a token costs a few set lookups and no shuffle.
    """
    levels: dict[float, list[str]] = {}
    for word, valence in lexicon:
        levels.setdefault(float(valence), []).append(word)
    if not levels:
        return F.when(_col(text).isNotNull(), F.lit(0.0))
    known = sorted(w for ws in levels.values() for w in ws)

    def value(t: Column) -> Column:
        out = None
        for level, ws in sorted(levels.items()):
            out = F.when(t.isin(ws), level) if out is None else out.when(t.isin(ws), level)
        return out.otherwise(0.0)

    hits = F.filter(tokens(text, TOKEN_PATTERN), lambda t: t.isin(known))
    total = F.aggregate(hits, F.lit(0.0), lambda acc, t: acc + value(t))
    return F.when(_col(text).isNotNull(), total)


def lexicon_polarity(
    df: DataFrame, lexicon: DataFrame, text: str = "body", key: str = "id", name: str = "polarity", inline: bool | None = None
) -> DataFrame:
    """Add the lexicon polarity of the text; NULL text gives NULL.

    Valences of a word listed twice are added up and entries without word or valence are left out, at any size. Small
    lexicons are evaluated inside the row. Larger ones (or `inline=False`) are written, so that the planner knows their
    size; tokens are exploded, joined by word, summed per row and joined back on the key.
    """
    lexicon = lexicon.select("word", "valence").dropna().groupBy("word").agg(F.sum("valence").alias("valence"))
    if inline is not False:
        entries = lexicon.select("word", "valence").limit(MAX_INLINE_ENTRIES + 1).collect()
        if len(entries) <= MAX_INLINE_ENTRIES:
            pairs = [(r.word, r.valence) for r in entries]
            return df.withColumn(name, compound(valence_sum(text, pairs)))
        if inline:
            raise ValueError(f"lexicon has more than {MAX_INLINE_ENTRIES} entries")
    words = written(lexicon, "lexicon")
    sums = (
        df.where(F.col(text).isNotNull())
        .select(key, F.explode(tokens(text)).alias("word"))
        .join(words, "word")
        .groupBy(key)
        .agg(F.sum("valence").alias("_valence"))
    )
    scored = df.join(sums, key, "left")
    total = F.when(F.col(text).isNotNull(), F.coalesce("_valence", F.lit(0.0)))
    return scored.withColumn(name, compound(total)).drop("_valence")


#: Fixed values of the public rule-based method: the share of its valence that a negated word keeps, what a booster adds to
#: it, and how much of that is left at one, two and three words' distance.
NEGATED, BOOST, FADE, REACH = -0.74, 0.293, (1.0, 0.95, 0.9), 3
NEGATIONS = ("not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere", "cannot", "without", "hardly", "rarely")
BOOSTERS = (
    ("very", 1), ("really", 1), ("extremely", 1), ("absolutely", 1), ("completely", 1), ("totally", 1), ("so", 1), ("most", 1),
    ("slightly", -1), ("somewhat", -1), ("barely", -1), ("partly", -1), ("almost", -1), ("little", -1),
)


def rule_valence_sum(
    text: Column | str, entries: Sequence[tuple[str, float]], negations: Sequence[str] = NEGATIONS, boosters: Sequence[tuple[str, int]] = BOOSTERS
) -> Column:
    """Summed valence of the text's words under negations and boosters; NULL for NULL text.

    A listed word is strengthened (towards its own sign) or weakened by each booster among the `REACH` words before it, the
    less the farther away, and turned around by each negation there. Boosters and negations have no valence of their own
    unless they are listed. One fold over the words carries what the last few were, so a text of any length takes one pass.
    """

    def literal(pairs: Sequence[tuple[str, float]]) -> Column:
        return F.create_map(*[F.lit(x) for pair in pairs for x in pair]) if pairs else F.create_map().cast("map<string,double>")

    valences, steps = literal([(w, float(v)) for w, v in entries]), literal([(w, BOOST * s) for w, s in boosters])
    none = F.struct(F.lit(0.0).alias("boost"), F.lit(False).alias("negates"))
    start = F.struct(F.lit(0.0).alias("total"), *[none.alias(f"back{i}") for i in range(REACH)])

    def fold(state: Column, word: Column) -> Column:
        value = F.try_element_at(valences, word)
        here = F.struct(F.coalesce(F.try_element_at(steps, word), F.lit(0.0)).alias("boost"), word.isin(list(negations)).alias("negates"))
        boost = F.lit(0.0)
        turned = F.lit(1.0)
        for i in range(REACH):
            back = state[f"back{i}"]
            boost = boost + back["boost"] * FADE[i]
            turned = turned * F.when(back["negates"], NEGATED).otherwise(1.0)
        total = state["total"] + F.when(value.isNull() | (value == 0.0), 0.0).otherwise((value + F.signum(value) * boost) * turned)
        return F.struct(total.alias("total"), here.alias("back0"), *[state[f"back{i}"].alias(f"back{i + 1}") for i in range(REACH - 1)])

    summed = F.aggregate(tokens(text, WORD_PATTERN), start, fold, lambda state: state["total"])
    return F.when(_col(text).isNotNull(), summed)


def rule_polarity(
    df: DataFrame, lexicon: DataFrame, text: str = "body", name: str = "polarity",
    negations: Sequence[str] = NEGATIONS, boosters: Sequence[tuple[str, int]] = BOOSTERS,
) -> DataFrame:
    """Add the polarity of the text with negations and boosters; fails for lexicons above `MAX_INLINE_ENTRIES`."""
    lexicon = lexicon.select("word", "valence").dropna().groupBy("word").agg(F.sum("valence").alias("valence"))
    entries = [(r.word, r.valence) for r in lexicon_rows(lexicon, "word")]
    return df.withColumn(name, compound(rule_valence_sum(text, entries, negations, boosters)))


# --- label providers: each adds a POSITIVE / NEGATIVE column --------------------------------------------------


def given_label(df: DataFrame, labels: DataFrame, key: str, is_positive: Column, name: str = "label") -> DataFrame:
    """Label from a table with one row per key; rows it does not cover get NULL."""
    marked = labels.select(F.col(key), F.when(is_positive, POSITIVE).otherwise(NEGATIVE).alias(name))
    return df.join(marked, key, "left")


def udf_label(
    df: DataFrame, build: Callable[[], Callable[[Sequence[str]], Sequence[str]]], text: str = "body", name: str = "label"
) -> DataFrame:
    """Label from a user's text classifier; `build` runs once per Python worker, not per batch."""

    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = build()
        for texts in batches:
            known = texts.dropna()
            yield pd.Series(list(model(known.tolist())), index=known.index, dtype=object).reindex(texts.index)

    return df.withColumn(name, F.pandas_udf(classify, "string")(F.col(text)))


# --- scores and stances -----------------------------------------------------------------------------------------


def combined_sentiment(polarity: Column | str, label: Column | str) -> Column:
    """Magnitude from the lexicon, sign from the label."""
    return signed_magnitude(polarity, label, POSITIVE)


@dataclass(frozen=True)
class Disambiguation:
    """Two words that together mean something else in some communities, and a group's name elsewhere."""

    words: tuple[str, str]
    communities: tuple[str, ...]
    group: str


def entity_stance(
    df: DataFrame,
    entities: Sequence,
    groups: tuple[str, str],
    text: str = "body",
    score: str = "sentiment",
    community: str = "subreddit",
    rule: Disambiguation | None = None,
    boundary: bool = False,
) -> DataFrame:
    """Add `mentioned_group`, `politician_mentioned` and `stance`.

    The first group's terms are tried before the second's; a mention of the second group turns the score
    around. Substring tests by default, whole words with `boundary`. With a rule, texts holding both of its
    words count as no mention in its communities and as a mention of its group elsewhere.
    """
    group = first_entity_group("_hay", entities, groups, boundary)
    if rule is not None:
        both = holds("_hay", rule.words[0], boundary) & holds("_hay", rule.words[1], boundary)
        group = (
            F.when(both & F.col(community).isin(list(rule.communities)), F.lit(None).cast("string"))
            .when(both, F.lit(rule.group))
            .otherwise(group)
        )
    turned = F.when(F.col("mentioned_group") == groups[1], F.lit(0.0) - F.col(score)).otherwise(F.col(score))
    return (
        df.withColumn("_hay", haystack(text, boundary))
        .withColumn("mentioned_group", group)
        .withColumn("politician_mentioned", F.col("mentioned_group").isNotNull())
        .withColumn("stance", turned)
        .drop("_hay")
    )


def mention_flags(df: DataFrame, entities: Sequence, phrases: Sequence[Phrase], text: str = "body") -> DataFrame:
    """Add what the shift rules need to know of the text: entity flag, loose phrase match, shifting phrase.

    The loose match takes a phrase or synonym as a substring first, then similarity at or above 80; the
    shifting phrase needs similarity above 80.
    """
    groups = list(dict.fromkeys(e.grp for e in entities))
    hits = df.withColumn("_hay", haystack(text)).withColumns(
        {
            "politician_mentioned": first_entity_group("_hay", entities, groups).isNotNull(),
            "_phrase": first_phrase("_hay", phrases),
        }
    )
    hits = with_fuzzy_phrase(hits, phrases, text, "shifting_phrase", loose_name="_loose")
    return hits.withColumn("similar_phrase", F.coalesce("_phrase", "_loose")).drop("_hay", "_phrase", "_loose")


def shift_cases(
    df: DataFrame, phrases: Sequence[Phrase], score: str = "sentiment", label: str = "label"
) -> DataFrame:
    """Final score, mention flag and shifted score from `mention_flags` columns.

    Entity and shift: score plus shift. Entity only: the score. Shift only: score 0 and the shift alone.
    Neither (a synonym alone included): zeros. The shift takes the label's sign and the sum stays in [-1, 1].
    """
    sign = F.when(F.col(label) == POSITIVE, 1.0).otherwise(-1.0)
    shift = phrase_shift("shifting_phrase", phrases) * sign
    mentioned = F.col("politician_mentioned")
    return (
        df.withColumn("_shift", shift)
        .withColumn("shifted", F.when(mentioned, clamp(F.col(score) + F.col("_shift"))).otherwise(F.col("_shift")))
        .withColumn(score, F.when(mentioned, F.col(score)).otherwise(F.lit(0.0)))
        .drop("_shift")
    )


def score_hopeful(
    df: DataFrame, scorer: Callable[[DataFrame], DataFrame], hopeful: Column, defaults: dict[str, Column], text: str = "body"
) -> DataFrame:
    """Run a costly scorer on rows that can get a non-zero result only; the others take the defaults.

    The scorer sees NULL for the text of hopeless rows, which label providers and polarity skip, so the rows
    stay in one pass instead of being split and read twice. It must keep the columns it is given.
    """
    masked = (
        df.withColumn("_hopeful", F.coalesce(hopeful, F.lit(False)))
        .withColumn("_text", F.col(text))
        .withColumn(text, F.when(F.col("_hopeful"), F.col(text)))
    )
    out = scorer(masked).withColumn(text, F.col("_text"))
    out = out.withColumns({c: F.when(F.col("_hopeful"), F.col(c)).otherwise(v) for c, v in defaults.items()})
    return out.drop("_hopeful", "_text")
