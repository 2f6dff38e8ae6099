import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from threadlens.operators import lexicon_scan, lexicons, sentiment
from threadlens.operators.lexicons import Phrase
from threadlens.operators.sentiment import Disambiguation

ENTITIES = [Row(ordinal=1, term="Alder", grp="A"), Row(ordinal=2, term="Birch", grp="A"), Row(ordinal=3, term="Cedar", grp="B"), Row(ordinal=4, term="Tim", grp="B")]
RULE = Disambiguation(("cedar", "bipod"), ("guns", "law"), "B")
S = 0.6


def stance(spark, body, community="x", boundary=False):
    df = spark.createDataFrame([(1, body, community, S)], "id int, body string, subreddit string, sentiment double")
    row = sentiment.entity_stance(df, ENTITIES, ("A", "B"), rule=RULE, boundary=boundary).first()
    return row.stance, row.politician_mentioned


@pytest.mark.parametrize(
    "body,community,want",
    [
        ("about alder", "x", (S, True)),
        ("about CEDAR", "x", (-S, True)),
        ("cedar then birch", "x", (S, True)),
        ("nothing", "x", (S, False)),
        ("a cedar bipod", "guns", (S, False)),
        ("a cedar bipod", "x", (-S, True)),
        ("a cedar bipod for alder", "x", (-S, True)),
        ("many times", "x", (-S, True)),
        (None, "x", (S, False)),
    ],
)
def test_stance_truth_table(spark, body, community, want):
    assert stance(spark, body, community) == want


def test_whole_words_do_not_match_inside_others(spark):
    assert stance(spark, "many times", boundary=True) == (S, False)
    assert stance(spark, "so, Tim!", boundary=True) == (-S, True)


LEFT, RIGHT = Phrase(1, "gun control", -0.5), Phrase(2, "lower taxes now", 0.5, ("tax cuts",))


@pytest.mark.parametrize(
    "body,label,s,want",
    [
        ("alder wants gun control", "POSITIVE", 0.8, (0.8, True, 0.3)),
        ("alder wants lower taxes now", "POSITIVE", 0.8, (0.8, True, 1.0)),
        ("alder fears gun control", "NEGATIVE", -0.2, (-0.2, True, 0.3)),
        ("alder only", "NEGATIVE", -0.4, (-0.4, True, -0.4)),
        ("gun contrl at last", "NEGATIVE", 0.9, (0.0, False, 0.5)),
        ("nothing here", "POSITIVE", 0.9, (0.0, False, 0.0)),
        ("tax cuts for all", "POSITIVE", 0.9, (0.0, False, 0.0)),
        (None, "POSITIVE", None, (0.0, False, 0.0)),
    ],
)
def test_shift_truth_table(spark, body, label, s, want):
    df = spark.createDataFrame([(1, body, label, s)], "id int, body string, label string, sentiment double")
    row = sentiment.shift_cases(sentiment.mention_flags(df, ENTITIES, [LEFT, RIGHT]), [LEFT, RIGHT]).first()
    assert (row.sentiment, row.politician_mentioned, row.shifted) == (pytest.approx(want[0]), want[1], pytest.approx(want[2]))


def test_synonym_passes_the_loose_match_only(spark):
    df = spark.createDataFrame([(1, "tax cuts for all")], "id int, body string")
    row = sentiment.mention_flags(df, ENTITIES, [LEFT, RIGHT]).first()
    assert row.similar_phrase == RIGHT.phrase and row.shifting_phrase is None


def test_first_phrase_in_order_wins(spark):
    short, long = Phrase(1, "voter id", 0.5), Phrase(2, "against voter id", -0.5)
    df = spark.createDataFrame([("against voter id laws",)], "body string")
    for order, want in (([short, long], "voter id"), ([long, short], "against voter id")):
        assert lexicons.with_fuzzy_phrase(df, order).first().phrase == want


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@pytest.mark.parametrize("strict, spread", [(True, 0), (False, 0), (True, 1), (False, 1), (True, 2)])
def test_blocking_loses_no_fuzzy_match(spark, strict, spread):
    """Blocked, unblocked and brute-force matches agree on texts with damaged phrases."""
    rng = random.Random(7)
    phrases = [Phrase(i, p, 0.5) for i, p in enumerate(["gun control", "voter id laws", "tax", "universal health care plan", "open borders"])]
    texts = []
    for n in range(150):
        words = [w for _ in range(6) for w in rng.choice(phrases).phrase.split()[: rng.randint(1, 4)]]
        chars = list(" ".join(words))
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(chars))
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é", "ab"])
        texts.append((n, "".join(chars)))
    df = spark.createDataFrame(texts, "id int, body string")
    out = lexicons.with_fuzzy_phrase(df, phrases, name="a", strict=strict, spread=spread)
    out = lexicons.with_fuzzy_phrase(out, phrases, name="b", strict=strict, blocked=False, spread=spread)
    table = spark.createDataFrame([(p.ordinal, p.phrase.upper().replace(" ", "  ")) for p in phrases[::-1]], "ordinal int, phrase string")
    names = {p.phrase.upper().replace(" ", "  "): p.phrase for p in phrases}
    out = lexicons.with_fuzzy_phrase(out, table, name="c", strict=strict, spread=spread, block=2)
    import regex

    hits = 0
    for r in out.collect():
        words = regex.findall(r"[\p{L}\p{N}_]+", r.body.lower())
        want = None
        for p in phrases:
            counts = [k for k in range(len(p.phrase.split()) - spread, len(p.phrase.split()) + spread + 1) if k > 0]
            sims = [100.0 * (1.0 - _distance(w, p.phrase) / max(len(w), len(p.phrase))) for k in counts for w in (" ".join(words[i : i + k]) for i in range(len(words) - k + 1))]
            if any(s > 80 if strict else s >= 80 for s in sims):
                want = p.phrase
                break
        hits += want is not None
        assert r.a == r.b == want and names.get(r.c) == want, r.body
    assert 20 < hits < 150


def test_both_polarity_paths_and_null_text(spark):
    lexicon = spark.createDataFrame([("good", 2.0), ("great", 3.0), ("bad", -2.5)], "word string, valence double")
    df = spark.createDataFrame([(1, "Good, good and BAD"), (2, None), (3, "nothing"), (4, "")], "id int, body string")
    a = {r.id: r.polarity for r in sentiment.lexicon_polarity(df, lexicon).collect()}
    b = {r.id: r.polarity for r in sentiment.lexicon_polarity(df, lexicon, inline=False).collect()}
    assert a[1] == pytest.approx(1.5 / (1.5**2 + 15) ** 0.5) and a[2] is None and a[3] == a[4] == 0.0
    assert {k: v for k, v in b.items()} == pytest.approx(a)


def test_label_providers(spark):
    df = spark.createDataFrame([(1, "aa"), (2, None), (3, "b")], "id int, body string")
    labels = spark.createDataFrame([(1, 1), (3, 0)], "id int, quality int")
    got = {r.id: r.label for r in sentiment.given_label(df, labels, "id", F.col("quality") == 1).collect()}
    assert got == {1: "POSITIVE", 2: None, 3: "NEGATIVE"}
    made = sentiment.udf_label(df, lambda: lambda texts: ["POSITIVE" if "a" in t else "NEGATIVE" for t in texts])
    assert {r.id: r.label for r in made.collect()} == {1: "POSITIVE", 2: None, 3: "NEGATIVE"}


def test_early_exit_keeps_hopeless_texts_from_the_model(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)], "id int, body string, hope boolean")

    def build():
        def model(texts):
            assert list(texts) == ["a"] or not len(texts)
            return ["POSITIVE"] * len(texts)

        return model

    out = sentiment.score_hopeful(df, lambda d: sentiment.udf_label(d, build), F.col("hope"), {"label": F.lit("none")})
    assert {r.id: (r.body, r.label) for r in out.collect()} == {1: ("a", "POSITIVE"), 2: ("b", "none"), 3: ("c", "none")}


def test_synonyms_expand_with_spaces(spark):
    phrases = spark.createDataFrame([(1, "gun control", 0.5)], "ordinal int, phrase string, shift double")
    synonyms = spark.createDataFrame([("gun control", "arms_limits"), ("other", "x")], "phrase string, synonym string")
    assert {r.term for r in lexicons.expand_synonyms(phrases, synonyms).collect()} == {"gun control", "arms limits"}


def test_oversized_lexicon_is_refused(spark):
    table = spark.range(lexicons.MAX_INLINE_ENTRIES + 1).select(F.col("id").alias("ordinal"))
    with pytest.raises(ValueError, match="more than"):
        lexicons.lexicon_rows(table)


def test_large_lexicons_are_joined_by_runs_of_words(spark):
    terms = spark.createDataFrame([(2, "tax", "tax cut"), (1, "law", "new law"), (1, "law", "Law"), (3, "gun", "gun control act")], "ordinal int, phrase string, term string")
    texts = [(1, "A Tax-cut for all"), (2, "tax cut, then a LAW"), (3, "lawful"), (4, None), (5, ""), (6, "gun control act"), (7, "tax\ncut tax cut")]
    df = spark.createDataFrame(texts, "id int, body string")
    got = {r.id: r.phrase for r in lexicons.with_first_term(df, terms, (1, 2)).collect()}
    assert got == {1: "tax", 2: "law", 3: None, 4: None, 5: None, 6: None, 7: "tax"}


def test_words_written_as_one_or_cut_in_two_are_met(spark):
    df = spark.createDataFrame([(1, "a guncontrol law"), (2, "gun con trol"), (3, "gun"), (4, None), (5, "")], "id int, body string")
    assert {r.id: r.phrase for r in lexicons.with_fuzzy_phrase(df, [LEFT]).collect()} == {1: LEFT.phrase, 2: LEFT.phrase, 3: None, 4: None, 5: None}
    assert lexicons.with_fuzzy_phrase(df, [LEFT], spread=0).where("phrase is not null").count() == 0
    assert lexicons.with_fuzzy_phrase(df, []).where("phrase is not null").count() == 0
    assert {r.id: r.phrase for r in lexicons.with_fuzzy_phrase(df, [LEFT], threshold=10.0).collect()} == {1: LEFT.phrase, 2: LEFT.phrase, 3: LEFT.phrase, 4: None, 5: None}


@pytest.mark.parametrize("boundary", [False, True])
def test_substrings_of_large_lexicons(spark, monkeypatch, boundary):
    """20,000 terms in blocks, some written in between, give what the inline form gives, without raising."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 4)))
    terms = [(i, f"p{i}", f"{word().upper()}{' ' * (1 + i % 2)}{word()}" if i % 3 else f"{word()}{word()}{word()}") for i in range(20_000)]
    texts = [(i, " ".join(word() for _ in range(rng.randint(0, 30)))) for i in range(60)] + [(100, None), (101, ""), (102, "no hit"), (103, terms[19_999][2])]
    df = spark.createDataFrame(texts, "id int, body string")
    monkeypatch.setattr(lexicon_scan, "STAGED_BLOCKS", 3)
    table = spark.createDataFrame(terms, "ordinal int, phrase string, term string").repartition(3)
    got = {r.id: r.phrase for r in lexicons.with_first_substring(df, table, boundary=boundary, block=4000).collect()}
    for i, text in texts:
        hay = (text or "").lower()
        hay = f" {' '.join(hay.split())} " if boundary else hay
        want = next((p for _, p, t in terms if text is not None and (f" {' '.join(t.lower().split())} " if boundary else t.lower()) in hay), None)
        assert got[i] == want
    assert sum(p is not None for p in got.values()) > 20 and got[103] is not None
    inline = df.withColumn("_hay", lexicons.haystack("body", boundary)).select("id", lexicons.first_hit("_hay", [([t], p) for _, p, t in terms[:200]], boundary).alias("phrase"))
    few = lexicons.with_first_substring(df, table.where("ordinal < 200"), boundary=boundary).select("id", "phrase")
    assert sorted(map(tuple, inline.collect())) == sorted(map(tuple, few.collect()))


def test_empty_and_missing_terms(spark):
    df = spark.createDataFrame([(1, "law", "x"), (2, None, "y")], "id int, body string, phrase string")
    terms = spark.createDataFrame([(3, "c", ""), (2, "b", None), (5, "d", "law"), (5, "a", "la")], "ordinal int, phrase string, term string")
    assert {r.id: r.phrase for r in lexicons.with_first_substring(df, terms).collect()} == {1: "c", 2: None}
    assert {r.id: r.phrase for r in lexicons.with_first_substring(df, terms.where("ordinal = 5")).collect()} == {1: "a", 2: None}
    assert {r.id: r.phrase for r in lexicons.with_first_substring(df, terms.limit(0)).collect()} == {1: None, 2: None}


@pytest.mark.parametrize("seed", [1, 2])
def test_negations_and_boosters(spark, seed):
    """Against a plain walk over the words, with several boosters and negations in reach, at the start, and in a long text."""
    rng = random.Random(seed)
    words = ["good", "bad", "not", "never", "very", "slightly", "x", "zero"]
    valence = {"good": 1.9, "bad": -2.5, "zero": 0.0, "never": 0.5}
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for i in range(80)] + [(100, None), (101, "Not very GOOD"), (102, "not " * 3000 + "good")]
    lexicon = spark.createDataFrame(list(valence.items()), "word string, valence double")
    got = {r.id: r.polarity for r in sentiment.rule_polarity(spark.createDataFrame(texts, "id int, body string"), lexicon).collect()}
    steps = dict(sentiment.BOOSTERS)
    for i, text in texts:
        total, ws = 0.0, (text or "").lower().split()
        for at, w in enumerate(ws):
            v = valence.get(w, 0.0)
            if v:
                before = [(ws[at - d - 1], sentiment.FADE[d]) for d in range(sentiment.REACH) if at - d - 1 >= 0]
                v += (1 if v > 0 else -1) * sum(sentiment.BOOST * steps.get(b, 0) * f for b, f in before)
                for b, _ in before:
                    v *= sentiment.NEGATED if b in sentiment.NEGATIONS else 1
            total += v
        assert got[i] == (None if text is None else pytest.approx(total / (total * total + 15) ** 0.5))
    assert got[101] < 0 and sentiment.rule_polarity(spark.createDataFrame(texts[:2], "id int, body string"), lexicon.limit(0)).where("polarity = 0").count() == 2


def test_fuzzy_scan_passes_on_only_windows_that_can_reach_the_threshold():
    import random

    from threadlens.operators.lexicon_scan import PieceScanner

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = next_row(row, i, x, b)
        return row[-1]

    def next_row(row, i, x, b):
        out = [i]
        for j, y in enumerate(b, 1):
            out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
        return out

    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    targets = [(i, t, t, int(0.2 * len(t) / 0.8 + 1e-9)) for i in range(12) for t in [" ".join(words[i * 9 : i * 9 + 3]).replace("a", "b", 1)]]
    text, near = " ".join(words), lambda found: {(w["place"], w["window"]) for w in found if edits(w["target"], w["window"]) <= 0.2 * max(len(w["target"]), len(w["window"])) + 1e-9}
    loose, tight = PieceScanner(targets, 1)(text), PieceScanner(targets, 1, False, 1.0 - 80.0 / 100.0)(text)
    assert near(tight) == near(loose) == near(PieceScanner(targets, 1, True)(text)) and near(tight)
    assert len(tight) < len(loose) and all(abs(len(w["target"]) - len(w["window"])) <= 0.2 * max(len(w["target"]), len(w["window"])) + 1e-9 for w in tight)
