"""Queries for sentiment, entity stance and phrase shifts over the whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions.text import WORD_PATTERN, concat_lenient, ngrams, strip, tokens
from threadlens.operators import ingest, lexicons, sentiment
from threadlens.plans import datasets as ds
from threadlens.plans import workflows
from threadlens.plans.registry import query

_TOKENS = r"regexp_extract_all(lower(body), '[\p{L}\p{N}_]{2,}')"
POLARITY = f"""SELECT d.*, coalesce(v.s, 0) / sqrt(coalesce(v.s, 0) * coalesce(v.s, 0) + 15) AS polarity FROM ({ds.LABELLED_DOCUMENTS}) d
    LEFT JOIN (SELECT id, sum(valence) AS s FROM (SELECT doc_id AS id, unnest({_TOKENS.replace('body', 'text')}) AS word FROM documents)
    JOIN {ds.sql_values(ds.VALENCES)} AS x(word, valence) USING (word) GROUP BY 1) v USING (id)"""
SENTIMENT = f"SELECT *, CASE WHEN label = 'POSITIVE' THEN abs(polarity) ELSE 0.0::DOUBLE - abs(polarity) END AS sentiment FROM ({POLARITY})"


def scored_documents(spark, sf_dir):
    rows = sentiment.lexicon_polarity(ds.labelled_documents(spark, sf_dir), ds.valence_lexicon(spark))
    return rows.withColumn("sentiment", sentiment.combined_sentiment("polarity", "label"))


@query("lexicon_polarity", f"SELECT id, round(polarity, 8) AS polarity FROM ({POLARITY})")
def lexicon_polarity(spark, sf_dir):
    rows = sentiment.lexicon_polarity(ds.document_activity(spark, sf_dir), ds.valence_lexicon(spark))
    return rows.select("id", F.round("polarity", 8).alias("polarity"))


@query("lexicon_polarity_joined", f"SELECT id, round(polarity, 8) AS polarity FROM ({POLARITY})")
def lexicon_polarity_joined(spark, sf_dir):
    """The path for lexicons too large to sit inside an expression."""
    rows = sentiment.lexicon_polarity(ds.document_activity(spark, sf_dir), ds.valence_lexicon(spark), inline=False)
    return rows.select("id", F.round("polarity", 8).alias("polarity"))


def _rule_sql() -> str:
    """Words with their three predecessors; the same arithmetic as in the fold."""
    negated = ", ".join(f"'{w}'" for w in ds.NEGATIONS)
    steps = " ".join(f"WHEN '{w}' THEN {sentiment.BOOST * s!r}::DOUBLE" for w, s in ds.BOOSTERS)
    boost = " + ".join(f"CASE b{i} {steps} ELSE 0.0::DOUBLE END * {f!r}::DOUBLE" for i, f in enumerate(sentiment.FADE))
    turned = " * ".join(f"CASE WHEN b{i} IN ({negated}) THEN {sentiment.NEGATED!r}::DOUBLE ELSE 1.0::DOUBLE END" for i in range(sentiment.REACH))
    lags = ", ".join(f"lag(word, {i + 1}) OVER (PARTITION BY id ORDER BY place) AS b{i}" for i in range(sentiment.REACH))
    return rf"""WITH w AS (SELECT id, unnest(ws) AS word, generate_subscripts(ws, 1) AS place
      FROM (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS ws FROM documents)),
    near AS (SELECT id, word, {lags} FROM w),
    s AS (SELECT id, sum((valence + sign(valence) * ({boost})) * ({turned})) AS s FROM near JOIN {ds.sql_values(ds.VALENCES)} AS x(word, valence) USING (word) GROUP BY 1)
    SELECT d.doc_id AS id, round(CASE WHEN text IS NOT NULL THEN coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) END, 8) AS polarity
    FROM documents d LEFT JOIN s ON s.id = d.doc_id"""


@query("rule_polarity", _rule_sql())
def rule_polarity(spark, sf_dir):
    """Polarity with negations and boosters among the three words before a listed word."""
    rows = sentiment.rule_polarity(ds.document_activity(spark, sf_dir), ds.valence_lexicon(spark), negations=ds.NEGATIONS, boosters=ds.BOOSTERS)
    return rows.select("id", F.round("polarity", 8).alias("polarity"))


@query("combined_sentiment", f"SELECT id, label, round(sentiment, 8) AS sentiment FROM ({SENTIMENT})")
def combined_sentiment(spark, sf_dir):
    return scored_documents(spark, sf_dir).select("id", "label", F.round("sentiment", 8).alias("sentiment"))


def _group_sql(hay: str, boundary: bool) -> str:
    cases = " ".join(
        f"WHEN contains({hay}, '{f' {t} ' if boundary else t}') THEN '{g}'" for group in "AB" for _, t, g in ds.ENTITIES if g == group
    )
    return f"CASE {cases} END"


_PADDED = r"' ' || array_to_string(regexp_extract_all(lower(body), '[\p{L}\p{N}_]+'), ' ') || ' '"


def _stance_sql(group: str) -> str:
    return f"""SELECT id, grp AS mentioned_group, grp IS NOT NULL AS politician_mentioned,
    round(CASE WHEN grp = 'B' THEN 0.0::DOUBLE - sentiment ELSE sentiment END, 8) AS stance FROM (SELECT *, {group} AS grp FROM ({SENTIMENT}))"""


def _stance(rows, **options):
    out = sentiment.entity_stance(rows, _entities(rows.sparkSession), ("A", "B"), **options)
    return out.select("id", "mentioned_group", "politician_mentioned", F.round("stance", 8).alias("stance"))


def _entities(spark):
    return lexicons.lexicon_rows(ds.entity_lexicon(spark))


@query("entity_stance", _stance_sql(_group_sql("lower(body)", False)))
def entity_stance(spark, sf_dir):
    return _stance(scored_documents(spark, sf_dir))


@query("entity_stance_words", _stance_sql(_group_sql(_PADDED, True)))
def entity_stance_words(spark, sf_dir):
    return _stance(scored_documents(spark, sf_dir), boundary=True)


_RULE = sentiment.Disambiguation(("thing", "with"), ("src0", "src1", "src2"), "B")


@query(
    "disambiguated_stance",
    _stance_sql(
        f"""CASE WHEN contains(lower(body), 'thing') AND contains(lower(body), 'with') AND subreddit IN ('src0', 'src1', 'src2') THEN NULL
        WHEN contains(lower(body), 'thing') AND contains(lower(body), 'with') THEN 'B' ELSE {_group_sql('lower(body)', False)} END"""
    ),
)
def disambiguated_stance(spark, sf_dir):
    return _stance(scored_documents(spark, sf_dir), rule=_RULE)


@query(
    "flagged_posts",
    rf"""SELECT id, trim(author) AS author, subreddit, {_group_sql('lower(body)', False)} AS mentioned_group FROM
    (SELECT author, id, subreddit, body FROM ({ds.COMMENTS}) UNION ALL
     SELECT author, id, subreddit, title || ' ' || coalesce(selftext, '') FROM ({ds.SUBMISSIONS})) WHERE mentioned_group IS NOT NULL""",
)
def flagged_posts(spark, sf_dir):
    """Posts and comments that mention an entity, with the mentioned group."""
    posts = ds.submissions(spark, sf_dir).withColumn("body", concat_lenient("title", "selftext")).drop("title", "selftext")
    rows = ingest.concat_frames(ds.comments(spark, sf_dir), posts).withColumn("author", strip("author")).withColumn("sentiment", F.lit(0.0))
    hits = sentiment.entity_stance(rows, _entities(spark), ("A", "B")).where("politician_mentioned")
    return hits.select("id", "author", "subreddit", "mentioned_group")


# --- phrases ---------------------------------------------------------------------------------------------------------

_SYNONYMS = tuple((p, s.replace("_", " ")) for p, s in ds.SYNONYMS)
_TERMS = tuple((o, p, t) for o, p, _ in ds.PHRASES for t in [p, *[s for q, s in _SYNONYMS if q == p]])


def _phrases(spark):
    synonyms = ds.synonym_table(spark).withColumn("synonym", F.translate("synonym", "_", " "))
    return lexicons.load_phrases(ds.phrase_lexicon(spark), synonyms)


@query(
    "synonym_expansion",
    f"""SELECT ordinal, phrase, term, (SELECT count(*) FROM documents WHERE contains(lower(text), term)) AS documents
    FROM {ds.sql_values(_TERMS)} AS x(ordinal, phrase, term)""",
)
def synonym_expansion(spark, sf_dir):
    """Each phrase with its synonyms and the number of documents holding the term."""
    terms = lexicons.expand_synonyms(ds.phrase_lexicon(spark), ds.synonym_table(spark))
    names = lexicons.lexicon_rows(terms.select("term").distinct(), "term")
    rows = ds.document_activity(spark, sf_dir).withColumn("_hay", lexicons.haystack("body"))
    counted = rows.agg(
        F.array(*[F.struct(F.lit(r.term).alias("term"), F.count_if(lexicons.holds("_hay", r.term)).alias("documents")) for r in names]).alias("c")
    ).select(F.inline("c"))
    return terms.join(counted, "term").select("ordinal", "phrase", "term", "documents")


def _first_phrase_sql(hay: str = "lower(body)", boundary: bool = False) -> str:
    edge = " " if boundary else ""
    tests = " ".join(
        f"WHEN {' OR '.join(f'''contains({hay}, '{edge}{t}{edge}')''' for o2, _, t in _TERMS if o2 == o)} THEN '{p}'" for o, p, _ in ds.PHRASES
    )
    return f"CASE {tests} END"


@query("synonym_policy_match", f"SELECT id, {_first_phrase_sql()} AS phrase FROM ({ds.DOCUMENT_ACTIVITY})")
def synonym_policy_match(spark, sf_dir):
    rows = ds.document_activity(spark, sf_dir).withColumn("_hay", lexicons.haystack("body"))
    return rows.select("id", lexicons.first_phrase("_hay", _phrases(spark)).alias("phrase"))


@query("synonym_match_joined", f"SELECT id, {_first_phrase_sql(_PADDED, True)} AS phrase FROM ({ds.DOCUMENT_ACTIVITY})")
def synonym_match_joined(spark, sf_dir):
    """The form for lexicons of any size: runs of words joined with the terms."""
    terms = lexicons.expand_synonyms(ds.phrase_lexicon(spark), ds.synonym_table(spark))
    return lexicons.with_first_term(ds.document_activity(spark, sf_dir), terms, (2,)).select("id", "phrase")


_WINDOWS = r"""win AS (SELECT DISTINCT id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))) AS win
    FROM (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents))"""
_FUZZY = f"""sim AS (SELECT win, ordinal, phrase, 100.0::DOUBLE * (1.0::DOUBLE - levenshtein(win, phrase)::DOUBLE / greatest(length(win), length(phrase))) AS score
    FROM (SELECT DISTINCT win FROM win WHERE length(win) BETWEEN 3 AND 11), {ds.sql_values(ds.PHRASES)} AS p(ordinal, phrase, shift)),
    strict AS (SELECT id, arg_min(phrase, ordinal) AS phrase FROM win JOIN sim USING (win) WHERE score > 80 GROUP BY 1),
    loose AS (SELECT id, arg_min(phrase, ordinal) AS phrase FROM win JOIN sim USING (win) WHERE score >= 80 GROUP BY 1)"""


@query(
    "fuzzy_policy_match",
    f"""WITH {_WINDOWS}, {_FUZZY} SELECT d.doc_id AS id, s.phrase AS strict_phrase, l.phrase AS loose_phrase FROM documents d
    LEFT JOIN strict s ON s.id = d.doc_id LEFT JOIN loose l ON l.id = d.doc_id""",
)
def fuzzy_policy_match(spark, sf_dir):
    rows = ds.document_activity(spark, sf_dir)
    rows = lexicons.with_fuzzy_phrase(rows, _phrases(spark), name="strict_phrase", loose_name="loose_phrase")
    return rows.select("id", "strict_phrase", "loose_phrase")


_OPENINGS = r"""openings AS (SELECT item_id AS ordinal, ws[1] || ' ' || ws[2] || ' ' || ws[3] AS phrase
    FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM benchmark) WHERE len(ws) >= 3)"""
_RUNS = r"""w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS ws FROM documents),
    win AS (SELECT DISTINCT id, unnest(list_concat(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]),
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]),
    list_transform(range(1, len(ws) - 2), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]))) AS win FROM w)"""


@query(
    "fuzzy_lexicon_match",
    f"""WITH {_OPENINGS}, {_RUNS}, near AS (SELECT win, ordinal, phrase FROM (SELECT DISTINCT win FROM win) JOIN openings
      ON length(win) BETWEEN length(phrase) * 3 // 4 AND length(phrase) * 5 // 4
      WHERE 100.0::DOUBLE * (1.0::DOUBLE - levenshtein(win, phrase)::DOUBLE / greatest(length(win), length(phrase))) > 80),
    hit AS (SELECT id, arg_min(phrase, (ordinal, phrase)) AS phrase FROM win JOIN near USING (win) GROUP BY 1)
    SELECT d.doc_id AS id, phrase FROM documents d LEFT JOIN hit ON hit.id = d.doc_id""",
)
def fuzzy_lexicon_match(spark, sf_dir):
    """The first benchmark item whose three opening words a run of the document's words resembles; the lexicon is a table."""
    words = F.slice(tokens("text", WORD_PATTERN), 1, 3)
    openings = ds.table(spark, sf_dir, "benchmark").where(F.size(words) == 3).select(F.col("item_id").alias("ordinal"), F.array_join(words, " ").alias("phrase"))
    return lexicons.with_fuzzy_phrase(ds.document_activity(spark, sf_dir), openings).select("id", "phrase")


_PAIRS = r"""pairs AS (SELECT item_id AS ordinal, 'item ' || item_id AS phrase, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS term
    FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{4,}') AS ws FROM benchmark))"""


@query(
    "substring_lexicon_match",
    f"""WITH {_PAIRS}, hit AS (SELECT doc_id AS id, arg_min(phrase, ordinal) AS phrase FROM documents JOIN (SELECT DISTINCT * FROM pairs) ON contains(lower(text), term) GROUP BY 1)
    SELECT d.doc_id AS id, phrase FROM documents d LEFT JOIN hit ON hit.id = d.doc_id""",
)
def substring_lexicon_match(spark, sf_dir):
    """The first benchmark item of which the document holds two long words in a row, as a substring; thousands of terms."""
    runs = ngrams(tokens("text", r"[\p{L}\p{N}_]{4,}"), 2)
    terms = ds.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("ordinal"), F.concat(F.lit("item "), F.col("item_id")).alias("phrase"), F.explode(runs).alias("term"))
    return lexicons.with_first_substring(ds.document_activity(spark, sf_dir), terms).select("id", "phrase")


_CASES = f"""WITH {_WINDOWS}, {_FUZZY}, s AS (SELECT x.*, {_group_sql('lower(body)', False)} IS NOT NULL AS hit,
      coalesce({_first_phrase_sql()}, l.phrase) AS similar_phrase,
      coalesce(p.shift, 0) * CASE WHEN label = 'POSITIVE' THEN 1 ELSE -1 END AS shift
      FROM ({SENTIMENT}) x LEFT JOIN strict f USING (id) LEFT JOIN loose l USING (id)
      LEFT JOIN {ds.sql_values(ds.PHRASES)} AS p(ordinal, phrase, shift) ON p.phrase = f.phrase)
    SELECT id, hit AS politician_mentioned, @EXTRA@round(CASE WHEN hit THEN sentiment ELSE 0 END, 8) AS sentiment,
      round(CASE WHEN hit THEN greatest(-1.0::DOUBLE, least(1.0::DOUBLE, sentiment + shift)) ELSE 0.0 + shift END, 8) AS shifted FROM s"""


@query("policy_shift_cases", _CASES.replace("@EXTRA@", "similar_phrase, "))
def policy_shift_cases(spark, sf_dir):
    phrases = _phrases(spark)
    rows = sentiment.mention_flags(scored_documents(spark, sf_dir), _entities(spark), phrases)
    return sentiment.shift_cases(rows, phrases).select(
        "id", "politician_mentioned", "similar_phrase", F.round("sentiment", 8).alias("sentiment"), F.round("shifted", 8).alias("shifted")
    )


@query("early_exit_scores", _CASES.replace("@EXTRA@", ""))
def early_exit_scores(spark, sf_dir):
    """The same scores with the polarity computed only for rows that hold an entity or a phrase."""
    phrases = _phrases(spark)
    flagged = sentiment.mention_flags(ds.labelled_documents(spark, sf_dir), _entities(spark), phrases)

    def scorer(rows):
        scored = sentiment.lexicon_polarity(rows, ds.valence_lexicon(spark))
        scored = scored.withColumn("sentiment", sentiment.combined_sentiment("polarity", "label"))
        return sentiment.shift_cases(scored, phrases)

    hopeful = F.col("politician_mentioned") | F.col("similar_phrase").isNotNull()
    out = sentiment.score_hopeful(flagged, scorer, hopeful, {"sentiment": F.lit(0.0), "shifted": F.lit(0.0)})
    return out.select("id", "politician_mentioned", F.round("sentiment", 8).alias("sentiment"), F.round("shifted", 8).alias("shifted"))


_PARITY = "(length(body) - length(regexp_replace(body, '[aeiou]', '', 'g'))) % 2 = 0"
_ACTIVITY = f"""act AS (SELECT author, id, subreddit, body FROM ({ds.COMMENTS}) WHERE author <> '[deleted]' UNION ALL
      SELECT author, id, subreddit, title || ' ' || selftext FROM ({ds.SUBMISSIONS}) WHERE author <> '[deleted]'),
    documents AS (SELECT id AS doc_id, body AS text, subreddit AS source, 0 AS n_chars FROM act),
    labels AS (SELECT id AS doc_id, CASE WHEN {_PARITY} THEN 1 ELSE 0 END AS quality FROM act)"""


@query(
    "scored_activity",
    f"""WITH {_ACTIVITY}, r AS ({_CASES.replace("@EXTRA@", "")})
    SELECT r.id, author, act.subreddit, politician_mentioned, sentiment, shifted FROM r JOIN act USING (id)""",
)
def scored_activity(spark, sf_dir):
    """From comments and submissions to scored activity in one plan; labels come from a function, the parity of vowels."""

    def parity():
        return lambda texts: ["POSITIVE" if sum(t.count(v) for v in "aeiou") % 2 == 0 else "NEGATIVE" for t in texts]

    activity = ingest.combine_activity(ds.comments(spark, sf_dir), ds.submissions(spark, sf_dir))
    scored = workflows.score_activity(activity, _entities(spark), _phrases(spark), ds.valence_lexicon(spark), lambda rows: sentiment.udf_label(rows, parity))
    return scored.select("id", "author", "subreddit", "politician_mentioned", F.round("sentiment", 8).alias("sentiment"), F.round("shifted", 8).alias("shifted"))
