"""Queries for hypothesis tests and distribution summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadlens.functions import buckets
from threadlens.operators import distributions, hypothesis, quantiles
from threadlens.plans import datasets as ds
from threadlens.plans.registry import query
from threadlens.plans.relational_queries import CENTRED, _CATEGORY


def _scores(spark, sf_dir):
    return ds.scored_events(spark, sf_dir)


def _rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _categories(spark, sf_dir):
    rows = _scores(spark, sf_dir)
    return rows.select(
        buckets.sentiment_category("sentiment").alias("sentiment_category"),
        buckets.score_category(F.col("score") - 50).alias("score_category"), "subreddit",
    )


_CELLS = f"""c AS (SELECT CASE WHEN shifted >= 0 THEN 'positive' ELSE 'negative' END AS a, subreddit AS b FROM ({ds.SCORED_EVENTS})),
    o AS (SELECT a, b, count(*) AS n FROM c GROUP BY ALL), r AS (SELECT a, count(*) AS n FROM c GROUP BY 1), k AS (SELECT b, count(*) AS n FROM c GROUP BY 1),
    e AS (SELECT r.a, k.b, coalesce(o.n, 0) AS observed, r.n * k.n / (SELECT count(*) FROM c)::DOUBLE AS expected
      FROM r CROSS JOIN k LEFT JOIN o ON o.a = r.a AND o.b = k.b)"""


def _by_community(spark, sf_dir):
    return _scores(spark, sf_dir).withColumn("a", buckets.sentiment_category("shifted")).withColumnRenamed("subreddit", "b")


@query("expected_counts", f"WITH {_CELLS} SELECT a, b, observed, round(expected, 6) AS expected FROM e")
def expected_counts(spark, sf_dir):
    return _rounded(hypothesis.expected_counts(_by_community(spark, sf_dir), "a", "b"))


@query(
    "chi2_stat",
    f"""WITH {_CELLS} SELECT round(sum((observed - expected) ** 2 / expected), 6) AS chi2_stat,
    (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM e""",
)
def chi2_stat(spark, sf_dir):
    return _rounded(hypothesis.chi_squared(_by_community(spark, sf_dir), "a", "b", p_value=False))


_SQUARE = f"""c AS (SELECT CASE WHEN sentiment >= 0 THEN 'positive' ELSE 'negative' END AS a, {_CATEGORY.format(x='score')} IN ('very_positive', 'neutral') AS b
    FROM ({CENTRED}) WHERE subreddit IN ('click', 'view')), o AS (SELECT a, b, count(*) AS n FROM c GROUP BY ALL),
    r AS (SELECT a, count(*) AS n FROM c GROUP BY 1), k AS (SELECT b, count(*) AS n FROM c GROUP BY 1),
    e AS (SELECT coalesce(o.n, 0) AS observed, r.n * k.n / (SELECT count(*) FROM c)::DOUBLE AS expected
      FROM r CROSS JOIN k LEFT JOIN o ON o.a = r.a AND o.b = k.b)"""


@query(
    "chi2_corrected",
    f"""WITH {_SQUARE} SELECT round(sum((abs(observed - expected) - least(0.5::DOUBLE, abs(observed - expected))) ** 2 / expected), 6) AS chi2_stat,
    1::BIGINT AS dof FROM e""",
)
def chi2_corrected(spark, sf_dir):
    """A two-by-two table, where the continuity correction applies."""
    rows = _categories(spark, sf_dir).where(F.col("subreddit").isin("click", "view"))
    rows = rows.select(F.col("sentiment_category").alias("a"), F.col("score_category").isin("very_positive", "neutral").alias("b"))
    return _rounded(hypothesis.chi_squared(rows, "a", "b", p_value=False))


_PLAIN = _CELLS.replace("shifted >= 0", "sentiment >= 0")


def _plain_signs(spark, sf_dir):
    """Sign of the unshifted sentiment by community."""
    return _scores(spark, sf_dir).withColumn("a", buckets.sentiment_category("sentiment")).withColumnRenamed("subreddit", "b")


@query(
    "chi2_p",
    f"""WITH {_PLAIN}, x AS (SELECT sum((observed - expected) ** 2 / expected) AS chi2_stat,
    (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM e)
    SELECT round(chi2_stat, 6) AS chi2_stat, dof, round(exp(-chi2_stat / 2) * (1 + chi2_stat / 2), 9) AS p_value FROM x""",
)
def chi2_p(spark, sf_dir):
    """Two by five classes: four degrees of freedom, for which the tail has a closed form."""
    out = hypothesis.chi_squared(_plain_signs(spark, sf_dir), "a", "b")
    return out.select(F.round("chi2_stat", 6).alias("chi2_stat"), "dof", F.round("p_value", 9).alias("p_value"))


def _anova_sql(rows: str, stat: str, p_value: str = "") -> str:
    """Plain two-pass form over the rows g, x; `p_value` is a further column over f and dfw."""
    return f"""d AS ({rows}), m AS (SELECT g, avg(x) AS gm, count(*) AS n FROM d GROUP BY 1), t AS (SELECT avg(x) AS grand FROM d),
    b AS (SELECT sum(n * (gm - grand) ** 2) AS ssb, count(*) - 1 AS dfb FROM m, t),
    w AS (SELECT sum((x - gm) ** 2) AS ssw, count(*) - (SELECT count(*) FROM m) AS dfw FROM d JOIN m USING (g))
    SELECT round(f, 6) AS {stat}, dfb AS df_between, dfw AS df_within{p_value} FROM (SELECT *, (ssb / dfb) / (ssw / dfw) AS f FROM b, w)"""


#: Tail of the F distribution with four degrees of freedom above, so for five groups.
_TAIL4 = """, round(pow(dfw / (dfw + 4 * f), dfw / 2::DOUBLE) * (1 + dfw / 2::DOUBLE * (1 - dfw / (dfw + 4 * f))), 8) AS p_value"""


_SHIFTS = f"SELECT subreddit AS g, shifted AS x FROM ({ds.SCORED_EVENTS})"


@query("anova_f", f"WITH {_anova_sql(_SHIFTS, 'f_stat')}")
def anova_f(spark, sf_dir):
    return _rounded(hypothesis.anova(_scores(spark, sf_dir), "subreddit", "shifted", p_value=False))


@query("anova_p", f"WITH {_anova_sql(_SHIFTS.replace('shifted', 'score'), 'f_stat', _TAIL4)}")
def anova_p(spark, sf_dir):
    out = hypothesis.anova(_scores(spark, sf_dir), "subreddit", "score")
    return out.withColumns({"f_stat": F.round("f_stat", 6), "p_value": F.round("p_value", 8)})


@query(
    "tukey_pairs",
    f"""WITH d AS ({_SHIFTS}), m AS (SELECT g, avg(x) AS gm, count(*) AS n FROM d GROUP BY 1),
    w AS (SELECT sum((x - gm) ** 2) / (count(*) - (SELECT count(*) FROM m)) AS mse FROM d JOIN m USING (g))
    SELECT a.g AS group1, b.g AS group2, round(b.gm - a.gm, 8) AS meandiff,
      round(abs(b.gm - a.gm) / sqrt(mse / 2 * (1 / a.n + 1 / b.n)), 6) AS q_stat FROM m a JOIN m b ON a.g < b.g, w""",
)
def tukey_pairs(spark, sf_dir):
    out = hypothesis.tukey_hsd(_scores(spark, sf_dir), "subreddit", "shifted", p_value=False)
    return out.select("group1", "group2", F.round("meandiff", 8).alias("meandiff"), F.round("q_stat", 6).alias("q_stat"))


@query("tukey_p")
def tukey_p(spark, sf_dir):
    return hypothesis.tukey_hsd(_scores(spark, sf_dir), "subreddit", "score")


def _tukey_p_sql() -> str:
    """The studentized range by Simpson's rule over the normal density (steps of 0.01) and over the scale (60 steps)."""
    phi = lambda x: f"exp(-({x}) * ({x}) / 2) / sqrt(2 * pi())"
    simpson = lambda i, last: f"CASE WHEN {i} IN (0, {last}) THEN 1 WHEN {i} % 2 = 1 THEN 4 ELSE 2 END"
    taylor = "c.cdf + c.phi * u - c.z * c.phi * u * u / 2 + (c.z * c.z - 1) * c.phi * u * u * u / 6"
    return f"""WITH d AS (SELECT subreddit AS g, score AS x FROM ({ds.SCORED_EVENTS}) WHERE score IS NOT NULL AND subreddit IS NOT NULL),
    m AS (SELECT g, avg(x) AS gm, count(*) AS n FROM d GROUP BY 1),
    e AS (SELECT sum((x - gm) ** 2) AS ss, count(*) - (SELECT count(*) FROM m) AS dof, (SELECT count(*) FROM m) AS k FROM d JOIN m USING (g)),
    pairs AS (SELECT a.g AS group1, b.g AS group2, abs(b.gm - a.gm) / sqrt(ss / dof / 2 * (1 / a.n + 1 / b.n)) AS q, dof, k FROM m a JOIN m b ON a.g < b.g, e),
    z AS (SELECT i, z, {phi('z')} AS phi, coalesce(sum(0.01 / 6 * ({phi('z')} + 4 * {phi('z + 0.005')} + {phi('z + 0.01')}))
      OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cdf FROM (SELECT i, -8.5 + i * 0.01::DOUBLE AS z FROM range(0, 1701) AS r(i))),
    s AS (SELECT j, 1 + t AS s, h / 30 / 3 * ({simpson('j', 60)}) * exp(ln(2) + dof / 2 * ln(dof / 2) - lgamma(dof / 2) + (dof - 1) * ln(1 + t) - dof * (1 + t) * (1 + t) / 2) AS w
      FROM (SELECT j, h, h * (j / 30.0::DOUBLE - 1) AS t, dof::DOUBLE AS dof FROM range(0, 61) AS r(j), (SELECT 9 / sqrt(2.0::DOUBLE * dof) AS h, dof FROM e))),
    cells AS (SELECT group1, group2, k, w, z.i, z.phi, z.cdf, z.z - q * s AS x, CAST(floor((z.z - q * s + 8.5) / 0.01) AS BIGINT) AS at FROM pairs, s, z),
    inner_ AS (SELECT group1, group2, k, w, 0.01 / 3 * ({simpson('cells.i', 1700)}) * cells.phi * pow(cells.cdf - CASE WHEN x <= -8.5 THEN 0 ELSE {taylor.replace('u', '(x - c.z)')} END, k - 1) AS part
      FROM cells LEFT JOIN z c ON c.i = cells.at)
    SELECT group1, group2, round(greatest(0, least(1, 1 - any_value(k) * sum(w * part))), 4) AS p_adj FROM inner_ GROUP BY ALL"""


@query("tukey_p_adj", _tukey_p_sql())
def tukey_p_adj(spark, sf_dir):
    out = hypothesis.tukey_hsd(_scores(spark, sf_dir), "subreddit", "score")
    return out.select("group1", "group2", F.round("p_adj", 4).alias("p_adj"))


_SIDES = "subreddit IN ('click', 'purchase')"
_GAPS = f"""SELECT g, abs(x - median(x) OVER (PARTITION BY g)) AS x FROM (SELECT subreddit AS g, score AS x FROM ({ds.SCORED_EVENTS}))"""


@query("levene_w", f"WITH {_anova_sql(_GAPS, 'w_stat')}")
def levene_w(spark, sf_dir):
    return _rounded(hypothesis.levene(_scores(spark, sf_dir), "subreddit", "score", p_value=False))


@query("levene_p", f"WITH {_anova_sql(_GAPS, 'w_stat', _TAIL4)}")
def levene_p(spark, sf_dir):
    out = hypothesis.levene(_scores(spark, sf_dir), "subreddit", "score")
    return out.withColumns({"w_stat": F.round("w_stat", 6), "p_value": F.round("p_value", 8)})


@query(
    "welch_t",
    f"""WITH s AS (SELECT subreddit AS g, avg(score) AS m, var_samp(score) / count(*) AS v, count(*) AS n FROM ({ds.SCORED_EVENTS})
    WHERE {_SIDES} GROUP BY 1) SELECT round((a.m - b.m) / sqrt(a.v + b.v), 6) AS t_stat,
    round((a.v + b.v) ** 2 / (a.v ** 2 / (a.n - 1) + b.v ** 2 / (b.n - 1)), 4) AS dof FROM s a, s b WHERE a.g = 'click' AND b.g = 'purchase'""",
)
def welch_t(spark, sf_dir):
    out = hypothesis.welch(_scores(spark, sf_dir), "subreddit", "score", "click", "purchase", p_value=False)
    return out.select(F.round("t_stat", 6).alias("t_stat"), F.round("dof", 4).alias("dof"))


@query(
    "welch_p",
    f"""WITH s AS (SELECT subreddit AS g, avg(score) AS m, var_samp(score) / count(*) AS v, count(*) AS n FROM ({ds.SCORED_EVENTS})
    WHERE {_SIDES} GROUP BY 1), w AS (SELECT (a.m - b.m) / sqrt(a.v + b.v) AS t,
      (a.v + b.v) ** 2 / (a.v ** 2 / (a.n - 1) + b.v ** 2 / (b.n - 1)) AS d FROM s a, s b WHERE a.g = 'click' AND b.g = 'purchase'),
    i AS (SELECT t, d, k, exp(lgamma((d + 1) / 2) - lgamma(d / 2)) / sqrt(d * pi()) * pow(1 + (abs(t) * k / 2000) ** 2 / d, 0 - (d + 1) / 2) AS y
      FROM w, range(0, 2001) AS r(k))
    SELECT round(t, 6) AS t_stat, round(d, 4) AS dof,
      round(1 - 2 * abs(t) / 6000 * sum(y * CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END), 8) AS p_value FROM i GROUP BY t, d""",
)
def welch_p(spark, sf_dir):
    """The twin integrates the density by Simpson's rule."""
    out = hypothesis.welch(_scores(spark, sf_dir), "subreddit", "score", "click", "purchase")
    return out.select(F.round("t_stat", 6).alias("t_stat"), F.round("dof", 4).alias("dof"), F.round("p_value", 8).alias("p_value"))


# --- distributions -----------------------------------------------------------------------------------------------------


@query(
    "group_quantiles",
    f"""SELECT subreddit, prob, round(CASE prob WHEN 0.1::DOUBLE THEN a WHEN 0.5::DOUBLE THEN b ELSE c END, 6) AS quantile FROM
    (SELECT subreddit, quantile_cont(score, 0.1) AS a, quantile_cont(score, 0.5) AS b, quantile_cont(score, 0.99) AS c
     FROM ({ds.SCORED_EVENTS}) GROUP BY 1), (SELECT unnest([0.1::DOUBLE, 0.5::DOUBLE, 0.99::DOUBLE]) AS prob)""",
)
def group_quantiles(spark, sf_dir):
    out = quantiles.exact_quantiles(_scores(spark, sf_dir), "subreddit", "score", [0.1, 0.5, 0.99])
    return out.withColumn("quantile", F.round("quantile", 6))


@query(
    "box_stats",
    f"""WITH e AS ({ds.SCORED_EVENTS}), b AS (SELECT subreddit, quantile_cont(shifted, 0.25) AS q1, quantile_cont(shifted, 0.5) AS med,
      quantile_cont(shifted, 0.75) AS q3 FROM e GROUP BY 1)
    SELECT subreddit, round(q1, 8) AS q1, round(med, 8) AS median, round(q3, 8) AS q3,
      min(shifted) FILTER (shifted BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_low,
      max(shifted) FILTER (shifted BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_high,
      count(*) FILTER (NOT shifted BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS outliers
    FROM e JOIN b USING (subreddit) GROUP BY subreddit, q1, med, q3""",
)
def box_stats(spark, sf_dir):
    out = distributions.box_stats(_scores(spark, sf_dir), "subreddit", "shifted")
    return out.withColumns({c: F.round(c, 8) for c in ("q1", "median", "q3")})


def _histogram_sql(x: str, bins: int) -> str:
    return f"""WITH e AS (SELECT {x} AS x FROM ({ds.SCORED_EVENTS})), r AS (SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM e),
    c AS (SELECT least({bins}, CAST(floor({bins} * (x - lo) / (hi - lo)) AS INT) + 1) AS bin, count(*) AS n FROM e, r GROUP BY 1)
    SELECT CAST(i AS INT) AS bin, round(lo + (hi - lo) * (i - 1) / {bins}, 8) AS low, coalesce(n, 0) AS n
    FROM r, range(1, {bins + 1}) AS s(i) LEFT JOIN c ON c.bin = s.i"""


@query("histogram", _histogram_sql("score", 20))
def histogram(spark, sf_dir):
    out = distributions.histogram(_scores(spark, sf_dir), "score", 20)
    return out.withColumn("low", F.round("low", 8))


_CODE = "CASE WHEN score < 40 THEN 1 WHEN score < 50 THEN 2 WHEN score = 50 THEN 3 WHEN score <= 60 THEN 4 ELSE 5 END"


@query("histogram_categories", _histogram_sql(_CODE, 5))
def histogram_categories(spark, sf_dir):
    rows = _scores(spark, sf_dir).withColumn("code", buckets.score_code(F.col("score") - 50))
    return distributions.histogram(rows, "code", 5).withColumn("low", F.round("low", 8))


@query(
    "group_histogram",
    f"""WITH e AS ({ds.SCORED_EVENTS}), r AS (SELECT min(shifted) AS lo, max(shifted) AS hi FROM e)
    SELECT subreddit, least(25, CAST(floor(25 * (shifted - lo) / (hi - lo)) AS INT) + 1) AS bin, count(*) AS n FROM e, r GROUP BY ALL""",
)
def group_histogram(spark, sf_dir):
    return distributions.group_histogram(_scores(spark, sf_dir), "subreddit", "shifted", 25)


@query(
    "density",
    f"""WITH e AS ({ds.SCORED_EVENTS}), s AS (SELECT subreddit, count(*) AS n, stddev_samp(sentiment) * count(*) ** (-0.2) AS h,
      min(sentiment) AS a, max(sentiment) AS b FROM e GROUP BY 1),
    g AS (SELECT subreddit, n, h, i AS point, a - h * 2 + ((b + h * 2) - (a - h * 2)) * i / 99 AS x FROM s, range(0, 100) AS r(i))
    SELECT subreddit, CAST(point AS INT) AS point, round(x, 6) AS x,
      round(sum(exp(-0.5::DOUBLE * ((x - sentiment) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
    FROM g JOIN e USING (subreddit) GROUP BY subreddit, point, x""",
)
def density(spark, sf_dir):
    return _rounded(distributions.density(_scores(spark, sf_dir), "subreddit", "sentiment"))
