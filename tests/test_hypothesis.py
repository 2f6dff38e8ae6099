import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.functions import probability as pr
from threadlens.operators import distributions, hypothesis, quantiles


def test_tails_agree_with_commons_math(spark):
    d = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    for a, b, x in [(1, 10, 4.96), (4, 9995, 1.4), (30, 2, 0.7), (2, 60, 25.0)]:
        assert pr.f_tail(x, a, b) == pytest.approx(1 - d.FDistribution(float(a), float(b)).cumulativeProbability(float(x)), abs=1e-9)
    for k, x in [(1, 3.84), (4, 0.5), (12, 60.0), (200, 180.0)]:
        assert pr.chi2_tail(x, k) == pytest.approx(1 - d.ChiSquaredDistribution(float(k)).cumulativeProbability(float(x)), abs=1e-9)
    for df, t in [(1, 12.7), (5.5, -2.0), (4000, 1.96)]:
        assert pr.t_two_sided(t, df) == pytest.approx(2 * d.TDistribution(float(df)).cumulativeProbability(-abs(float(t))), abs=1e-9)


# Published 5% points of the studentized range.
@pytest.mark.parametrize("k,df,q", [(2, 5, 3.64), (3, 10, 3.88), (5, 20, 4.23), (10, 60, 4.65), (4, 3, 6.82), (3, 120, 3.36)])
def test_studentized_range_points(k, df, q):
    assert pr.studentized_range_quantile(0.95, k, df) == pytest.approx(q, abs=0.011)


def _skewed(spark):
    """One group with two thirds of the rows, heavy repeats, outliers, negatives and gaps."""
    rng = random.Random(3)
    rows = [("hot", rng.choice([0.5, 1.5, rng.gauss(0, 3)])) for _ in range(900)] + [("hot", 1e9), ("hot", -1e9)]
    rows += [(f"g{i % 4}", rng.expovariate(0.1)) for i in range(400)] + [("one", 7.0), ("flat", 2.0), ("flat", 2.0), ("hot", None), (None, 3.0)]
    return rows, spark.createDataFrame(rows, "subreddit string, x double")


@pytest.mark.parametrize("rounds,bins", [(None, 2048), (0, 4), (1, 8), (2, 2048)])
def test_quantiles_match_sorting(spark, rounds, bins):
    rows, df = _skewed(spark)
    probs = [0.0, 0.25, 0.5, 0.75, 0.97, 1.0]
    got = {(r.subreddit, r.prob): r.quantile for r in quantiles.exact_quantiles(df, "subreddit", "x", probs, rounds, bins).collect()}
    groups = {}
    for g, x in rows:
        if g is not None and x is not None:
            groups.setdefault(g, []).append(x)
    want = {(g, p): float(np.quantile(v, p)) for g, v in groups.items() for p in probs}
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    row = distributions.box_stats(spark.createDataFrame([("a", v) for v in values], "g string, x double"), "g", "x").first()
    assert (row.q1, row.median, row.q3, row.whisker_low, row.whisker_high, row.outliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_anova_levene_welch_by_hand(spark):
    a, b, c = ([float(v) for v in vs] for vs in ((6, 8, 4, 5, 3, 4), (8, 12, 9, 11, 6, 8), (13, 9, 11, 8, 7, 12)))
    df = spark.createDataFrame([(g, v) for g, vs in zip("abc", (a, b, c)) for v in vs], "g string, x double")
    row = hypothesis.anova(df, "g", "x").first()
    assert (row.f_stat, row.df_between, row.df_within) == (pytest.approx(9.3, abs=0.05), 2, 15)
    assert row.p_value == pytest.approx(0.0024, abs=2e-4)
    dev = {g: [abs(v - statistics.median(vs)) for v in vs] for g, vs in zip("abc", (a, b, c))}
    grand = statistics.mean(v for vs in dev.values() for v in vs)
    between = sum(6 * (statistics.mean(vs) - grand) ** 2 for vs in dev.values()) / 2
    within = sum((v - statistics.mean(vs)) ** 2 for vs in dev.values() for v in vs) / 15
    assert hypothesis.levene(df, "g", "x").first().w_stat == pytest.approx(between / within)
    w = hypothesis.welch(df, "g", "x", "a", "b").first()
    se = statistics.variance(a) / 6 + statistics.variance(b) / 6
    assert w.t_stat == pytest.approx((5 - 9) / math.sqrt(se)) and 0 < w.p_value < 0.01


def test_tukey_pairs(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(g, rng.gauss(m, 1)) for g, m in (("a", 0), ("b", 0), ("c", 5)) for _ in range(30)], "g string, x double")
    out = {(r.group1, r.group2): r for r in hypothesis.tukey_hsd(df, "g", "x").collect()}
    assert set(out) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert out["a", "c"].reject and out["b", "c"].reject and out["a", "c"].p_adj < 1e-6
    for r in out.values():
        assert r.lower < r.meandiff < r.upper and (r.lower > 0 or r.upper < 0) == r.reject and 0 <= r.p_adj <= 1


def test_chi_squared_with_an_empty_cell_and_correction(spark):
    cells = [("x", "p", 10), ("x", "q", 20), ("y", "p", 30), ("y", "r", 5)]
    df = spark.createDataFrame([(a, b) for a, b, n in cells for _ in range(n)], "a string, b string")
    row = hypothesis.chi_squared(df, "a", "b").first()
    n, r, c = 65, {"x": 30, "y": 35}, {"p": 40, "q": 20, "r": 5}
    seen = {(a, b): k for a, b, k in cells}
    want = sum((seen.get((i, j), 0) - r[i] * c[j] / n) ** 2 / (r[i] * c[j] / n) for i in r for j in c)
    assert row.dof == 2 and row.chi2_stat == pytest.approx(want) and row.p_value == pytest.approx(math.exp(-want / 2))
    two = hypothesis.chi_squared(df.where("b <> 'r'"), "a", "b").first()
    e = {(i, j): {"x": 30, "y": 30}[i] * {"p": 40, "q": 20}[j] / 60 for i in "xy" for j in "pq"}
    assert two.chi2_stat == pytest.approx(sum((abs(seen.get(k, 0) - v) - 0.5) ** 2 / v for k, v in e.items()))


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4)], "x double")
    assert [r.n for r in distributions.histogram(df, "x", 4).orderBy("bin").collect()] == [1, 1, 1, 2]
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.n for r in distributions.histogram(flat, "x", 2).orderBy("bin").collect()] == [2, 0]


def test_density_integrates_to_one(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([("a", rng.gauss(0, 1)) for _ in range(300)], "g string, x double")
    pts = distributions.density(df, "g", "x", cut=4.0).orderBy("point").collect()
    area = sum((b.x - a.x) * (a.density + b.density) / 2 for a, b in zip(pts, pts[1:]))
    assert len(pts) == 100 and area == pytest.approx(1.0, abs=0.01)


def test_quantiles_end_on_values_of_three_scales(spark):
    part = F.when(F.col("id") % 3 == 0, F.col("id") * 1e9).when(F.col("id") % 3 == 1, F.col("id") * 10.0).otherwise(F.col("id") / 60_000)
    df = spark.range(60_000).select(F.lit("all").alias("g"), part.alias("x"))
    values = np.array([r.x for r in df.select("x").collect()])
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.prob: r.quantile for r in quantiles.exact_quantiles(df, "g", "x", probs).collect()}
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in probs})


def test_chi_squared_visits_observed_cells_only(spark):
    cells = [("a", "x", 8), ("a", "y", 2), ("b", "y", 5), ("b", "z", 7), ("c", "x", 1)]
    df = spark.createDataFrame([(r, c) for r, c, n in cells for _ in range(n)], "r string, c string")
    grid = np.array([[8, 2, 0], [0, 5, 7], [1, 0, 0]], float)
    expected = grid.sum(1, keepdims=True) * grid.sum(0) / grid.sum()
    row = hypothesis.chi_squared(df, "r", "c", p_value=False).first()
    assert (row.chi2_stat, row.dof) == (pytest.approx(((grid - expected) ** 2 / expected).sum()), 4)
    assert hypothesis.expected_counts(df, "r", "c").count() == 9


def test_chi_squared_corrects_two_by_two_with_an_empty_cell(spark):
    df = spark.createDataFrame([("a", "x")] * 6 + [("b", "x")] * 2 + [("b", "y")] * 4, "r string, c string")
    grid = np.array([[6, 0], [2, 4]], float)
    expected = grid.sum(1, keepdims=True) * grid.sum(0) / grid.sum()
    row = hypothesis.chi_squared(df, "r", "c", p_value=False).first()
    assert (row.chi2_stat, row.dof) == (pytest.approx(((abs(grid - expected) - 0.5) ** 2 / expected).sum()), 1)


@pytest.mark.parametrize("k", [2, 5, 12])
def test_studentized_range_has_no_step(k):
    """One formula for all degrees of freedom: it nears the range of normals as 1/df, also far beyond any table."""
    limit = 1.0 - pr._range_cdf(np.array([3.3]), k)[0]
    gaps = [pr.studentized_range_tail(3.3, k, df) - limit for df in (1e2, 1e3, 24_999, 25_001, 1e6, 1e9, 1e12)]
    assert all(a > b > -1e-9 for a, b in zip(gaps, gaps[1:-1])) and abs(gaps[-1]) < 1e-8
    assert gaps[2] * 24_999 == pytest.approx(gaps[3] * 25_001, rel=1e-4) == pytest.approx(gaps[4] * 1e6, rel=1e-2)
    for df in (1.0, 3.0, 5.0, 99.0, 101.0):
        assert pr._gamma_front(df / 2) == pytest.approx(math.lgamma(df / 2) - df / 2 * math.log(df / 2) + df / 2, abs=1e-12)
