import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlens.operators import aggregates, trends
from threadlens.operators import smoothing
from threadlens.operators.smoothing import _smooth, lowess

ELECTION = dt.date(2016, 11, 8)
# Dates of nine public events of 2016 and their weeks before the election, worked out by hand.
DATES = [(2, 1, 40), (3, 1, 36), (4, 22, 28), (6, 12, 21), (8, 31, 9), (9, 26, 6), (10, 7, 4), (10, 19, 2), (11, 8, 0)]
MILESTONES = [(f"e{i + 1}", dt.date(2016, m, d)) for i, (m, d, _) in enumerate(DATES)]
FIRST = {"e1": range(38, 43), "e2": range(34, 38), "e3": range(26, 31), "e4": range(19, 24), "e5": range(7, 12), "e6": range(4, 7),
         "e7": range(2, 4), "e8": range(0, 2), "e9": range(-2, 0)}


def test_milestone_weeks(spark):
    rows = trends.milestone_weeks(spark, ELECTION, MILESTONES[::-1]).orderBy("place").collect()
    assert [r.event_week for r in rows] == [w for *_, w in DATES]


def test_first_matching_milestone(spark):
    m = trends.milestone_weeks(spark, ELECTION, MILESTONES)
    weeks = spark.range(-3, 44).select(F.col("id").alias("week"))
    got = {r.week: r.event for r in trends.label_events(weeks, m, 2).collect()}
    want = {w: e for e, ws in FIRST.items() for w in ws}
    assert got == {w: want.get(w, "No Event") for w in range(-3, 44)}


def test_overlapping_windows_count_a_row_each(spark):
    m = trends.milestone_weeks(spark, ELECTION, MILESTONES)
    rows = spark.createDataFrame([("a", 4)] * 3 + [("b", 20)], "subreddit string, week bigint")
    got = {r.event: (r.total_activity, r.activity_ratio) for r in trends.event_window_metrics(rows, m).collect()}
    assert [e for e, (n, _) in got.items() if n] and {e: n for e, (n, _) in got.items() if n} == {"e6": 3, "e7": 3, "e8": 3, "e4": 1}
    assert got["e6"][1] == pytest.approx(1.5)


def test_milestones_are_broadcast_by_size(spark, plan):
    m = trends.milestone_weeks(spark, ELECTION, MILESTONES)
    assert "BroadcastHashJoin" in plan(trends.label_events(spark.range(10).withColumnRenamed("id", "week"), m))


def test_activity_ratio_is_one(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "subreddit string, week int")
    rows = aggregates.activity_level(df).collect()
    assert {(r.subreddit, r.activity_level, r.activity_ratio) for r in rows} == {("a", 2, 1.0), ("b", 1, 1.0)}


def test_trend_line(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x + 2) for x in range(6)], "week double, post_count double")
    row = trends.linear_trend(df).first()
    assert row.slope == pytest.approx(3) and row.intercept == pytest.approx(2)
    assert all(r.fitted == pytest.approx(r.post_count) for r in trends.fitted_trend(df).collect())


def test_lowess_keeps_a_line_and_resists_an_outlier(spark):
    x = np.arange(40.0)
    assert np.allclose(_smooth(x, 2 * x + 1, 0.2, 3), 2 * x + 1)
    y = 2 * x + 1
    y[20] += 500
    assert abs(_smooth(x, y, 0.5, 3)[20] - 41) < 20
    df = spark.createDataFrame([("a", int(i), 2 * int(i)) for i in range(30)] + [("b", 1, 5)], "subreddit string, week int, post_count int")
    out = lowess(df).collect()
    assert len(out) == 31 and all(r.smoothed == pytest.approx(2 * r.week) for r in out if r.subreddit == "a")


def _plain_lowess(x, y, frac, passes):
    """Every point against all others, one by one."""
    n = len(x)
    k = min(n, max(int(frac * n + 1e-10), 2))
    robust, fit = np.ones(n), y.copy()
    for step in range(passes + 1):
        for i in range(n):
            gap = np.abs(x - x[i])
            w = np.clip(1 - (gap / np.sort(gap)[k - 1]) ** 3, 0, None) ** 3 * robust
            mx, my = w @ x / w.sum(), w @ y / w.sum()
            spread = w @ (x - mx) ** 2
            fit[i] = my + (w @ ((x - mx) * (y - my)) / spread if spread > 1e-12 else 0.0) * (x[i] - mx)
        if step < passes:
            apart = np.abs(y - fit)
            robust = np.clip(1 - ((y - fit) / (6 * np.median(apart))) ** 2, 0, None) ** 2
    return fit


@pytest.mark.parametrize("seed", range(6))
def test_lowess_equals_a_plain_walk(seed, monkeypatch):
    """Uneven places, far from zero, few and many points, windows in several chunks."""
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(smoothing, "CHUNK_CELLS", 500)
    for n in (2, 3, 7, 60, 300):
        x = np.sort(rng.choice(10 * n, n, replace=False)).astype(float) ** (1 + seed % 2) + 1e6 * (seed > 3)
        y = np.cumsum(rng.normal(size=n)) + rng.normal(size=n)
        for frac, passes in ((0.2, 0), (0.5, 2 if n > 10 else 0), (1.0, 1 if n > 10 else 0)):
            assert np.allclose(_smooth(x, y, frac, passes), _plain_lowess(x, y, frac, passes), atol=1e-6)
    assert len(_smooth(np.zeros(0), np.zeros(0), 0.2, 3)) == 0 and np.allclose(_smooth(np.ones(4), np.arange(4.0), 1.0, 0), 1.5)


def test_mode_hour_ties_take_the_smaller_hour(spark):
    rows = [("a", f"2016-01-01 {h:02d}:00:00") for h in (5, 9, 9, 5, 1)] + [("b", None)]
    df = spark.createDataFrame(rows, "author string, t string").withColumn("created_ts", F.to_timestamp("t"))
    assert [tuple(r) for r in aggregates.most_common_hour(df).collect()] == [("a", 5)]


def test_one_pass_author_numbers_equal_the_joined_features(spark):
    rows = [(f"u{i % 5}", "hot" if i % 3 else f"c{i % 2}", f"2016-01-01 {i % 24:02d}:00:00", float(i % 11), (i % 7 - 3) / 3) for i in range(200)]
    df = spark.createDataFrame(rows, "author string, subreddit string, t string, score double, sentiment double").withColumn("created_ts", F.to_timestamp("t"))
    names = ["c0", "c1", "hot"]
    joined = aggregates.merge_features(
        aggregates.sentiment_features(df), aggregates.most_common_hour(df),
        aggregates.pivot_mean(df, "author", "subreddit", "score", names), aggregates.pivot_count(df, "author", "subreddit", names),
    )
    once = aggregates.author_numbers(df, names).na.fill(0.0).select(*joined.columns)
    for a, b in zip(joined.orderBy("author").collect(), once.orderBy("author").collect()):
        assert a[0] == b[0] and list(a[1:]) == pytest.approx(list(b[1:]))
