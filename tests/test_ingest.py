import json

import pytest
from pyspark.sql import functions as F

from threadlens import schemas
from threadlens.operators import filters, ingest, ranking, sampling
from threadlens.plans import workflows
from threadlens.sources import read_csv, read_parquet, read_two_row_csv, write_csv, write_parquet, write_two_row_csv
from threadlens.sources.writers import header_pairs


def test_removal_marker_and_missing_text(spark):
    rows = spark.createDataFrame([(1, "x [deleted] y"), (2, None), (3, "deleted"), (4, "[removed]")], "id int, body string")
    assert [r.id for r in ingest.drop_removed(rows).collect()] == [3]
    assert ingest.drop_removed(rows.drop("body")).count() == 4


def _skewed(spark, n=9000):
    """A third of the rows in one community, the rest spread over thirty."""
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 30).cast("string"))).alias("subreddit")
    )


def test_cap_is_exact_repeatable_and_independent_of_partitioning(spark):
    df = _skewed(spark)
    first = ingest.stratified_cap(df, 50).collect()
    again = ingest.stratified_cap(df.repartition(13), 50).collect()
    assert sorted(first) == sorted(again)
    sizes = {}
    for r in first:
        sizes[r.subreddit] = sizes.get(r.subreddit, 0) + 1
    assert set(sizes.values()) == {50} and len(sizes) == df.select("subreddit").distinct().count()


def test_cap_limits_before_the_shuffle(spark, plan):
    text = plan(ingest.stratified_cap(_skewed(spark), 2000))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_top_per_group_matches_a_full_sort(spark):
    df = _skewed(spark, 3000).withColumn("w", F.pmod(F.xxhash64("id"), F.lit(97)))
    got = sorted((r.subreddit, r.id) for r in ranking.top_per_group(df, ["subreddit"], [F.desc("w"), F.col("id")], 7, slices=3).collect())
    rows = {}
    for r in df.collect():
        rows.setdefault(r.subreddit, []).append((-r.w, r.id))
    assert got == sorted((g, i) for g, v in rows.items() for _, i in sorted(v)[:7])


def test_exact_sample_and_small_pool(spark):
    df = spark.range(5000)
    got = {r.id for r in sampling.exact_sample(df, 777, seed=3).collect()}
    by_hash = [r.id for r in df.orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit("|3"))), F.col("id").cast("string")).limit(777).collect()]
    assert got == set(by_hash)
    with pytest.raises(Exception, match="larger than its pool"):
        sampling.exact_sample(df, 5001).count()
    assert sampling.exact_sample(df, 5000).count() == 5000


def test_rebalance_keeps_changed_rows(spark):
    rows = [(i, 0.5, 0.5 if i < 60 else 0.1) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, sentiment double, shifted double")
    out = sampling.rebalance(df).collect()
    assert len(out) == 70 and sum(r.id < 60 for r in out) == 30
    with pytest.raises(Exception, match="larger than its pool"):
        sampling.rebalance(df.where("id >= 40"), share=0.9).count()


def test_exact_sample_with_repeated_and_missing_keys(spark):
    """Ties on the edge give exactly n rows, whatever n is."""
    df = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(200)], "id int, x int")
    for n in (0, 1, 39, 40, 41, 57, 199, 200):
        assert sampling.exact_sample(df, n).count() == n
    assert sampling.exact_sample(df.limit(0), 0).count() == 0
    with pytest.raises(Exception, match="larger than its pool"):
        sampling.exact_sample(spark.range(9).where("id > 10"), 1).count()


def test_half_sample_keeps_rows_without_a_score(spark):
    df = spark.createDataFrame([(1, None, None), (2, 0.5, None), (3, 0.1, 0.2)], "id int, sentiment double, shifted double")
    assert sampling.keep_share_of_unchanged(df).count() == 3


def test_group_size_boundary(spark):
    df = spark.createDataFrame([("a",)] * 40 + [("b",)] * 41 + [(None,)] * 50, "subreddit string")
    assert {r.subreddit for r in filters.large_groups(df).collect()} == {"b"}


def test_head_and_rest(spark):
    head, rest = ranking.head_and_rest(spark.range(30), "id", 10)
    assert {r.id for r in head.collect()} == set(range(10)) and rest.count() == 20


def test_long_texts_and_mentions(spark):
    df = spark.createDataFrame([(1, "w " * 512), (2, "w " * 513), (3, None), (4, "Big TRUMPET")], "id int, body string")
    assert {r.id for r in filters.drop_long_texts(df).collect()} == {1, 4}
    assert {r.id for r in filters.mentions_any(df, ["trump"]).collect()} == {4}


def test_strong_scores_strictness(spark):
    df = spark.createDataFrame([(1, 0.2, True), (2, -0.5, False), (3, 0.1, True), (4, None, True)], "id int, s double, f boolean")
    assert [r.id for r in filters.strong_scores(df, "s", 0.2, flag="f").collect()] == [1]
    assert [r.id for r in filters.strong_scores(df, "s", 0.2, strict=True).collect()] == [2]


def test_extraction_end_to_end(spark, tmp_path):
    comments = [
        {"author": f"u{i % 7}", "id": f"c{i}", "body": "hello" if i % 5 else "[removed]", "subreddit": "politics" if i % 2 else "cats",
         "subreddit_id": "t5", "year": 2016 if i % 3 else 2015, "month": 1, "created_utc": "1478563200", "score": i}
        for i in range(300)
    ]
    posts = [
        {"author": "[deleted]" if i % 4 == 0 else "p", "id": f"s{i}", "title": "t", "selftext": "body", "subreddit": "Law", "subreddit_id": "t6",
         "year": 2016, "month": 2, "created_utc": "1478563201", "score": 1}
        for i in range(20)
    ]
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, comments)))
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, posts)))
    out = str(tmp_path / "activity")
    workflows.extract_activity(spark, str(tmp_path / "s.json"), str(tmp_path / "c.json"), out, cap=40)
    got = read_parquet(spark, out)
    assert set(got.columns) == set(schemas.ACTIVITY.names)
    assert got.where("subreddit = 'politics'").count() == 40
    law = got.where("subreddit = 'Law'").collect()
    assert len(law) == 15 and {r.body for r in law} == {"t body"}


def test_union_equals_the_semi_join_form(spark):
    comments = spark.createDataFrame([("a", "1", "x"), ("[deleted]", "2", "y"), (None, "3", "z")], "author string, id string, body string")
    posts = spark.createDataFrame([("b", "4", "t", "s"), ("[deleted]", "5", "t", "s")], "author string, id string, title string, selftext string")
    authors = ingest.distinct_authors(comments, posts)
    by_join = ingest.keep_authors(comments, authors).unionByName(ingest.refine_submissions(ingest.keep_authors(posts, authors)))
    assert sorted(r.id for r in ingest.combine_activity(comments, posts).collect()) == sorted(r.id for r in by_join.collect()) == ["1", "4"]


def test_csv_keeps_newlines_quotes_and_commas(spark, tmp_path):
    rows = [("a", 'say "hi",\nthere'), ("b", " padded "), ("c", None)]
    df = spark.createDataFrame(rows, "author string, body string")
    write_csv(df, str(tmp_path / "t"))
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "t"), df.schema).collect())) == sorted(rows)


def test_nan_becomes_null_at_the_source(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "id int, x double")
    write_parquet(df, str(tmp_path / "p"))
    assert {r.id: r.x for r in read_parquet(spark, str(tmp_path / "p")).collect()} == {1: None, 2: 1.5}


def test_pushdown_reaches_the_scan(spark, plan):
    from threadlens.plans import datasets as ds

    rows = ds.event_activity(spark, "/root/testdata/sf0.001").where("subreddit = 'click'").select("id", "score")
    text = plan(rows)
    assert "EqualTo(event_type,click)" in text and "props" not in text.split("ReadSchema")[1]


def test_two_header_rows_round_trip(spark, tmp_path):
    """A file in the published shape, and odd names and values over several files."""
    (tmp_path / "given.csv").write_text("political_leaning,score,score,score\n,mean,sum,max\nDemocratic,138.5,85424.25,29182.0\nNeutral,48.25,,10657.0\n")
    given = read_two_row_csv(spark, str(tmp_path / "given.csv"))
    assert given.schema.simpleString() == "struct<political_leaning:string,score:struct<mean:double,sum:double,max:double>>"
    assert [(r.political_leaning, *r.score) for r in given.collect()] == [("Democratic", 138.5, 85424.25, 29182.0), ("Neutral", 48.25, None, 10657.0)]
    rows = [("a,b", (1.5, 2), 3.0), (' said "x"\nand y ', (None, 7), None), (None, (0.0, None), 1.0), ("name", (9.0, 1), 2.0)] * 5
    df = spark.createDataFrame(rows, "`key, one` string, m struct<x:double,`n 2`:int>, z double").repartition(3)
    assert header_pairs(df) == [("key, one", ""), ("m", "x"), ("m", "n 2"), ("z", "")]
    write_two_row_csv(df, str(tmp_path / "out"))
    back = read_two_row_csv(spark, str(tmp_path / "out"), {"m.n 2": "int", "z": "double"})
    assert back.dtypes == df.dtypes and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_csv_without_line_ends_in_fields_is_split(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "concat('a, ', id) AS x")
    write_csv(df, str(tmp_path / "t"), files=1)
    back = read_csv(spark, str(tmp_path / "t"), df.schema, multi_line=False)
    assert sorted(back.collect()) == sorted(df.collect())
