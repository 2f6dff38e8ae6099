"""One query for each operator, with production parameters over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import bpe, centroids, fingerprints, hard_negatives, html_text, license_notices, line_templates, near_dups, packing, quality, secret_scan, toxicity, url_rules
from threadlens.llm.common import table

#: verdict, host, path
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_dropped")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_classes(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("compared")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(vectors.withColumn("label", noisy))


def op13_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices.scan_licenses(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_line_dedup, op3_url_filters, op4_best_fit_packing, op5_toxicity, op6_bpe, op7_fingerprints, op8_html_text, op9_quality_rules, op10_near_dedup,
        op11_centroids, op12_hard_negatives, op13_license_notices,
    )
}



def _clustering_sql(clusters: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Brute-force clustering: one step of nearest centroids and one of means for each round."""
    steps = [f"""points AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS point FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""", f"""
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), point) - 1 AS cluster, point AS centre FROM points ORDER BY sha256('2:' || vec_id), point LIMIT {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""
n{i} AS MATERIALIZED (
  SELECT vec_id, any_value(point) AS point, min({{'distance': distance, 'cluster': cluster}}) AS best FROM (
    SELECT line, vec_id, point, cluster, CAST(list_sum(list_transform(list_zip(point, centre), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
    FROM (SELECT row_number() OVER () AS line, vec_id, point FROM points), c{i})
  GROUP BY line, vec_id)""")
        if i < rounds:
            steps.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.cluster, coalesce(moved, centre) AS centre FROM c{i} LEFT JOIN (
    SELECT cluster, list(CAST((total - ((total % n + n) % n)) // n AS BIGINT) ORDER BY place) AS moved FROM (
      SELECT best.cluster AS cluster, place, sum(point[place]) AS total, count(*) AS n FROM n{i}, range(1, {dims + 1}) AS places(place) GROUP BY ALL)
    GROUP BY cluster) USING (cluster))""")
    return "WITH " + ",".join(steps) + f"""
SELECT vec_id, CAST(best.cluster AS INTEGER) AS cluster, best.distance AS distance, CAST(sum(best.distance) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(centre, ',')) AS centroid_sha256
FROM n{rounds} JOIN c{rounds} ON best.cluster = c{rounds}.cluster
"""


_RULE_ROWS = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in URL_RULES)
ORACLES: dict[str, str] = {
    "op3_url_filters": rf"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
split AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
urls AS (SELECT DISTINCT host, path FROM split),
hits AS (
  SELECT host, path, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY host, path ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, verdict DESC) AS place
  FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, split.host, split.path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN hits ON hits.host = split.host AND hits.path = split.path AND place = 1
""",
    "op11_centroids": _clustering_sql(),
    "op12_hard_negatives": """
WITH points AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS point
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other, a.label = r.label AS same, CAST(list_dot_product(a.point, r.point) AS BIGINT) AS score
  FROM points a, points r WHERE a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
  other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
""",
}
