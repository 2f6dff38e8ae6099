"""Allow and block rules on URLs, found by joining short hash prefixes of host-suffix and path-prefix expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty for null or without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def rule_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The deciding rule of each (host, path) of `urls`: columns host, path, rule, verdict; URLs without a rule are absent.

    `rules` has host, path and verdict (`allow` or `block`). A rule fits its host and all subdomains if the URL's path
    starts with the rule's path. The longest rule (host and path together) wins, then the longer host, then `block`.
    Rules with a null host, path or verdict are ignored. Only the label counts and path lengths that occur among the
    rules are expanded (two short sets, whatever the number of rules), so that a long host or path costs no more.
    """
    rules = rules.select("host", "path", "verdict").dropna()
    shape = rules.agg(F.collect_set(_labels(F.col("host"))).alias("labels"), F.collect_set(F.length("path")).alias("lengths")).first()
    distinct = urls.select("host", "path").distinct()
    if not shape["labels"]:
        return distinct.select("host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")).limit(0)
    host, path = F.col("host"), F.col("path")
    expressions = F.array(*[
        F.when((_labels(host) >= n) & (F.length(path) >= m), _digest(F.substring_index(host, ".", -n), F.substring(path, 1, m)))
        for n in sorted(shape["labels"]) for m in sorted(shape["lengths"])
    ])
    expanded = distinct.select("host", "path", F.explode(F.array_compact(expressions)).alias("digest")).withColumn("short", _short(F.col("digest")))
    listed = rules.select(
        _digest(host, path).alias("rule_digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"), "verdict",
        ).alias("hit"),
    ).withColumn("short", _short(F.col("rule_digest")))
    return (
        expanded.join(listed, "short").where("digest = rule_digest")
        .groupBy("host", "path").agg(F.max("hit").alias("hit"))
        .select("host", "path", "hit.rule", "hit.verdict")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Every row of `pages` with page_id, host, path, rule and verdict; `default` where no rule fits.

    Null, empty and malformed URLs have empty host and path and so no rule. Equal URLs are decided once and joined back,
    so that a host with most of the pages is not gathered; repeated rows stay repeated, other columns go.
    """
    split = pages.select("page_id", host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    decided = rule_verdicts(split, rules)
    return split.join(decided, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
