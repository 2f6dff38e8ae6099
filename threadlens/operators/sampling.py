"""Repeatable samples and splits, all driven by seeded key hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.functions.buckets import differs, same
from threadlens.functions.hashing import below_fraction, order_key
from threadlens.operators.ranking import smallest_by_hash, top_per_group


def fraction_sample(df: DataFrame, fraction: float, key: str = "id", seed: int = 42) -> DataFrame:
    return df.where(below_fraction(key, fraction, seed))


def exact_sample(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """Exactly n rows; fails when there are fewer."""
    return smallest_by_hash(df, key, lambda rows, pool: F.lit(n).cast("bigint"), seed)


def sample_per_group(df: DataFrame, column: str, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """At most n rows of every group."""
    return top_per_group(
        df.withColumn("_order", order_key(key, seed)), [column], [F.col("_order"), F.col(key)], n
    ).drop("_order")


def keep_share_of_unchanged(
    df: DataFrame, fraction: float = 0.5, sentiment: str = "sentiment", shifted: str = "shifted", key: str = "id", seed: int = 42
) -> DataFrame:
    """A fraction of the rows whose score was not shifted, and all rows whose score was."""
    unchanged = fraction_sample(df.where(same(shifted, sentiment)), fraction, key, seed)
    return unchanged.unionByName(df.where(differs(shifted, sentiment)))


def rebalance(
    df: DataFrame, share: float = 0.3, sentiment: str = "sentiment", shifted: str = "shifted", key: str = "id", seed: int = 42
) -> DataFrame:
    """Downsample unshifted rows to `share` of the input's size and keep every shifted row.

    The base is the input's row count, so unshifted rows end up above `share` of the result; fails when
    there are too few of them.
    """
    return smallest_by_hash(df, key, lambda rows, pool: F.floor(F.lit(share) * rows), seed, same(shifted, sentiment))


def shuffled(df: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """Rows in seeded hash order, for sinks that should not show input order (a full range sort)."""
    return df.orderBy(order_key(key, seed), key)


def train_test_split(df: DataFrame, test: float, key: str = "id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash; the same row always lands on the same side for one seed."""
    is_test = below_fraction(key, test, seed)
    return df.where(~is_test), df.where(is_test)
