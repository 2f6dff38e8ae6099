"""Top-n, exact-n and positional selections that stay whole under one very large group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.hashing import order_key

SLICES = 256


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, slices: int = SLICES) -> DataFrame:
    """First n rows of each group by `order`, in two steps.

    Every input task belongs to one slice, so the row-number limit already cuts each task's output to n rows
    per group before the shuffle, and no reducer sees more of a large group than its slice's share. The
    second step ranks at most n rows per slice. The slice a row falls into does not change the result.
    """
    sliced = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    final = Window.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn("_rank", F.row_number().over(local))
        .where(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(final))
        .where(F.col("_rank") <= n)
        .drop("_rank", "_slice")
    )


def smallest_by_hash(
    df: DataFrame, key: str, wanted: Callable[[Column, Column], Column], seed: int, pool: Column | None = None, digits: int = 5
) -> DataFrame:
    """Exactly n rows of the pool, the first in seeded hash order of `key`, and all rows outside the pool.

    `wanted` makes n from the number of rows and of pool rows; fails when the pool has fewer. One pass over the key (and
    the pool's columns) counts both per hash prefix (16^digits at most), which gives the total, the pool's size and the prefix
    in which the n-th row lies. A second pass keeps all rows but the pool's at or behind that prefix, and a third over that
    prefix alone ranks its rows, so the table is never sorted in one place and equal keys still give exactly n rows.
    NULL keys come first.
    """
    inside = F.lit(True) if pool is None else F.coalesce(pool, F.lit(False))
    keyed = df.withColumn("_hash", F.coalesce(order_key(key, seed), F.lit(""))).withColumn("_prefix", F.substring("_hash", 1, digits)).withColumn("_pool", inside)
    counts = keyed.groupBy("_prefix").agg(F.count("*").alias("_all"), F.count_if("_pool").alias("_n"))
    whole = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.select(
        "_prefix", "_all", "_n", F.sum("_n").over(running).alias("_upto"),
        wanted(F.sum("_all").over(whole), F.sum("_n").over(whole)).alias("_wanted"),
    )
    holds = (F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_n") < F.col("_wanted"))
    edge = placed.agg(
        F.min(F.when(holds, F.struct("_prefix", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_left")))).alias("edge"),
        F.coalesce(F.sum("_all"), F.lit(0)).alias("all"), F.coalesce(F.sum("_n"), F.lit(0)).alias("size"),
    )
    enough = F.when(wanted(F.col("all"), F.col("size")) <= F.col("size"), F.col("edge"))
    told = enough.otherwise(F.raise_error(F.lit("sample is larger than its pool")).cast("struct<_prefix:string,_left:bigint>"))
    at = edge.select(told.alias("at")).scalar()
    kept = keyed.where(~F.col("_pool") | (F.col("_prefix") < at["_prefix"]))
    ranked = keyed.where(F.col("_pool") & (F.col("_prefix") == at["_prefix"])).withColumn(
        "_rank", F.row_number().over(Window.orderBy("_hash", F.col(key).cast("string")))
    )
    part = ranked.where(F.col("_rank") <= at["_left"]).drop("_rank")
    return kept.unionByName(part).drop("_hash", "_prefix", "_pool")


def head_and_rest(df: DataFrame, key: str, n: int) -> tuple[DataFrame, DataFrame]:
    """The n rows with the smallest unique key, and all others; n is a small fixed count."""
    head = df.orderBy(key).limit(n)
    rest = df.join(F.broadcast(head.select(key)), key, "left_anti")
    return head, rest
