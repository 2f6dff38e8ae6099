"""Exact group quantiles that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.session import written

BINS = 2048


def exact_quantiles(
    df: DataFrame, group: str, value: str, probs: Sequence[float], rounds: int | None = None, bins: int = BINS
) -> DataFrame:
    """Linearly interpolated quantiles per group: (group, prob, quantile).

    Equal values are merged into counts first. Then, per group and wanted rank, the range of values is cut into
    equal bins, the bin holding the rank is found from bin counts, and only its values go on. Steps repeat until no
    range holds more than BINS distinct values (at least `rounds` times, for tests), which are ranked; so the last step
    is bounded however the values are spread. The lowest and the highest value of a range never share a bin, so every step
    leaves fewer. Every step is a combinable aggregation, so a group holding most of the rows, or one value repeated
    without end, costs no more than its distinct values spread over tasks. Steps are jobs: the number of them depends
    on the values.
    """
    bins = max(2, bins)
    probs_col = F.array(*[F.lit(float(p)) for p in probs])
    counted = written(
        df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
        .groupBy(F.col(group).alias("g"), F.col(value).cast("double").alias("x"))
        .agg(F.count("*").alias("n")),
        "values",
    )
    spot = F.col("prob") * (F.col("rows") - 1)
    wanted = written(
        counted.groupBy("g")
        .agg(F.sum("n").alias("rows"), F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("values"))
        .withColumn("prob", F.explode(probs_col))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(spot), F.ceil(spot)))))
        .select("g", "prob", "rows", F.col("rank").cast("bigint").alias("rank"), "low", "high", "values"),
        "ranks",
    )
    # One target per distinct rank of a group; `before` counts the group's rows below `low`.
    target = wanted.select("g", "rank", "low", "high", "values", F.lit(0).cast("bigint").alias("before")).distinct()
    step = 0
    while step < (rounds or 0) or not target.where(F.col("values") > BINS).isEmpty():
        target = written(_narrow(counted, target, bins), f"bins{step}")
        step += 1
    inside = counted.join(target.drop("values"), "g").where(F.col("x").between(F.col("low"), F.col("high")))
    picked = _holding(inside.withColumn("at", F.col("x")), F.col("at")).select("g", "rank", "x")
    ends = wanted.join(picked, ["g", "rank"])
    return (
        ends.groupBy("g", "prob", "rows")
        .agg(F.min("x").alias("a"), F.max("x").alias("b"))
        .select(
            F.col("g").alias(group), "prob",
            (F.col("a") + (F.col("b") - F.col("a")) * _fraction(F.col("prob") * (F.col("rows") - 1))).alias("quantile"),
        )
    )


def _fraction(x: Column) -> Column:
    return x - F.floor(x)


def _narrow(counted: DataFrame, target: DataFrame, bins: int) -> DataFrame:
    """For each (group, rank) the bin of its current range that holds the rank, as the new range."""
    inside = counted.join(target.drop("values"), "g").where(F.col("x").between(F.col("low"), F.col("high")))
    width = F.col("high") / bins - F.col("low") / bins
    even = F.least(F.floor(F.col("x") / width - F.col("low") / width), F.lit(bins - 1))
    place = F.when(F.col("x") == F.col("high"), bins - 1).when(F.col("x") == F.col("low"), 0).when(width > 0, F.greatest(even, F.lit(0))).otherwise(0)
    hist = inside.groupBy("g", "rank", "before", place.cast("bigint").alias("at")).agg(
        F.sum("n").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("values")
    )
    held = _holding(hist, F.col("at"))
    return held.select("g", "rank", "low", "high", "values", F.col("below").alias("before"))


def _holding(rows: DataFrame, order: Column) -> DataFrame:
    """The row whose counts cover the wanted rank, with the number of group rows `below` it."""
    upto = Window.partitionBy("g", "rank").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = rows.withColumn("upto", F.col("before") + F.sum("n").over(upto)).withColumn("below", F.col("upto") - F.col("n"))
    return run.where((F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
