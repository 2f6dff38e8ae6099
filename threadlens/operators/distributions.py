"""The numbers behind distribution charts: box plots, histograms and densities."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.operators.quantiles import exact_quantiles
from threadlens.session import written


def box_stats(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Per group: q1, median, q3, whisker ends (extreme values within reach*IQR of the box), outlier count."""
    quartiles = exact_quantiles(df, group, value, [0.25, 0.5, 0.75])
    box = quartiles.groupBy(group).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]
    )
    width = (F.col("q3") - F.col("q1")) * reach
    x = F.col(value)
    inside = (x >= F.col("q1") - width) & (x <= F.col("q3") + width)
    return (
        df.where(x.isNotNull())
        .join(written(box, "boxes"), group)
        .groupBy(group)
        .agg(
            F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
            F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based equal-width bin, the last closed on the right; everything in bin 1 when low equals high."""
    return F.when(low == high, 1).otherwise(F.least(F.width_bucket(x, low, high, F.lit(bins)), F.lit(bins)))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value: (bin, low, n), empty bins included."""
    rows = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"))
    ends = rows.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    counts = rows.groupBy(_bin(F.col("x"), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin", (low + (high - low) * (F.col("bin") - 1) / bins).alias("low"), F.coalesce("n", F.lit(0)).alias("n")
    )


def group_histogram(df: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """Rows per group and bin, bins spanning all groups' values; only bins in use."""
    rows = df.where(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("x"))
    ends = rows.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    return rows.groupBy(group, _bin(F.col("x"), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))


def density(df: DataFrame, group: str, value: str, points: int = 100, cut: float = 2.0) -> DataFrame:
    """Gaussian kernel density per group on an even grid reaching `cut` bandwidths past the data (Scott's rule).

    Equal values are merged first. A group's grid is one row of sums, one per point, to which every merged
    value adds its kernels, so nothing is multiplied out per point before the shuffle.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    merged = rows.groupBy(group, F.col(value).cast("double").alias("x")).agg(F.count("*").alias("c"))
    shape = written(
        rows.groupBy(group)
        .agg(F.count("*").alias("n"), F.stddev_samp(value).alias("sd"), F.min(value).alias("a"), F.max(value).alias("b"))
        .withColumn("h", F.col("sd") * F.pow(F.col("n"), F.lit(-0.2)))
        .where(F.col("h") > 0)
        .select(group, "n", "h", (F.col("a") - F.col("h") * cut).alias("start"), (F.col("b") + F.col("h") * cut).alias("stop")),
        "bandwidths",
    )
    step = (F.col("stop") - F.col("start")) / (points - 1)
    placed = merged.join(shape, group).select(
        group, "c", "start", step.alias("step"), (F.col("n") * F.col("h") * math.sqrt(2 * math.pi)).alias("scale"),
        ((F.col("start") - F.col("x")) / F.col("h")).alias("z"), (step / F.col("h")).alias("dz"),
    )

    def kernels(point: int) -> Column:
        z = F.col("z") + F.col("dz") * point
        return F.sum(F.col("c") * F.exp(z * z * F.lit(-0.5)))

    sums = placed.groupBy(group).agg(
        F.first("start").alias("start"), F.first("step").alias("step"), F.first("scale").alias("scale"),
        F.array(*[kernels(i) for i in range(points)]).alias("sums"),
    )
    spread_out = sums.select(group, "start", "scale", "step", F.posexplode("sums").alias("point", "sum"))
    return spread_out.select(
        group, "point", (F.col("start") + F.col("step") * F.col("point")).alias("x"), (F.col("sum") / F.col("scale")).alias("density")
    )
