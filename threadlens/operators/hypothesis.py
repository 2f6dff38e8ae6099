"""Hypothesis tests: rows are reduced to group statistics once, the rest is arithmetic on a small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.probability import chi2_p_value, f_p_value, t_p_value, tukey_critical, tukey_p_value
from threadlens.operators.quantiles import exact_quantiles
from threadlens.session import written


def group_moments(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean and sample variance per group: (grp, n, mean, var). Missing values and groups are left out."""
    rows = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    return rows.groupBy(F.col(group).alias("grp")).agg(
        F.count("*").alias("n"),
        F.avg(value).alias("mean"),
        # Population variance times n/(n-1) gives 0/0 for one row; a lone row adds nothing to the error sum.
        F.coalesce(F.var_pop(value), F.lit(0.0)).alias("pop_var"),
    )


#: Blocks of groups whose pairs are formed apart.
PAIR_BLOCKS = 16


def _anova_parts(moments: DataFrame) -> DataFrame:
    """Between and within sums of squares with their degrees of freedom, one row."""
    # sum n*mean^2 - N*grand^2 loses digits; the weighted variance of the means does not.
    total, weighted = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    grand = moments.agg((weighted / total).alias("m")).select("m").scalar()
    gap = F.col("mean") - grand
    return moments.agg(
        F.sum(F.col("n") * gap * gap).alias("ss_between"),
        F.sum(F.col("n") * F.col("pop_var")).alias("ss_within"),
        (F.count("*") - 1).alias("df_between"),
        (F.sum("n") - F.count("*")).alias("df_within"),
    )


def anova(df: DataFrame, group: str, value: str, p_value: bool = True) -> DataFrame:
    """One-way analysis of variance: f_stat, df_between, df_within and p_value.

    f_stat and p_value are NULL without variance within the groups, or with one group only.
    """
    parts = _anova_parts(written(group_moments(df, group, value), "moments"))
    f = F.try_divide(F.try_divide("ss_between", "df_between"), F.try_divide("ss_within", "df_within"))
    out = parts.select(f.alias("f_stat"), "df_between", "df_within")
    return out.withColumn("p_value", f_p_value(F.col("f_stat"), F.col("df_between"), F.col("df_within"))) if p_value else out


def tukey_hsd(df: DataFrame, group: str, value: str, alpha: float = 0.05, p_value: bool = True) -> DataFrame:
    """All pairs of group means: group1, group2, meandiff, q_stat and, with `p_value`, p_adj, lower, upper, reject.

    Pairs come from the moments of the groups, which are dealt into `PAIR_BLOCKS` blocks: each two blocks meet in one cell of
    a grid by an equi-join, and of each two groups there the smaller name comes first. No task sees all groups.
    """
    moments = written(group_moments(df, group, value), "moments")
    parts = _anova_parts(moments)
    error, dof = parts.select(F.try_divide("ss_within", "df_within")).scalar(), parts.select("df_within").scalar()
    count = moments.agg(F.count("*").alias("k")).select("k").scalar()
    block = F.pmod(F.xxhash64("grp"), F.lit(PAIR_BLOCKS)).cast("int")
    every = F.sequence(F.lit(0), F.lit(PAIR_BLOCKS - 1))
    left = moments.withColumn("cell", F.explode(F.transform(every, lambda other: block * PAIR_BLOCKS + other))).withColumn("k", count)
    right = moments.select(
        F.explode(F.transform(every, lambda other: other * PAIR_BLOCKS + block)).alias("cell"),
        F.col("grp").alias("group2"), F.col("n").alias("n2"), F.col("mean").alias("mean2"),
    )
    spread_ = F.sqrt(error / 2 * (1 / F.col("n") + 1 / F.col("n2")))
    pairs = left.join(right, "cell").where(F.col("grp") < F.col("group2")).select(
        F.col("grp").alias("group1"), "group2", (F.col("mean2") - F.col("mean")).alias("meandiff"),
        F.try_divide(F.abs(F.col("mean2") - F.col("mean")), spread_).alias("q_stat"), spread_.alias("_spread"), "k",
        dof.alias("_dof"),
    )
    if not p_value:
        return pairs.select("group1", "group2", "meandiff", "q_stat")
    limit = (
        parts.select(count.alias("k"), "df_within")
        .select(tukey_critical(F.lit(1 - alpha), F.col("k"), F.col("df_within")).alias("q"))
    )
    half = written(limit, "critical").select("q").scalar() * F.col("_spread")
    return pairs.withColumn("p_adj", tukey_p_value(F.col("q_stat"), F.col("k"), F.col("_dof"))).select(
        "group1", "group2", "meandiff", "q_stat", "p_adj",
        (F.col("meandiff") - half).alias("lower"), (F.col("meandiff") + half).alias("upper"),
        (F.col("p_adj") < alpha).alias("reject"),
    )


def levene(df: DataFrame, group: str, value: str, p_value: bool = True) -> DataFrame:
    """Equal-variance test on distances from the group median: w_stat, df_between, df_within and p_value."""
    medians = exact_quantiles(df, group, value, [0.5]).select(group, F.col("quantile").alias("_median"))
    apart = df.join(written(medians, "medians"), group).withColumn("_gap", F.abs(F.col(value) - F.col("_median")))
    return anova(apart, group, "_gap", p_value).withColumnRenamed("f_stat", "w_stat")


def welch(df: DataFrame, group: str, value: str, first: str, second: str, p_value: bool = True) -> DataFrame:
    """Two-sample t-test without equal variances: t_stat, dof and two-sided p_value."""
    rows = df.where(F.col(group).isin(first, second))
    is_first, is_second = F.col(group) == first, F.col(group) == second

    def side(test, name):
        x = F.when(test, F.col(value))
        return F.count(x).alias(f"n{name}"), F.avg(x).alias(f"m{name}"), F.var_samp(x).alias(f"v{name}")

    stats = rows.agg(*side(is_first, 1), *side(is_second, 2))
    a, b = F.try_divide("v1", "n1"), F.try_divide("v2", "n2")
    part = lambda x, n: F.try_divide(x * x, F.col(n) - 1)
    out = stats.select(
        F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(a + b)).alias("t_stat"),
        F.try_divide((a + b) * (a + b), part(a, "n1") + part(b, "n2")).alias("dof"),
    )
    return out.withColumn("p_value", t_p_value(F.col("t_stat"), F.col("dof"))) if p_value else out


#: Column classes that meet a row class in one task of the contingency table.
_CLASSES = 1000


def _margins(df: DataFrame, row: str, column: str) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """Observed cells, row and column sums, and the number of rows."""
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    cells = written(known.groupBy(row, column).agg(F.count("*").alias("observed")), "cells")
    rows = cells.groupBy(row).agg(F.sum("observed").alias("_r"))
    columns = cells.groupBy(column).agg(F.sum("observed").alias("_c"))
    return cells, rows, columns, cells.agg(F.sum("observed").alias("n")).scalar()


def expected_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Observed and expected counts of every cell of the contingency table, empty cells included.

    The whole table is the result, so every row class meets every column class: by equality of the column's block, of
    about a thousand columns each, so that no task holds all classes.
    """
    cells, rows, columns, total = _margins(df, row, column)
    blocks = F.greatest(F.ceil(columns.agg(F.count("*").alias("k")).scalar() / _CLASSES), F.lit(1)).cast("bigint")
    spread_rows = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    grid = spread_rows.join(columns.withColumn("_block", F.pmod(F.xxhash64(column), blocks)), "_block").drop("_block")
    return grid.join(cells, [row, column], "left").select(
        row, column, F.coalesce("observed", F.lit(0)).alias("observed"),
        (F.col("_r") * F.col("_c") / total).alias("expected"),
    )


def chi_squared(df: DataFrame, row: str, column: str, p_value: bool = True) -> DataFrame:
    """Independence test: chi2_stat, dof and p_value; continuity correction at one degree of freedom.

    Only observed cells are visited: an empty cell adds its expected count, and all empty ones together what the observed
    cells' expected counts leave of the rows. In a table of two by two all four gaps are equal, so one of them and the
    sums of inverse margins give the corrected value.
    """
    cells, rows, columns, total = _margins(df, row, column)
    across, down = (m.agg(F.count("*").alias("k")).scalar() for m in (columns, rows))
    inverse = rows.agg(F.sum(1 / F.col("_r")).alias("s")).scalar() * columns.agg(F.sum(1 / F.col("_c")).alias("s")).scalar()
    placed = cells.join(rows, row).join(columns, column).withColumn("expected", F.col("_r") * F.col("_c") / total)
    gap = F.abs(F.col("observed") - F.col("expected"))
    sums = placed.agg(
        F.sum(gap * gap / F.col("expected")).alias("seen"), F.sum("expected").alias("covered"), F.count("*").alias("cells"), F.max(gap).alias("gap")
    ).withColumns({"dof": (down - 1) * (across - 1), "full": down * across})
    plain = F.col("seen") + F.when(F.col("cells") < F.col("full"), total - F.col("covered")).otherwise(0.0)
    corrected = F.pow(F.col("gap") - F.least(F.lit(0.5), F.col("gap")), 2) * total * inverse
    out = sums.select(F.when(F.col("dof") == 1, corrected).otherwise(plain).alias("chi2_stat"), "dof")
    return out.withColumn("p_value", chi2_p_value(F.col("chi2_stat"), F.col("dof"))) if p_value else out
