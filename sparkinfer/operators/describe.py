"""Descriptive statistics, null rates and group summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import null_flag, number
from sparkinfer.operators.joins import join_on
from sparkinfer.operators.ranks import Layout, medians


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by, column, value) of several numeric columns, in one scan."""
    wide = df.select(*by, *[number(c).alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column", "value")


def _spread(df: DataFrame, columns, by, build) -> DataFrame:
    """One aggregate over all columns, then one output row per column."""
    stats = {c: build(number(c)) for c in columns}
    wide = df.groupBy(*by).agg(
        *[agg.alias(f"c{i}_{name}") for i, c in enumerate(columns) for name, agg in stats[c].items()])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"c{i}_{name}").alias(name) for name in stats[c]])
            for i, c in enumerate(columns)]
    return wide.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation, range, and population skewness and excess kurtosis.

    All columns and groups come out of a single aggregation. Skewness and kurtosis
    are NULL for a constant column.
    """
    return _spread(df, columns, by, lambda c: {
        "n": F.count(c), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c),
        "max": F.max(c), "skew": F.skewness(c), "kurtosis": F.kurtosis(c)})


def shape_of_sample(n: Column, g1: Column, g2: Column) -> tuple[Column, Column]:
    """Bias-corrected skewness and excess kurtosis from the population's."""
    skew = F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    kurtosis = F.when(n > 3, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * g2 + 6))
    return skew, kurtosis


def describe_full(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """As :func:`describe` plus exact median and variance, with bias-corrected shape."""
    base = _spread(df, columns, by, lambda c: {
        "n": F.count(c), "mean": F.avg(c), "variance": F.var_samp(c), "std": F.stddev_samp(c),
        "min": F.min(c), "max": F.max(c), "g1": F.skewness(c), "g2": F.kurtosis(c)})
    middle = medians(melt(df, columns, by), "value", [*by, "column"]).drop("n_values")
    skew, kurt = shape_of_sample(F.col("n").cast("double"), F.col("g1"), F.col("g2"))
    return join_on(base, middle, [*by, "column"], "left").select(
        *by, "column", "n", "mean", "median", "variance", "std", "min", "max",
        skew.alias("skew"), kurt.alias("kurtosis"))


def null_rates(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows, missing values and missing share per column."""
    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(null_flag(F.col(c)).cast("long")).alias(f"c{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"c{i}"), F.lit(0)).alias("n_null"))
            for i, c in enumerate(columns)]
    return (wide.select(*by, "n", F.explode(F.array(*rows)).alias("r"))
            .select(*by, "r.column", "n", "r.n_null",
                    (F.col("r.n_null") / F.nullif(F.col("n"), F.lit(0))).alias("null_rate")))


def group_summary(df: DataFrame, value: str, by: Sequence[str],
                  layout: Layout | None = None) -> DataFrame:
    """Count, mean and exact median per group."""
    base = df.groupBy(*by).agg(F.count(number(value)).alias("n"), F.avg(number(value)).alias("mean"))
    return join_on(base, medians(df, value, by, layout).drop("n_values"), by, "left")


def group_sizes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
