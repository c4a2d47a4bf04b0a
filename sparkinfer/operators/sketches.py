"""Mergeable sketches: distinct counts and quantiles kept per small group and united upwards.

A sketch is a few kilobytes whatever it has seen. Kept per day and group it answers for any
coarser grouping without the rows being read again, and a new day adds only its own sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import number, present
from sparkinfer.operators.joins import lookup

#: log2 of the buckets of a distinct-count sketch: the relative error is about 0.8 % (one deviation).
DISTINCT_SIZE = 14
#: Size of a quantile sketch: ranks are off by about half a percent.
QUANTILE_SIZE = 800


def distinct_sketches(df: DataFrame, key: str, by: Sequence[str], size: int = DISTINCT_SIZE) -> DataFrame:
    """One HyperLogLog sketch of the non-null keys for each group: (by, sketch)."""
    return df.where(F.col(key).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(key, size).alias("sketch"))


def distinct_rollup(sketches: DataFrame, by: Sequence[str], output: str = "n_keys") -> DataFrame:
    """Estimates for every prefix of ``by`` down to the total: (by, level, output).

    Sketches are united, never the keys; ``level`` counts the columns rolled up, so that a NULL group
    and a total differ.
    """
    level = F.length(F.regexp_replace(F.conv(F.grouping_id().cast("string"), 10, 2), "0", "")).cast("int")
    return sketches.rollup(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(output), level.alias("level"))


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], size: int = QUANTILE_SIZE) -> DataFrame:
    """One KLL sketch of the values (NULL and NaN left out) for each group: (by, sketch)."""
    rows = present(df, value).select(*by, number(value).alias("__v"))
    return rows.groupBy(*by).agg(F.kll_sketch_agg_double("__v", size).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles of coarser groups from merged sketches: (by, one output a name, n_values)."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("__s"))
    return merged.select(*by, *[F.kll_sketch_get_quantile_double("__s", F.lit(float(p))).alias(c) for c, p in probabilities.items()],
                         F.kll_sketch_get_n_double("__s").alias("n_values"))


def rank_bounds(df: DataFrame, value: str, found: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, quantile, n, below, upto): rows under, and not over, each found quantile of their group."""
    rows = present(df, value).select(*by, number(value).alias("__v"))
    if by:
        placed = lookup(rows, found, by, "n_values", "inner", nulls=True)
    else:
        one = found.select(F.struct(*names).alias("q")).scalar()
        placed = rows.withColumn("__q", one).select("__v", *[F.col(f"__q.{c}").alias(c) for c in names])
    counted = placed.groupBy(*by).agg(F.count("__v").alias("n"), *[
        c for name in names for c in (F.count_if(F.col("__v") < F.col(name)).alias(f"{name}_lt"),
                                      F.count_if(F.col("__v") <= F.col(name)).alias(f"{name}_le"))])
    return counted.select(*by, "n", F.explode(F.array(*[F.struct(
        F.lit(c).alias("quantile"), F.col(f"{c}_lt").alias("below"), F.col(f"{c}_le").alias("upto")) for c in names])).alias("r")).select(
            *by, "n", "r.*")
