"""Cleaning operators over whole tables: imputation, fences, standardisation, dummies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import (impute_and_clip, number, out_of_range, outside,
                                          parse_date, safe_ratio, years_between)
from sparkinfer.operators.joins import lookup
from sparkinfer.operators.ranks import cell_quantiles, quantiles, value_counts
from sparkinfer.sources.landing import cut

# Valid age range in years and the age used when no valid one exists.
MIN_AGE, MAX_AGE = 0, 110
FALLBACK_AGE = 35.0
FENCE_WIDTH = 1.5


def derive(df: DataFrame, *, discount: str = "discount", amount: str = "amount",
           units: str = "units", sold_at: str | None = "ts", birth: str | None = None,
           age: str = "age_years", unit_amount: str = "amount_per_unit") -> DataFrame:
    """Fill and clip the discount, add amount per unit and, given a birth column, age."""
    out = df.withColumn(discount, impute_and_clip(F.col(discount)))
    out = out.withColumn(unit_amount, safe_ratio(F.col(amount), F.col(units)))
    if birth is not None:
        born = F.col(birth)
        if dict(df.dtypes)[birth] == "string":
            born = parse_date(born)
        out = out.withColumn(age, years_between(F.col(sold_at), born))
    return out


def invalid_count(df: DataFrame, column: str, low=MIN_AGE, high=MAX_AGE) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(out_of_range(number(column), low, high)).alias("n_invalid"))


def valid_median(df: DataFrame, column: str, low=MIN_AGE, high=MAX_AGE,
                 fallback: float = FALLBACK_AGE, approximate: bool = False) -> DataFrame:
    """One row with the median of the in-range values, or the fallback if there are none."""
    valid = df.where(~out_of_range(number(column), low, high))
    if approximate:
        found = quantiles(valid, column, {"median": 0.5}, approximate=True)
    else:  # ages hold few distinct values: they are counted in one pass over the source
        found = cell_quantiles(cut(value_counts(valid, column)), {"median": 0.5})
    return found.select(F.coalesce("median", F.lit(fallback)).alias("median"), "n_values")


def impute_invalid(df: DataFrame, column: str, low=MIN_AGE, high=MAX_AGE,
                   fallback: float = FALLBACK_AGE, approximate: bool = False,
                   median: DataFrame | None = None) -> DataFrame:
    """Replace missing or out-of-range values with the median of the valid ones.

    ``median`` may be given if :func:`valid_median` has been called already.
    """
    found = valid_median(df, column, low, high, fallback, approximate) if median is None else median
    middle = found.select("median").scalar()
    bad = out_of_range(number(column), low, high)
    return df.withColumn(column, F.when(bad, middle).otherwise(number(column)))


def iqr_fences(df: DataFrame, column: str, by: Sequence[str] = (), width: float = FENCE_WIDTH,
               approximate: bool = False) -> DataFrame:
    """Quartiles and the fences q1 - width*iqr, q3 + width*iqr."""
    q = quantiles(df, column, {"q1": 0.25, "q3": 0.75}, by, approximate)
    iqr = F.col("q3") - F.col("q1")
    return q.select(*by, "q1", "q3", (F.col("q1") - F.lit(width) * iqr).alias("low"),
                    (F.col("q3") + F.lit(width) * iqr).alias("high"), "n_values")


def flag_outliers(df: DataFrame, column: str, output: str = "is_outlier",
                  by: Sequence[str] = (), width: float = FENCE_WIDTH,
                  approximate: bool = False) -> DataFrame:
    """Mark values strictly outside the fences; every row is kept. NULL is a group like any other."""
    fences = iqr_fences(df, column, by, width, approximate)
    value = number(column)
    if by:
        placed = lookup(df, fences.select(*by, "low", "high", "n_values"), by, "n_values", nulls=True)
        return placed.select(*df.columns, outside(value, F.col("low"), F.col("high")).alias(output))
    pair = fences.select(F.struct("low", "high").alias("f")).scalar()
    return (df.withColumn("__f", pair)
            .select(*df.columns, outside(value, F.col("__f.low"), F.col("__f.high")).alias(output)))


def outlier_summary(df: DataFrame, flag: str = "is_outlier") -> DataFrame:
    n, hits = F.count(F.lit(1)), F.count_if(F.col(flag))
    return df.agg(n.alias("n"), hits.alias("n_outliers"),
                  (hits / F.nullif(n, F.lit(0))).alias("outlier_rate"))


def scaling_parameters(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation per column, the parameters of :func:`standardize`."""
    wide = df.groupBy(*by).agg(*[f(number(c)).alias(f"c{i}_{nm}") for i, c in enumerate(columns)
                                 for nm, f in (("mean", F.avg), ("std", F.stddev_pop))])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}_mean").alias("mean"),
                     F.col(f"c{i}_std").alias("std")) for i, c in enumerate(columns)]
    return wide.select(*by, F.explode(F.array(*rows)).alias("r")).select(*by, "r.*")


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_scaled",
                parameters: DataFrame | None = None) -> DataFrame:
    """Add (x - mean) / population deviation; a constant column scales by 1.

    ``parameters`` (column, mean, std) may be given if they are known; one row a column reaches the driver.
    """
    if parameters is None:
        fields = [f(number(c)).alias(f"{nm}{i}") for i, c in enumerate(columns)
                  for nm, f in (("m", F.avg), ("s", F.stddev_pop))]
        marked = df.withColumn("__p", df.agg(F.struct(*fields).alias("p")).scalar())
        centres = [(F.col(f"__p.m{i}"), F.col(f"__p.s{i}")) for i in range(len(columns))]
    else:
        known = {r["column"]: (r["mean"], r["std"]) for r in parameters.collect()}
        marked = df
        centres = [tuple(F.lit(x).cast("double") for x in known.get(c, (None, None))) for c in columns]
    scaled = [((number(c) - mean) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)).alias(f"{c}{suffix}")
              for c, (mean, spread) in zip(columns, centres, strict=True)]
    return marked.select(*df.columns, *scaled)


def expected_levels(df: DataFrame, channel: str, store: str, channels: Sequence[str],
                    store_range: tuple[int, int]):
    """Predicate for rows whose two categories are both expected (missing is unexpected)."""
    return F.coalesce(F.col(channel).isin(list(channels)) & F.col(store).between(*store_range),
                      F.lit(False))


def rejected_count(df: DataFrame, valid) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~valid).alias("n_rejected"))


MAX_LEVELS = 1000


def level_counts(df: DataFrame, column: str, max_levels: int = MAX_LEVELS) -> list[str]:
    """Levels of a categorical column, most frequent first, ties by name.

    Only the level names reach the driver; a column with more than ``max_levels`` is an error.
    """
    counted = (df.where(F.col(column).isNotNull()).groupBy(column)
               .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(max_levels + 1))
    levels = [r[0] for r in counted.select(column).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels; dummies are not sensible")
    return levels


def one_hot(df: DataFrame, column: str, levels: Sequence | None = None, baseline=None,
            prefix: str | None = None) -> tuple[DataFrame, list[str]]:
    """0/1 columns for every level but the baseline (default: the most frequent level).

    A NULL or a value that is none of ``levels`` has NULL dummies, so that a fit leaves the row
    out and counts it, and does not take it for the baseline.
    """
    known = list(levels) if levels is not None else level_counts(df, column)
    base = known[0] if baseline is None and known else baseline
    names = {v: f"{prefix or column}_{v}" for v in known if v != base}
    listed = F.col(column).isin([*known, *([] if base is None or base in known else [base])])
    hot = [F.when(F.col(column) == F.lit(v), 1.0).when(listed, 0.0).alias(nm) for v, nm in names.items()]
    return df.select("*", *hot), list(names.values())
