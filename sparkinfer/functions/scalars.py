"""Row-level cleaning expressions. All are safe under ANSI mode."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number(column) -> Column:
    """Column as double with NaN folded into NULL, the single notion of missing."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(~F.isnan(c), c)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Complete cases: rows where every column is neither NULL nor NaN.

    The null checks are plain, so they reach the file scan.
    """
    types = dict(df.dtypes)
    checks = [F.col(c).isNotNull() for c in columns]
    checks += [~F.isnan(F.col(c)) for c in columns if types[c] in ("double", "float")]
    return df.where(reduce(lambda a, b: a & b, checks))


def impute_and_clip(column: Column, fill=0.0, low=0.0, high=1.0) -> Column:
    return F.greatest(F.least(F.coalesce(column, F.lit(fill)), F.lit(high)), F.lit(low))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def parse_date(text: Column) -> Column:
    """Timestamp from text, NULL when it is not a date."""
    return F.try_to_timestamp(text)


def _time_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.date_part(F.lit("SECOND"), ts)


def years_between(later: Column, earlier: Column) -> Column:
    """Whole days elapsed (rounded down) over 365.25, on the wall clock."""
    short = _time_of_day(later) < _time_of_day(earlier)
    days = F.date_diff(later, earlier) - F.when(short, F.lit(1)).otherwise(F.lit(0))
    return days.cast("double") / F.lit(365.25)


def out_of_range(column: Column, low, high) -> Column:
    """True when the value is missing or outside [low, high]."""
    return F.coalesce(~column.between(F.lit(low), F.lit(high)), F.lit(True))


def null_flag(column: Column) -> Column:
    return column.isNull().cast("int")


def outside(column: Column, low: Column, high: Column) -> Column:
    """Strictly outside the fences; a missing value is not an outlier."""
    return F.coalesce((column < low) | (column > high), F.lit(False))


def stable_hash(keys, seed: int) -> Column:
    """Hex digest of the key columns and a seed.

    Keys should be integers, strings or ISO dates so that the text form does not
    depend on how an engine prints floating point.
    """
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts],
                             F.lit(str(seed))))
