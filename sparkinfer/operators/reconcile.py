"""Compare metric tables: against expected values, and run against run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-3
SAME = 1e-12


def check_expected(actual: DataFrame, expected: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """PASS / FAIL / MISSING for every expected metric.

    ``expected`` is (metric, value, is_count); counts must match exactly, other
    metrics within a relative tolerance. ``actual`` is (metric, value).
    """
    got = actual.select(F.col("metric").alias("m"), F.col("value").cast("double").alias("actual"))
    want = F.col("expected")
    error = F.abs(F.col("actual") - want) / F.greatest(F.abs(want), F.lit(1e-10))
    good = F.when(F.col("is_count"), F.floor("actual") == F.floor(want)).otherwise(error < tolerance)
    base = expected.select("metric", F.col("value").cast("double").alias("expected"), "is_count")
    return (base.join(got, base["metric"] == got["m"], "left")
            .select("metric", "expected", "actual", F.when(F.col("m").isNotNull(), error).alias("relative_error"),
                    F.when(F.col("m").isNull(), "MISSING").when(F.coalesce(good, F.lit(False)), "PASS")
                    .otherwise("FAIL").alias("status")))


def compare_runs(first: DataFrame, second: DataFrame, tolerance: float = SAME) -> DataFrame:
    """IDENTICAL / DIFFERS / MISSING_IN_ONE for the metrics of two runs."""
    a = first.select("metric", F.col("value").cast("double").alias("value_a"), F.lit(True).alias("in_a"))
    b = second.select("metric", F.col("value").cast("double").alias("value_b"), F.lit(True).alias("in_b"))
    gap = F.abs(F.col("value_a") - F.col("value_b"))
    alike = F.col("value_a").eqNullSafe(F.col("value_b")) | F.coalesce(gap < tolerance, F.lit(False))
    return (a.join(b, "metric", "full_outer")
            .select("metric", "value_a", "value_b", gap.alias("difference"),
                    F.when(F.col("in_a").isNull() | F.col("in_b").isNull(), "MISSING_IN_ONE")
                    .when(alike, "IDENTICAL").otherwise("DIFFERS").alias("status")))
