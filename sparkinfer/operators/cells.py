"""Counted values of many columns: one scan, one order, every single-column statistic.

(column, value, n) cells are counted in one aggregation over the unpivoted columns and ordered
once, keyed by column. Moments, medians, quantiles, fences, box plots, Kolmogorov-Smirnov, normal
quantile grids, histograms, densities and ranks are then read from the stored cells and never
from the table again. A value that a third of all rows share is one cell.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkinfer.operators import charts, normality, regression
from sparkinfer.operators.describe import melt, shape_of_sample
from sparkinfer.operators.joins import attach, join_on
from sparkinfer.operators.ranks import Layout, _interpolated, cumulative_counts, position, probe, value_counts
from sparkinfer.sources.landing import cut

BY = ["column"]


@dataclass(frozen=True)
class ColumnCells:
    """``counted`` has (column, value, n), stored; ``layout`` says how its values are ordered."""

    counted: DataFrame
    columns: tuple[str, ...]
    layout: Layout

    @cached_property
    def ranked(self) -> DataFrame:
        """(column, value, n, cum_le, tied, total, avg_rank) of all columns, ordered once and stored."""
        return cut(self._placed().withColumn("avg_rank", F.col("cum_le") - (F.col("tied") - F.lit(1)) / F.lit(2.0)))

    def _placed(self) -> DataFrame:
        return cumulative_counts(self.counted, BY, self.layout)

    def recoded(self, column: str, value: Column, extra: int = 0) -> ColumnCells:
        """Cells after ``column`` has been mapped by an expression of ``value``.

        ``extra`` rows without a value so far get what the expression makes of NULL. No row is read again.
        """
        spark = self.counted.sparkSession
        new = F.when(F.col("column") == column, value).otherwise(F.col("value")).cast("double")
        cells = self.counted
        if extra:
            none = spark.range(1).select(F.lit(column).alias("column"), F.lit(None).cast("double").alias("value"),
                                         F.lit(extra).cast("long").alias("n"))
            cells = cells.unionByName(none)
        moved = cells.select("column", new.alias("value"), "n").where(F.col("value").isNotNull())
        return ColumnCells(cut(moved.groupBy("column", "value").agg(F.sum("n").alias("n"))), self.columns, self.layout)

    def only(self, columns: Sequence[str], keep: Column | None = None) -> ColumnCells:
        """The cells of some columns, and of those the values that ``keep`` selects."""
        wanted = F.col("column").isin(list(columns))
        return ColumnCells(self.counted.where(wanted if keep is None else wanted & keep), tuple(columns), self.layout)

    def quantiles(self, points: Mapping[str, float]) -> DataFrame:
        """(column, one output a named probability, n_values), linearly interpolated; only the cells at the positions are met."""
        total, wanted = F.col("total"), F.lit(False)
        for p in points.values():
            for at in (F.floor(position(p, total)), F.ceil(position(p, total))):
                wanted = wanted | ((F.col("cum_le") > at) & (F.col("cum_le") - F.col("n") <= at))
        return _interpolated(self.ranked.where(wanted), list(points), list(points.values()), BY)

    def fences(self, width: float = 1.5) -> DataFrame:
        """(column, q1, q3, low, high, n_values)."""
        iqr = F.col("q3") - F.col("q1")
        return self.quantiles({"q1": 0.25, "q3": 0.75}).select(
            "column", "q1", "q3", (F.col("q1") - F.lit(width) * iqr).alias("low"),
            (F.col("q3") + F.lit(width) * iqr).alias("high"), "n_values")

    @cached_property
    def moments(self) -> DataFrame:
        """(column, n, mean, m2, m3, m4, min, max): central sums about the mean, one row a column, stored."""
        return cut(self._moment_table())

    def _moment_table(self) -> DataFrame:
        n, v = F.col("n").cast("double"), F.col("value")
        means = self.counted.groupBy("column").agg(F.sum("n").alias("rows"), (F.sum(n * v) / F.sum(n)).alias("mean"))
        gap = v - F.col("mean")
        apart = join_on(self.counted, means, BY, small=True)  # one row a column
        return apart.groupBy("column").agg(
            F.first("rows").alias("n"), F.first("mean").alias("mean"), F.sum(n * gap * gap).alias("m2"),
            F.sum(n * gap * gap * gap).alias("m3"), F.sum(n * gap * gap * gap * gap).alias("m4"),
            F.min("value").alias("min"), F.max("value").alias("max"))

    def scaling(self) -> DataFrame:
        """(column, mean, population std), the parameters of a standardisation."""
        return self.moments.select("column", "mean", F.sqrt(F.col("m2") / F.col("n")).alias("std"))

    def describe(self) -> DataFrame:
        """Mean, sample deviation, range, population skewness and excess kurtosis per column."""
        n = F.col("n").cast("double")
        return self.moments.select("column", "n", "mean", self._sample_std().alias("std"), "min", "max",
                                   self._skew().alias("skew"), self._kurtosis().alias("kurtosis")).where(n > 0)

    def describe_full(self) -> DataFrame:
        """As :meth:`describe` plus exact median and variance, with bias-corrected shape."""
        base = self.moments.withColumns({"g1": self._skew(), "g2": self._kurtosis()})
        middle = self.quantiles({"median": 0.5}).drop("n_values")
        skew, kurtosis = shape_of_sample(F.col("n").cast("double"), F.col("g1"), F.col("g2"))
        std = self._sample_std()
        return join_on(base, middle, BY, "left", small=True).select(
            "column", "n", "mean", "median", (std * std).alias("variance"), std.alias("std"), "min", "max",
            skew.alias("skew"), kurtosis.alias("kurtosis"))

    @staticmethod
    def _sample_std() -> Column:
        return F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))

    @staticmethod
    def _skew() -> Column:
        n = F.col("n").cast("double")
        return F.when(F.col("m2") > 0, F.sqrt(n) * F.col("m3") / F.pow(F.col("m2"), F.lit(1.5)))

    @staticmethod
    def _kurtosis() -> Column:
        n = F.col("n").cast("double")
        return F.when(F.col("m2") > 0, n * F.col("m4") / (F.col("m2") * F.col("m2")) - 3)

    def outliers(self, column: str, width: float = 1.5) -> DataFrame:
        """(n, n_outliers, outlier_rate) of a column whose rows without a value count as no outliers."""
        placed = join_on(self.counted.where(F.col("column") == column), self.fences(width).select("column", "low", "high"), BY, small=True)
        out = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
        return placed.agg(F.sum("n").alias("n"), F.sum(F.when(out, F.col("n")).otherwise(0)).alias("n_outliers")).withColumn(
            "outlier_rate", F.col("n_outliers") / F.nullif(F.col("n"), F.lit(0)))

    def kolmogorov(self) -> DataFrame:
        """(column, n, statistic, status, p_value) of the standardised values against N(0, 1).

        What has been stored for other statistics is read; what has not is computed for this one and not stored.
        """
        stored = vars(self)
        moments = self.moments if "moments" in stored else self._moment_table()
        placed = self.ranked if "ranked" in stored else self._placed()
        scale = moments.select("column", "mean", self._sample_std().alias("std"))
        return normality.ks_of_positions(join_on(placed, scale, BY, small=True), BY)

    def qq(self, points: int = 200) -> DataFrame:
        """Standardised values against normal quantiles on a grid, per column."""
        scaled = join_on(self.ranked, self.scaling(), BY, small=True)
        return regression.qq_grid(scaled, BY, points)

    def boxplot(self, width: float = 1.5) -> DataFrame:
        """(column, n, q1, median, q3, whisker_low, whisker_high, n_fliers)."""
        q = self.quantiles({"q1": 0.25, "median": 0.5, "q3": 0.75})
        return charts.box_of_cells(join_on(self.counted, q, BY, small=True), "value", "n", BY, width)

    def histogram(self, bins: int | str = "auto") -> DataFrame:
        """(column, bin, low, high, n, density) with equal-width bins over each column's range."""
        limits = self.moments.select(
            "column", F.when(F.col("min") == F.col("max"), F.col("min") - 0.5).otherwise(F.col("min")).alias("low"),
            F.when(F.col("min") == F.col("max"), F.col("max") + 0.5).otherwise(F.col("max")).alias("high"), F.col("n").alias("total"))
        if bins == "auto":
            q = self.quantiles({"q1": 0.25, "q3": 0.75}).drop("n_values")
            limits = join_on(limits, q, BY, small=True).withColumn("k", charts.bin_count(
                F.col("total"), F.col("high") - F.col("low"), F.col("q3") - F.col("q1")))
        else:
            limits = limits.withColumn("k", F.lit(int(bins)).cast("long"))
        return charts.histogram_of_cells(self.counted, limits.select("column", "low", "high", "total", "k"), BY)

    def density(self, points: int = 200) -> DataFrame:
        """(column, point, x, density): Gaussian kernels with Scott's bandwidth over each column's range."""
        limits = self.moments.select("column", F.col("min").alias("low"), F.col("max").alias("high"), F.col("n").alias("total"),
                                     self._sample_std().alias("std"))
        return charts.density_of_cells(self.counted, limits, BY, points)

    def with_ranks(self, rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Add the centred average rank ``rank_<column>`` of several columns; rows keep their place when the ranks are few."""
        out = rows
        for c in columns:
            table = self.ranked.where(F.col("column") == c).select(
                F.col("value").alias("__v"), F.col("n").alias("__n"), (F.col("avg_rank") - (F.col("total") + 1) / 2.0).alias(f"rank_{c}"))
            keyed = out.withColumn("__v", F.col(c).cast("double"))
            if self.layout.small:  # the probe has measured the cells
                out = keyed.join(F.broadcast(table.drop("__n")), "__v", "left").drop("__v")
            else:
                out = attach(keyed, table, ["__v"], "__n").drop("__v", "__n")
        return out


def count_cells(df: DataFrame, columns: Sequence[str]) -> ColumnCells:
    """Count the values of several columns in one scan of ``df``; NULL and NaN have no cell.

    The cells are stored and probed once, so the layout fits the column with most values.
    """
    counted = cut(value_counts(melt(df, columns), "value", BY))
    return ColumnCells(counted, tuple(columns), probe(counted, "value", BY))


__all__ = ["ColumnCells", "count_cells"]
