"""The tables behind the charts: histograms, densities, box plots, residual bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkinfer.functions.normal import norm_pdf
from sparkinfer.functions.scalars import number, present
from sparkinfer.operators.joins import join_on, lookup
from sparkinfer.operators.ranks import quantiles

#: Narrow bins a kernel's bandwidth spans when a density is folded.
BINS_PER_BANDWIDTH = 64
#: Bandwidths a kernel reaches: beyond, it is below 1e-17 of its height.
REACH = 9
#: Bins of one array when empty bins are laid out.
PIECE = 8192


def _slot(value: Column, low: Column, high: Column, bins: Column) -> Column:
    """0-based equal-width bin; the last bin is closed on the right."""
    share = (value - low) / (high - low)
    return F.least(F.floor(share * bins), bins - 1).cast("long")


def _limits(rows: DataFrame, value: str, extra: dict[str, Column] | None = None) -> Column:
    """Value range as a struct scalar; a constant is widened by a half on each side."""
    low, high = F.min(number(value)), F.max(number(value))
    flat = low == high
    return rows.agg(F.struct(
        F.when(flat, low - 0.5).otherwise(low).alias("low"),
        F.when(flat, high + 0.5).otherwise(high).alias("high"),
        F.count(number(value)).alias("total"),
        *[c.alias(n) for n, c in (extra or {}).items()]).alias("l")).scalar()


def bin_count(n: Column, span: Column, iqr: Column) -> Column:
    """Number of bins: the finer of Freedman-Diaconis and Sturges."""
    n = n.cast("double")
    width = F.lit(2.0) * iqr / F.pow(n, F.lit(1.0 / 3.0))
    sturges = F.ceil(F.log2(n) + 1)
    return F.greatest(sturges, F.coalesce(F.ceil(span / F.nullif(width, F.lit(0.0))), sturges)).cast("long")


def auto_bins(df: DataFrame, value: str) -> Column:
    """Number of bins of a column as a scalar; see :func:`bin_count`."""
    rows = present(df, value)
    q = quantiles(rows, value, {"q1": 0.25, "q3": 0.75})
    limits = _limits(rows, value)
    return (q.where(F.col("n_values") > 0).withColumn("__l", limits)
            .select(bin_count(F.col("n_values"), F.col("__l.high") - F.col("__l.low"), F.col("q3") - F.col("q1")).alias("bins")).scalar())


def histogram(df: DataFrame, value: str, bins: int | str = "auto") -> DataFrame:
    """Equal-width histogram of the whole column: (bin, low, high, n, density)."""
    rows = present(df, value)
    count = auto_bins(df, value) if bins == "auto" else F.lit(int(bins)).cast("long")
    placed = (rows.select(F.col(value).cast("double").alias("v"))
              .withColumn("l", _limits(rows, value)).withColumn("k", count)
              .select(_slot(F.col("v"), F.col("l.low"), F.col("l.high"), F.col("k")).alias("bin"),
                      "l.low", "l.high", "l.total", "k"))
    folded = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("low", "high", "total", "k")])
    return _with_empty_bins(folded, [])


def histogram_of_cells(cells: DataFrame, limits: DataFrame, by: Sequence[str]) -> DataFrame:
    """The histogram of counted values (by, value, n), ``limits`` (by, low, high, total, k) having one row a group."""
    placed = join_on(cells, limits, by, small=True)
    folded = (placed.withColumn("bin", _slot(F.col("value"), F.col("low"), F.col("high"), F.col("k")))
              .groupBy(*by, "bin").agg(F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("low", "high", "total", "k")]))
    return _with_empty_bins(folded, list(by))


def _with_empty_bins(folded: DataFrame, by: list[str]) -> DataFrame:
    """Occupied bins (by, bin, n, low, high, total, k) with the empty ones between them and at both ends.

    Runs of empty bins are laid out in pieces of ``PIECE``, so that a far outlier makes rows, not one huge array.
    """
    order = Window.partitionBy(*by).orderBy("bin")
    start = F.when(F.lag("bin").over(order).isNull(), F.lit(0).cast("long")).otherwise(F.col("bin"))
    stop = F.coalesce(F.lead("bin").over(order), F.col("k")) - 1
    width = (F.col("high") - F.col("low")) / F.col("k")
    runs = folded.withColumn("start", start).withColumn("stop", stop)
    pieces = runs.withColumn("piece", F.explode(F.sequence(F.floor(F.col("start") / PIECE), F.floor(F.col("stop") / PIECE))))
    inside = F.sequence(F.greatest("start", F.col("piece") * PIECE), F.least("stop", F.col("piece") * PIECE + PIECE - 1))
    return (pieces.withColumn("each", F.explode(inside))
            .withColumn("n", F.when(F.col("each") == F.col("bin"), F.col("n")).otherwise(F.lit(0).cast("long")))
            .withColumn("bin", F.col("each"))
            .select(*by, "bin", (F.col("low") + F.col("bin") * width).alias("low"),
                    (F.col("low") + (F.col("bin") + 1) * width).alias("high"), "n",
                    (F.col("n") / (F.col("total") * width)).alias("density")))


def kde_curve(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth over the value range; see :func:`density_of_cells`."""
    rows = present(df, value).select(F.col(value).cast("double").alias("value"), F.lit(1).cast("long").alias("n"))
    limits = rows.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("total"),
                      F.stddev_samp("value").alias("std"))
    return density_of_cells(rows, limits, [], points)


def density_of_cells(cells: DataFrame, limits: DataFrame, by: Sequence[str], points: int) -> DataFrame:
    """(by, point, x, density) from weighted values (by, value, n) and ``limits`` (by, low, high, total, std).

    Values are first folded to bins BINS_PER_BANDWIDTH to a bandwidth h, each known by its count, mean
    and variance; with these the kernel sum is exact up to third moments within a bin, about
    (1 / BINS_PER_BANDWIDTH)^3 / 40 of the kernel's height, so seven digits. A bin reaches only the grid points
    within REACH bandwidths, so bins x reached points does not grow with the rows or as h shrinks.
    """
    by = list(by)
    usable = limits.where("std > 0").select(
        *by, F.col("low").alias("_low"), F.col("total").alias("_total"),
        (F.col("std") * F.pow(F.col("total").cast("double"), F.lit(-0.2))).alias("_h"),
        ((F.col("high") - F.col("low")) / F.lit(float(points - 1))).alias("_step"))
    if by:
        placed = join_on(cells, usable, by, small=True)
    else:
        names = ("_low", "_total", "_h", "_step")
        placed = cells.withColumn("_u", usable.select(F.struct(*names).alias("u")).scalar()).where("_u is not null").select(
            *cells.columns, *[F.col(f"_u.{c}").alias(c) for c in names])
    slot = F.floor((F.col("value") - F.col("_low")) / F.col("_h") * BINS_PER_BANDWIDTH)
    # values are taken from the bin's low edge, so that squares do not cancel
    off = F.col("value") - F.col("_low") - F.col("slot") * F.col("_h") / BINS_PER_BANDWIDTH
    n = F.col("n").cast("double")
    mass = (placed.withColumn("slot", slot).withColumn("off", off)
            .groupBy(*by, "slot", "_low", "_total", "_h", "_step").agg(
                F.sum(n).alias("m"), (F.sum(n * F.col("off")) / F.sum(n)).alias("mid"), F.sum(n * F.col("off") * F.col("off")).alias("square")))
    centre = F.col("_low") + F.col("slot") * F.col("_h") / BINS_PER_BANDWIDTH + F.col("mid")
    spread = F.greatest(F.lit(0.0), F.col("square") / F.col("m") - F.col("mid") * F.col("mid"))
    at = (F.col("centre") - F.col("_low")) / F.col("_step")
    far = F.lit(REACH) * F.col("_h") / F.col("_step")
    low = F.greatest(F.lit(0).cast("long"), F.ceil(at - far))
    high = F.least(F.lit(points - 1).cast("long"), F.floor(at + far))
    reached = (mass.withColumn("centre", centre).withColumn("v2", spread / (F.col("_h") * F.col("_h")))
               .withColumn("from", low).withColumn("to", high).where(F.col("from") <= F.col("to"))
               .withColumn("point", F.explode(F.sequence("from", "to"))))
    z = (F.col("_low") + F.col("point") * F.col("_step") - F.col("centre")) / F.col("_h")
    kernel = F.col("m") * norm_pdf(F.col("z")) * (1.0 + (F.col("z") * F.col("z") - 1.0) * F.col("v2") / 2.0)
    sums = reached.withColumn("z", z).groupBy(*by, "point").agg(F.sum(kernel).alias("k"))
    every = usable.withColumn("point", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    met = join_on(every, sums, [*by, "point"], "left")
    return met.select(*by, "point", (F.col("_low") + F.col("point") * F.col("_step")).alias("x"),
                      (F.coalesce("k", F.lit(0.0)) / (F.col("_total") * F.col("_h"))).alias("density"))


def boxplot(df: DataFrame, value: str, by: Sequence[str], width: float = 1.5) -> DataFrame:
    """Quartiles and whiskers (furthest value within width*iqr of the box) per group."""
    by = list(by)
    rows = present(df, value).select(*by, F.col(value).cast("double").alias("v"))
    q = quantiles(rows, "v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    placed = lookup(rows, q, by, "n_values", "inner", nulls=True)  # groups are mostly few: rows stay where they are
    return box_of_cells(placed.withColumnsRenamed({"v": "value"}).withColumn("n", F.lit(1).cast("long")), "value", "n", by, width)


def box_of_cells(placed: DataFrame, value: str, weight: str, by: Sequence[str], width: float = 1.5) -> DataFrame:
    """Box plots from weighted values that carry their group's q1, median, q3 and n_values; partial aggregates only."""
    v, iqr = F.col(value), F.col("q3") - F.col("q1")
    inside = (v >= F.col("q1") - F.lit(width) * iqr) & (v <= F.col("q3") + F.lit(width) * iqr)
    return (placed.groupBy(*by)
            .agg(F.first("n_values").alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
                 F.first("q3").alias("q3"), F.min(F.when(inside, v)).alias("whisker_low"),
                 F.max(F.when(inside, v)).alias("whisker_high"),
                 F.sum(F.when(inside, 0).otherwise(F.col(weight))).alias("n_fliers")))


def binned_scatter(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Counts on a bins x bins grid, the scatter plot of a table too large to draw."""
    rows = present(df, x, y).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    k = F.lit(bins).cast("long")
    return (rows.withColumn("lx", _limits(rows, "x")).withColumn("ly", _limits(rows, "y"))
            .groupBy(_slot(F.col("x"), F.col("lx.low"), F.col("lx.high"), k).alias("x_bin"),
                     _slot(F.col("y"), F.col("ly.low"), F.col("ly.high"), k).alias("y_bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean_x"), F.avg("y").alias("mean_y")))
