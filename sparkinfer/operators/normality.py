"""Normality tests: Shapiro-Wilk on a bounded sample, Kolmogorov-Smirnov on any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkinfer.functions.normal import norm_cdf, norm_pdf, norm_ppf, norm_sf, polynomial
from sparkinfer.functions.scalars import number, present
from sparkinfer.functions.tails import SW_LAST, SW_NEXT, ks_sf, shapiro_sf
from sparkinfer.operators.describe import melt
from sparkinfer.operators.joins import join_on, with_group
from sparkinfer.operators.ranks import Layout, cumulative_counts, probe, value_counts
from sparkinfer.operators.sampling import seeded_sample

SHAPIRO_LIMIT = 5000
# P. Royston, "A toolkit for testing non-normality", 1993: mean and deviation of ln(1 - W').
FRANCIA_MEAN, FRANCIA_STD = (-1.2725, 1.0521), (1.0308, -0.26758)
FRANCIA_LEAST = 5
#: Places at both ends of a run of tied values whose normal scores are summed one by one.
EDGE = 16


def shapiro_of_sample(sample: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Shapiro-Wilk W (Royston's approximation) of an already bounded sample."""
    by = list(by)
    order = Window.partitionBy(*by).orderBy("x")
    whole = Window.partitionBy(*by)
    placed = (present(sample, value).select(*by, F.col(value).cast("double").alias("x"))
              .withColumn("i", F.row_number().over(order))
              .withColumn("n", F.count(F.lit(1)).over(whole)))
    scored = (placed.withColumn("at", (F.col("i") - F.lit(0.375)) / (F.col("n") + F.lit(0.25)))
              .withColumn("m", norm_ppf(F.col("at"))))

    def at(i, what):
        return F.max(F.when(F.col("i") == i, F.col(what)))

    n_rows = F.col("n")
    folded = scored.groupBy(*by).agg(
        F.max("n").alias("n"), F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.sum(F.col("m") * F.col("x")).alias("mx"), F.var_pop("x").alias("variance"),
        at(F.lit(1), "x").alias("x1"), at(F.lit(2), "x").alias("x2"),
        at(n_rows - 1, "x").alias("y2"), at(n_rows, "x").alias("y1"),
        at(n_rows, "m").alias("m1"), at(n_rows - 1, "m").alias("m2"))
    n = F.col("n").cast("double")
    u, scale = F.col("u"), F.col("scale")
    staged = (folded.withColumn("u", F.lit(1.0) / F.sqrt(n))
              .withColumn("scale", F.sqrt(F.nullif(F.col("mm"), F.lit(0.0))))
              .withColumn("a1", polynomial(u, (*SW_LAST, 0.0)) + F.col("m1") / scale)
              .withColumn("a2", F.when(n > 5, polynomial(u, (*SW_NEXT, 0.0)) + F.col("m2") / scale))
              .withColumn("wide", F.col("y1") - F.col("x1"))
              .withColumn("next", F.col("y2") - F.col("x2")))
    a1, a2, m1, m2 = (F.col(c) for c in ("a1", "a2", "m1", "m2"))
    long_phi = (F.col("mm") - 2 * m1 * m1 - 2 * m2 * m2) / (F.lit(1.0) - 2 * a1 * a1 - 2 * a2 * a2)
    short_phi = (F.col("mm") - 2 * m1 * m1) / (F.lit(1.0) - 2 * a1 * a1)
    phi = F.when(n > 5, long_phi).when(n > 3, short_phi)
    rest = F.col("mx") - m1 * F.col("wide") - F.when(n > 5, m2 * F.col("next")).otherwise(F.lit(0.0))
    inner = (a1 * F.col("wide") + F.when(n > 5, a2 * F.col("next")).otherwise(F.lit(0.0))
             + rest / F.sqrt(phi))
    numerator = F.when(n == 3, F.sqrt(F.lit(0.5)) * F.col("wide")).otherwise(inner)
    final = staged.withColumn("numerator", numerator).withColumn(
        "w", F.col("numerator") * F.col("numerator") / F.nullif(F.col("variance") * n, F.lit(0.0)))
    ok = (n >= 3) & (F.col("variance") > 0)
    w = F.col("w")
    return (final.select(*by, "n", F.when(ok, F.least(F.lit(1.0), w)).alias("statistic"),
                          F.when(F.col("n") < 3, "too few rows").when(~ok, "degenerate")
                          .otherwise("ok").alias("status"))
            .withColumn("p_value", shapiro_sf(F.col("statistic"), F.col("n"))))


def shapiro_wilk(df: DataFrame, value: str, keys: Sequence[str], by: Sequence[str] = (),
                 size: int = SHAPIRO_LIMIT, seed: int | None = None) -> DataFrame:
    """Shapiro-Wilk on a seeded sample of at most ``size`` rows per group; ``n_total`` rows have a value."""
    by, rows = list(by), present(df, value)
    tested = shapiro_of_sample(seeded_sample(rows, keys, size, seed, by), value, by)
    total = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_total"))
    if by:
        return join_on(tested, total, by, "left")
    return tested.withColumn("n_total", total.select("n_total").scalar())


def ks_normal(df: DataFrame, value: str, by: Sequence[str] = (), layout: Layout | None = None) -> DataFrame:
    """Kolmogorov-Smirnov distance of the standardised values from N(0, 1)."""
    by = list(by)
    rows = present(df, value)
    layout = layout or probe(rows, value, by)
    placed = cumulative_counts(value_counts(rows, value, by), by, layout)
    if layout.small:  # the cells of a group already share a window partition
        group, n = Window.partitionBy(*by), F.col("n").cast("double")
        shifted = placed.withColumn("mean", F.sum(n * F.col("value")).over(group) / F.col("total"))
        gap = F.col("value") - F.col("mean")
        spread = F.sum(n * gap * gap).over(group) / F.nullif(F.col("total") - 1, F.lit(0))
        scaled = shifted.withColumn("std", F.sqrt(spread))
    else:
        scaled = with_group(placed, by, source=rows, mean=F.avg(number(value)),
                            std=F.stddev_samp(number(value)))
    return ks_of_positions(scaled, by)


def ks_of_positions(scaled: DataFrame, by: Sequence[str]) -> DataFrame:
    """The test from cells with running positions (value, cum_le, tied, total) and the group's mean and std."""
    z = (F.col("value") - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))
    size = F.col("total").cast("double")
    # the CDF is a column of its own so that both distances share one evaluation
    at = scaled.withColumn("z", z).withColumn("cdf", norm_cdf(F.col("z")))
    distance = F.greatest(F.col("cum_le") / size - F.col("cdf"),
                          F.col("cdf") - (F.col("cum_le") - F.col("tied")) / size)
    out = at.groupBy(*by).agg(F.coalesce(F.max("total"), F.lit(0)).alias("n"),
                              F.max(distance).alias("statistic"))
    return (out.withColumn("status", F.when(F.col("n") < 2, "too few rows")
                           .when(F.col("statistic").isNull(), "degenerate").otherwise("ok"))
            .withColumn("p_value", ks_sf(F.col("statistic"), F.col("n"))))


def shapiro_francia(df: DataFrame, value: str, by: Sequence[str] = (), layout: Layout | None = None) -> DataFrame:
    """Shapiro-Francia W' over all rows: (by, n, statistic, p_value, status).

    The squared correlation of the ordered values with normal scores at (i - 3/8) / (n + 1/4). A value
    meets the sum of the scores of the places it holds, so counted and ranked cells are enough and
    no sample is drawn. The p-value follows Royston's normalisation, which is fitted up to n = 5,000 and
    extrapolates beyond.
    """
    by = list(by)
    rows = present(df, value)
    placed = cumulative_counts(value_counts(rows, value, by), by, layout or probe(rows, value, by))
    return francia_of_positions(placed, by)


def _runs(first: Column, last: Column) -> Column:
    """The places first..last as structs (a, b): EDGE single places at both ends, and what is between them as one run."""
    def single(a, b):
        none = F.array().cast("array<bigint>")
        return F.transform(F.when(a <= b, F.sequence(a, F.greatest(a, b))).otherwise(none), lambda i: F.struct(i.alias("a"), i.alias("b")))

    run = F.struct((first + EDGE).alias("a"), (last - EDGE).alias("b"))
    between = F.when(last - first >= 2 * EDGE, F.array(run)).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))
    return F.concat(single(first, F.least(last, first + (EDGE - 1))), single(F.greatest(first + EDGE, last - (EDGE - 1)), last), between)


def francia_of_positions(placed: DataFrame, by: Sequence[str]) -> DataFrame:
    """The test from cells with running positions (by, value, n, cum_le, total).

    A run of tied places is summed by antiderivatives of the scores (minus the density) and of their squares
    (cdf - z density), with the first end correction; a value of any number of rows is at most
    2 EDGE + 1 terms.
    """
    n = F.col("n").cast("double")
    centred = with_group(placed, by, mean=F.sum(n * F.col("value")) / F.sum(n))
    terms = centred.select(*by, "total", n.alias("n"), (F.col("value") - F.col("mean")).alias("gap"),
                           F.explode(_runs(F.col("cum_le") - F.col("n") + 1, F.col("cum_le"))).alias("r"),
                           (F.col("total") + F.lit(0.25)).alias("size")).select("*", "r.a", "r.b")
    alone = F.col("a") == F.col("b")
    ends = terms.withColumn("p1", (F.col("a") - F.when(alone, F.lit(0.375)).otherwise(F.lit(0.875))) / F.col("size")).withColumn(
        "p2", F.when(~alone, (F.col("b") + F.lit(0.125)) / F.col("size")))
    # each score is a column of its own: what follows reads it many times
    z = ends.withColumn("z1", norm_ppf(F.col("p1"))).withColumn("z2", norm_ppf(F.col("p2")))
    dense = z.withColumn("d1", norm_pdf(F.col("z1"))).withColumn("d2", norm_pdf(F.col("z2")))
    z1, z2, d1, d2, size = (F.col(c) for c in ("z1", "z2", "d1", "d2", "size"))
    score = F.when(alone, z1).otherwise(size * (d1 - d2) - (1.0 / d2 - 1.0 / d1) / size / 24.0)
    square = F.when(alone, z1 * z1).otherwise(
        size * ((F.col("p2") - z2 * d2) - (F.col("p1") - z1 * d1)) - 2.0 * (z2 / d2 - z1 / d1) / size / 24.0)
    scored = dense.withColumn("score", score).withColumn("square", square)
    sums = scored.groupBy(*by).agg(F.coalesce(F.max("total"), F.lit(0)).alias("n"), F.sum(F.col("score") * F.col("gap")).alias("mx"),
                                   F.sum("square").alias("mm"))
    spread = centred.groupBy(*by).agg(F.sum(n * F.pow(F.col("value") - F.col("mean"), 2)).alias("xx"))
    sums = join_on(sums, spread, by) if by else sums.withColumn("xx", spread.select("xx").scalar())
    ok = (F.col("n") >= FRANCIA_LEAST) & (F.col("xx") > 0)
    w = F.least(F.lit(1.0), F.col("mx") * F.col("mx") / F.nullif(F.col("xx"), F.lit(0.0)) / F.nullif(F.col("mm"), F.lit(0.0)))
    u = F.ln(F.greatest(F.col("n").cast("double"), F.lit(2.0)))
    v = F.ln(u)
    tested = (F.ln(F.when(F.col("statistic") < 1, F.lit(1.0) - F.col("statistic"))) - (FRANCIA_MEAN[0] + FRANCIA_MEAN[1] * (v - u))) / (
        FRANCIA_STD[0] + FRANCIA_STD[1] * (v + 2.0 / u))
    out = sums.select(*by, "n", F.when(ok, w).alias("statistic"),
                      F.when(F.col("n") < FRANCIA_LEAST, "too few rows").when(~ok, "degenerate").otherwise("ok").alias("status"))
    out = out.withColumn("z", tested)
    return out.withColumn("p_value", F.when(F.col("status") == "ok", F.coalesce(norm_sf(F.col("z")), F.lit(1.0)))).drop("z")


def normality(df: DataFrame, columns: Sequence[str], keys: Sequence[str],
              size: int = SHAPIRO_LIMIT, seed: int | None = None, alpha: float = 0.05,
              distances: DataFrame | None = None) -> DataFrame:
    """Both tests, one output row per column; ``distances`` are given where cells have been counted.

    Kolmogorov-Smirnov is over all ``n`` rows with a value; Shapiro-Wilk, which is only
    defined for small samples, over the ``n_sampled`` of one seeded sample of rows.
    """
    sample = seeded_sample(df, keys, size, seed)
    w = shapiro_of_sample(melt(sample, columns), "value", ["column"]).select(
        "column", F.col("n").alias("n_sampled"), F.col("statistic").alias("shapiro_w"), F.col("p_value").alias("shapiro_p"), "status")
    found = ks_normal(melt(df, columns), "value", ["column"]) if distances is None else distances
    d = found.select(
        F.col("column").alias("c"), "n", F.col("statistic").alias("ks_d"), F.col("p_value").alias("ks_p"))
    joined = w.join(d, w["column"] == d["c"], "left").drop("c")
    smaller = F.least("shapiro_p", "ks_p")
    return joined.withColumn("verdict", F.when(smaller.isNull(), "not testable")
                             .when(smaller < alpha, "not normal").otherwise("compatible with normal"))
