"""Hypothesis tests. Every test takes ``by`` and tests all groups in one job.

Results carry ``status``: ``ok``, ``degenerate`` (no variation) or ``too few rows``;
p-values and statistics are NULL unless the status is ``ok``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkinfer.functions.effects import effect_label, kruskal_eta2, rank_biserial, stars
from sparkinfer.functions.normal import norm_sf
from sparkinfer.functions.scalars import number, present
from sparkinfer.functions.tails import ALTERNATIVES, chi2_sf, f_sf, t_p_value
from sparkinfer.operators.cells import count_cells
from sparkinfer.operators.joins import attach, join_on, with_group
from sparkinfer.operators.ranks import Layout, probe, rank_cells, value_counts, whole_groups
from sparkinfer.sources.landing import cut


# Rows of a group up to which the distribution of U is counted out.
EXACT_ROWS = 40


def _status(enough: Column, varied: Column) -> Column:
    return (F.when(~F.coalesce(enough, F.lit(False)), "too few rows")
            .when(~F.coalesce(varied, F.lit(False)), "degenerate").otherwise("ok"))


def _over(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator.cast("double"), F.lit(0.0))


def _two_samples(df: DataFrame, value: str, group: str, first, second, by) -> DataFrame:
    """The rows of two levels, reduced to (by, value, is_first)."""
    return present(df, value).where(F.col(group).isin([first, second])).select(
        *by, F.col(value).cast("double").alias("value"), (F.col(group) == F.lit(first)).alias("is_first"))


def welch_t(df: DataFrame, value: str, group: str, first, second, by: Sequence[str] = (),
            alternative: str = "two-sided") -> DataFrame:
    """Welch's t-test of two levels, unequal variances; 'greater' means first > second."""
    rows = _two_samples(df, value, group, first, second, by)
    one, two = F.when(F.col("is_first"), F.col("value")), F.when(~F.col("is_first"), F.col("value"))
    folded = rows.groupBy(*by).agg(
        F.count(one).alias("n1"), F.count(two).alias("n2"), F.avg(one).alias("mean1"),
        F.avg(two).alias("mean2"), F.var_samp(one).alias("v1"), F.var_samp(two).alias("v2"))
    e1, e2 = _over(F.col("v1"), F.col("n1")), _over(F.col("v2"), F.col("n2"))
    enough = (F.col("n1") > 1) & (F.col("n2") > 1)
    varied = e1 + e2 > 0  # one constant sample is no obstacle
    ok = enough & varied
    stat = F.when(ok, _over(F.col("mean1") - F.col("mean2"), F.sqrt(e1 + e2)))
    freedom = F.when(ok, _over((e1 + e2) * (e1 + e2),
                               _over(e1 * e1, F.col("n1") - 1) + _over(e2 * e2, F.col("n2") - 1)))
    return (folded.select(*by, "n1", "n2", "mean1", "mean2", stat.alias("statistic"),
                          freedom.alias("df"),
                          _status(enough, varied).alias("status"))
            .withColumn("p_value", t_p_value(F.col("statistic"), F.col("df"), alternative)))


def mann_whitney(df: DataFrame, value: str, group: str, first, second, by: Sequence[str] = (),
                 alternative: str = "two-sided", layout: Layout | None = None) -> DataFrame:
    """Mann-Whitney U of the first level, normal approximation with ties and continuity."""
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}, not {alternative!r}")
    rows = _two_samples(df, value, group, first, second, by)
    cells = cut(value_counts(rows, "value", by, ["is_first"]))  # the source is read once
    ranked = rank_cells(cells, by, layout or probe(cells, "value", by))
    return u_test(ranked, "is_first", by, alternative)


def u_distribution(n1: int, n2: int) -> np.ndarray:
    """Probability of each U from 0 to n1 n2 without ties: orders are counted by their last member."""
    ways = np.zeros(n1 * n2 + 1)
    ways[0] = 1.0
    # the generating function is the product of (1 - x^(n2 + i)) / (1 - x^i), i = 1..n1
    for i in range(1, n1 + 1):
        up = n2 + i
        if up < len(ways):
            ways[up:] = ways[up:] - ways[:-up]
        for j in range(i, len(ways)):
            ways[j] += ways[j - i]
    return ways / ways.sum()


def mann_whitney_exact(df: DataFrame, value: str, group: str, first, second, by: Sequence[str] = (),
                       alternative: str = "two-sided", most: int = EXACT_ROWS) -> DataFrame:
    """Mann-Whitney U of the first level with the exact distribution of U where it holds.

    A group with no ties and at most ``most`` rows has ``method`` exact; the others keep the normal
    approximation, and say so. The two-sided p-value is twice the smaller tail. Only result rows meet Python.
    """
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}, not {alternative!r}")
    rows = _two_samples(df, value, group, first, second, by)
    dealt = whole_groups(rows, by) if by else None
    if dealt is not None:  # small groups: each is ordered in its task, in one shuffle
        ranked = rank_cells(dealt.withColumn("n", F.lit(1).cast("long")), by, Layout(True))
    else:
        cells = cut(value_counts(rows, "value", by, ["is_first"]))
        ranked = rank_cells(cells, by, probe(cells, "value", by))
    t = F.col("tied").cast("double")
    found = u_test(ranked, "is_first", by, alternative, tie_sum=F.sum(F.col("n") * (t * t - 1)))
    fit = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("tie_sum") == 0) & (F.col("n1") + F.col("n2") <= most)

    @F.pandas_udf("double")
    def tail(n1: pd.Series, n2: pd.Series, u: pd.Series) -> pd.Series:
        known, out = {}, []
        for a, b, x in zip(n1, n2, u, strict=True):
            if x is None or np.isnan(x):
                out.append(None)
                continue
            if (a, b) not in known:
                known[a, b] = np.cumsum(u_distribution(int(a), int(b)))
            upto = known[a, b]
            x = int(round(x))
            less, greater = upto[x], 1.0 - (upto[x - 1] if x else 0.0)
            out.append(float({"less": less, "greater": greater, "two-sided": min(1.0, 2 * min(less, greater))}[alternative]))
        return pd.Series(out, dtype="float64")

    marked = found.withColumn("method", F.when(fit, "exact").otherwise("normal"))
    exact = tail("n1", "n2", F.when(fit, F.col("statistic")))
    return marked.withColumn("p_value", F.when(fit, exact).otherwise(F.col("p_value"))).withColumn(
        "status", F.when(fit, F.lit("ok")).otherwise(F.col("status"))).drop("tie_sum")


def u_test(ranked: DataFrame, first: str, by: Sequence[str] = (), alternative: str = "two-sided",
           **summaries: Column) -> DataFrame:
    """Mann-Whitney from ranked cells (first, n, tied, avg_rank); ``summaries`` are added."""
    n, t = F.col("n").cast("double"), F.col("tied").cast("double")
    folded = ranked.groupBy(*by).agg(
        F.sum(F.when(F.col(first), F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(~F.col(first), F.col("n")).otherwise(0)).alias("n2"),
        F.sum(F.when(F.col(first), n * F.col("avg_rank")).otherwise(0.0)).alias("rank_sum"),
        F.sum(n * (t * t - 1)).alias("ties"), *[c.alias(a) for a, c in summaries.items()])
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    size = n1 + n2
    u1 = F.col("rank_sum") - n1 * (n1 + 1) / 2
    variance = n1 * n2 / 12 * ((size + 1) - _over(F.col("ties"), size * (size - 1)))
    enough = (n1 > 0) & (n2 > 0)
    moved = folded.select(*by, F.coalesce("n1", F.lit(0)).alias("n1"),
                          F.coalesce("n2", F.lit(0)).alias("n2"), F.when(enough, u1).alias("statistic"),
                          variance.alias("variance"), enough.alias("enough"), *summaries)
    u, pairs = F.col("statistic"), n1 * n2
    tail = {"two-sided": F.greatest(u, pairs - u), "greater": u, "less": pairs - u}[alternative]
    z = _over(tail - pairs / 2 - 0.5, F.sqrt(F.when(F.col("variance") > 0, F.col("variance"))))
    # z and the effect are columns of their own: the formulas below read them many times
    scored = moved.withColumn("z", z).withColumn("effect", rank_biserial(u, F.col("n1"), F.col("n2")))
    p = norm_sf(F.col("z")) * (2.0 if alternative == "two-sided" else 1.0)
    return scored.select(*by, "n1", "n2", *summaries, "statistic", "effect",
                         effect_label(F.col("effect"), "r").alias("effect_label"),
                         F.when(F.col("z").isNotNull(), F.least(p, F.lit(1.0))).alias("p_value"),
                         _status(F.col("enough"), F.col("variance") > 0).alias("status"))


def anova_oneway(df: DataFrame, value: str, group: str, by: Sequence[str] = ()) -> DataFrame:
    """One-way ANOVA over all levels with at least two rows."""
    by = list(by)
    levels = (present(df, value, group).groupBy(*by, group)
              .agg(F.count(F.lit(1)).alias("m"), F.avg(number(value)).alias("mean"),
                   F.var_samp(number(value)).alias("variance"))
              .where(F.col("m") > 1))
    centred = with_group(levels, by, grand=_over(F.sum(F.col("m") * F.col("mean")), F.sum("m")))
    shift = F.col("mean") - F.col("grand")
    folded = centred.groupBy(*by).agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("n_groups"),
        F.sum(F.col("m") * shift * shift).alias("between"),
        F.sum((F.col("m") - 1) * F.col("variance")).alias("within"))
    df1, df2 = F.col("n_groups") - 1, F.col("n") - F.col("n_groups")
    enough = (df1 > 0) & (df2 > 0)
    stat = F.when(enough, _over(_over(F.col("between"), df1), _over(F.col("within"), df2)))
    return (folded.select(*by, "n", "n_groups", stat.alias("statistic"), df1.alias("df1"),
                          df2.alias("df2"), _status(enough, F.col("within") > 0).alias("status"))
            .withColumn("p_value", f_sf(F.col("statistic"), F.col("df1"), F.col("df2"))))


def kruskal_wallis(df: DataFrame, value: str, group: str, by: Sequence[str] = ()) -> DataFrame:
    """Kruskal-Wallis H with tie correction over all levels with at least two rows."""
    by = list(by)
    rows = df.where(F.col(group).isNotNull())
    cells = cut(value_counts(rows, value, by, [group]))
    sizes = cells.groupBy(*by, group).agg(F.sum("n").alias("level_rows")).where(F.col("level_rows") > 1)
    kept = join_on(cells, sizes.drop("level_rows"), [*by, group], "left_semi")
    ranked = rank_cells(kept, by, probe(cells, "value", [*by, group]))
    n, t = F.col("n").cast("double"), F.col("tied").cast("double")
    # ranks are centred on the overall mean rank before they are summed
    offset = F.col("avg_rank") - (F.col("total") + 1) / 2.0
    levels = ranked.groupBy(*by, group).agg(
        F.sum("n").alias("m"), F.sum(n * offset).alias("shift"), F.sum(n * (t * t - 1)).alias("ties"))
    return h_test(levels, by)


def h_test(levels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Kruskal-Wallis from one row a level: rows ``m``, sum of centred ranks ``shift``, share of the tie sum ``ties``."""
    folded = levels.groupBy(*by).agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("n_groups"),
        F.sum(F.col("shift") * F.col("shift") / F.col("m")).alias("spread"),
        F.sum("ties").alias("ties"))
    size = F.col("n").cast("double")
    correction = F.lit(1.0) - _over(F.col("ties"), size * size * size - size)
    enough = F.col("n_groups") > 1
    stat = F.when(enough & (correction > 0),
                  _over(_over(F.lit(12.0) * F.col("spread"), size * (size + 1)), correction))
    out = folded.select(*by, "n", "n_groups", stat.alias("statistic"),
                        (F.col("n_groups") - 1).alias("df"), _status(enough, correction > 0).alias("status"))
    eta = F.when(F.col("status") == "ok", kruskal_eta2(F.col("statistic"), F.col("n_groups"), F.col("n")))
    return (out.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("df")))
            .withColumn("effect", eta).withColumn("effect_label", effect_label(F.col("effect"), "eta2")))


def _correlation_p(rho: Column, n: Column) -> Column:
    freedom = n - 2
    room = F.lit(1.0) - rho * rho
    t = rho * F.sqrt(F.when(room > 0, freedom / F.nullif(room, F.lit(0.0))))
    exact = F.when((freedom > 0) & (F.abs(rho) >= 1.0), F.lit(0.0))
    return F.coalesce(exact, t_p_value(F.when(freedom > 0, t), freedom))


def _attach_ranks(rows: DataFrame, values: DataFrame, key: str, by: list[str], layout,
                  weight: str) -> DataFrame:
    """Add the centred average rank ``r<key>`` of column ``key`` to every row.

    ``values`` counts the distinct values. When they are few the rank table is small, which
    the probe has measured, and is broadcast; otherwise hot values are taken out of the shuffle.
    """
    table = rank_cells(values, by, layout).select(
        *by, F.col("value").alias(key), F.col(weight).alias("weight"),
        (F.col("avg_rank") - (F.col("total") + 1) / 2.0).alias(f"r{key}"))
    if layout.small:
        return rows.join(F.broadcast(table.drop("weight")), [*by, key])
    return attach(rows, table, [*by, key], "weight", "inner").drop("weight")


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Spearman rank correlation of a pair over its complete rows.

    Rows are first folded to distinct (x, y) pairs, which are stored. Each side's ranks are then
    attached by value; values holding many pairs are handled as hot keys.
    """
    by = list(by)
    pairs = (present(df, x, y, *by).select(*by, F.col(x).cast("double").alias("x"),
                                           F.col(y).cast("double").alias("y"))
             .groupBy(*by, "x", "y").agg(F.count(F.lit(1)).alias("m")))
    rows = pairs = cut(pairs)
    for side in ("x", "y"):
        values = pairs.groupBy(*by, F.col(side).alias("value")).agg(
            F.sum("m").alias("n"), F.count(F.lit(1)).alias("pairs"))
        rows = _attach_ranks(rows, values, side, by, probe(pairs, side, by), "pairs")
    m, rx, ry = F.col("m"), F.col("rx"), F.col("ry")
    folded = rows.groupBy(*by).agg(
        F.coalesce(F.sum("m"), F.lit(0)).alias("n"), F.sum(m * rx * ry).alias("sxy"),
        F.sum(m * rx * rx).alias("sxx"), F.sum(m * ry * ry).alias("syy"))
    varied = (F.col("sxx") > 0) & (F.col("syy") > 0)
    rho = F.when(varied, F.col("sxy") / F.sqrt(F.col("sxx")) / F.sqrt(F.col("syy")))
    rho = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho))
    out = folded.select(*by, "n", F.when(varied, rho).alias("rho"),
                        _status(F.col("n") > 1, varied).alias("status"))
    return out.withColumn("p_value", _correlation_p(F.col("rho"), F.col("n")))


def spearman_matrix(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All pairwise Spearman correlations over the rows complete in every column, per group.

    Long output (by, a, b, n, rho, p_value, stars, cell); each column is ranked once, and the
    columns are stored first, so that ``df`` is read once.
    """
    columns, by = list(columns), list(by)
    base = present(df, *columns, *by).select(*by, *[F.col(c).cast("double").alias(f"v{i}")
                                                    for i, c in enumerate(columns)])
    rows = base = cut(base)
    names = [f"v{i}" for i in range(len(columns))]
    if not by:  # one count of all columns, one probe, one order
        return spearman_of_ranks(count_cells(base, names).with_ranks(base, names), columns, [f"rank_{v}" for v in names])
    for i in range(len(columns)):
        rows = _attach_ranks(rows, value_counts(base, f"v{i}", by), f"v{i}", by, probe(base, f"v{i}", by), "n")
    return spearman_of_ranks(rows, columns, [f"rv{i}" for i in range(len(columns))], by)


def spearman_of_ranks(rows: DataFrame, columns: Sequence[str], ranks: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The correlation matrix of :func:`spearman_matrix` from centred average ranks, in one aggregation."""
    by = list(by)
    rows = rows.select(*by, *[F.col(r).alias(f"rv{i}") for i, r in enumerate(ranks)])
    k = range(len(columns))
    folded = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                      *[F.sum(F.col(f"rv{i}") * F.col(f"rv{j}")).alias(f"s{i}_{j}")
                        for i in k for j in k if i <= j])
    cells = []
    for i in k:
        for j in k:
            lo, hi = min(i, j), max(i, j)
            varied = (F.col(f"s{i}_{i}") > 0) & (F.col(f"s{j}_{j}") > 0)
            rho = F.when(varied, F.col(f"s{lo}_{hi}") / F.sqrt(F.col(f"s{i}_{i}")) / F.sqrt(F.col(f"s{j}_{j}")))
            if i == j:
                rho = F.lit(1.0)
            cells.append(F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"),
                                  F.when(rho.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho)))
                                  .alias("rho")))
    long = folded.select(*by, "n", F.explode(F.array(*cells)).alias("r")).select(*by, "r.a", "r.b", "n", "r.rho")
    diagonal = F.col("a") == F.col("b")
    out = long.withColumn("p_value", F.when(diagonal, F.lit(0.0)).otherwise(_correlation_p(F.col("rho"), F.col("n"))))
    mark = F.when(diagonal, F.lit("")).otherwise(stars(F.col("p_value")))
    return (out.withColumn("stars", mark)
            .withColumn("cell", F.when(F.col("rho").isNull(), F.lit("undef."))
                        .when(diagonal, F.lit("1.0"))
                        .otherwise(F.concat(F.format_string("%.3f", "rho"), F.col("stars")))))


def simple_regression(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line y ~ x with a test of the slope, in one aggregation."""
    rows = present(df, y, x)
    cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
    folded = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(cx).alias("mx"), F.avg(cy).alias("my"),
        F.var_pop(cx).alias("vx"), F.var_pop(cy).alias("vy"), F.covar_pop(cx, cy).alias("cxy"))
    varied, enough = (F.col("vx") > 0) & (F.col("vy") > 0), F.col("n") > 2
    ok = varied & enough
    slope = F.when(ok, _over(F.col("cxy"), F.col("vx")))
    r2 = F.when(ok, _over(_over(F.col("cxy") * F.col("cxy"), F.col("vx")), F.col("vy")))
    residual = F.greatest(F.lit(0.0), F.col("vy") * (F.lit(1.0) - F.col("r2"))) * F.col("n")
    se = F.sqrt(_over(_over(residual, F.col("n") - 2), F.col("vx") * F.col("n")))
    return (folded.withColumn("slope", slope).withColumn("r2", r2)
            .select(*by, "n", "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"),
                    "r2", F.when(ok, se).alias("std_err"), F.when(ok, _over(F.col("slope"), se)).alias("statistic"),
                    (F.col("n") - 2).alias("df"), _status(enough, varied).alias("status"))
            .withColumn("p_value", t_p_value(F.col("statistic"), F.col("df"))))


__all__ = ["welch_t", "mann_whitney", "mann_whitney_exact", "anova_oneway", "kruskal_wallis", "spearman",
           "spearman_matrix", "simple_regression"]
