"""Ordinary least squares from one aggregation pass, with diagnostics.

The fact table is reduced to means and co-moments (k x k per group). Only those
rows meet NumPy, and they stay in executors: nothing is collected to solve. Diagnostics work on
rows with residuals; what they need of a fit is stored, so that no plan holds the fit twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField, StructType)

from sparkinfer.functions.normal import norm_ppf
from sparkinfer.functions.scalars import number, present
from sparkinfer.functions.tails import chi2_sf, t_p_value, t_ppf
from sparkinfer.operators.joins import lookup, with_group
from sparkinfer.operators.ranks import probe, rank_cells, value_counts
from sparkinfer.sources.landing import cut

INTERCEPT = "const"
ALIASED = 1e-9
VIF_ALERT = 5.0
#: Share of a column that earlier ones must leave unexplained, and R factors merged in one task.
ALIASED_QR = 1e-11
MERGED = 32


def co_moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count, means and population covariances of the complete cases, per group.

    Covariances are merged from partial ones (no raw sums of squares), so large
    offsets do not cancel.
    """
    rows = present(df, *columns)
    cols = [F.col(c).cast("double") for c in columns]
    k = range(len(cols))
    wide = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.covar_pop(cols[i], cols[j]).alias(f"c{i}_{j}") for i in k for j in k if i <= j])
    return wide.select(*by, "n", F.array(*[F.col(f"m{i}") for i in k]).alias("means"),
                       F.array(*[F.col(f"c{min(i, j)}_{max(i, j)}") for i in k for j in k]).alias("cov"))


def independent_columns(scatter: np.ndarray) -> list[int]:
    """Columns, in order, that are not constant and not combinations of earlier ones."""
    scale = np.sqrt(np.diag(scatter))
    kept: list[int] = []
    for j in range(len(scale)):
        if not scale[j] > 0:
            continue
        if kept:
            cross = scatter[kept, j] / scale[kept] / scale[j]
            inner = scatter[np.ix_(kept, kept)] / np.outer(scale[kept], scale[kept])
            if 1.0 - cross @ np.linalg.solve(inner, cross) < ALIASED:
                continue
        kept.append(j)
    return kept


def _fit_row(n: int, means: np.ndarray, cov: np.ndarray) -> dict | None:
    """Least squares of the last column on the others, from one row of co-moments."""
    k = len(means) - 1
    if n < 1:
        return None
    scatter = cov.reshape(k + 1, k + 1) * n
    sxx, sxy, tss = scatter[:k, :k], scatter[:k, k], float(scatter[k, k])
    kept = independent_columns(sxx)
    beta, se = np.full(k, np.nan), np.full(k, np.nan)
    spare = n - len(kept) - 1
    rss, se0, inverse = tss, np.nan, np.zeros((0, 0))
    if kept:
        scale = np.sqrt(np.diag(sxx))[kept]
        unit = np.linalg.inv(sxx[np.ix_(kept, kept)] / np.outer(scale, scale))
        inverse = unit / np.outer(scale, scale)
        beta[kept] = inverse @ sxy[kept]
        rss = max(0.0, tss - float(beta[kept] @ sxy[kept]))
    const = float(means[k] - means[kept] @ beta[kept])
    if spare > 0:
        variance = rss / spare
        se[kept] = np.sqrt(variance * np.diag(inverse))
        lever = means[kept] @ inverse @ means[kept] if kept else 0.0
        se0 = float(np.sqrt(variance * (1.0 / n + lever)))
    return {"coef": [const, *beta], "std_err": [se0, *se], "rank": len(kept), "rss": rss, "tss": tss,
            "df_resid": spare}


def _nullable(values) -> list:
    return [None if v is None or not np.isfinite(v) else float(v) for v in values]


@dataclass
class OlsFit:
    """Lazy results: ``solved`` has one row per group, the other tables derive from it."""

    solved: DataFrame
    terms: list[str]
    by: list[str]

    @property
    def coefficients(self) -> DataFrame:
        """(by, term, coef, std_err, statistic, p_value, ci_low, ci_high, status)."""
        cells = [F.struct(F.lit(i).alias("position"), F.lit(t).alias("term"),
                          F.get("coef", F.lit(i)).alias("coef"), F.get("std_err", F.lit(i)).alias("std_err"))
                 for i, t in enumerate(self.terms)]
        long = (self.solved.select(*self.by, "df_resid", F.explode(F.array(*cells)).alias("r"))
                .select(*self.by, "df_resid", "r.*"))
        t = F.col("coef") / F.nullif(F.col("std_err"), F.lit(0.0))
        reach = F.col("std_err") * F.col("quantile")
        return (long.withColumn("statistic", t)
                .withColumn("p_value", t_p_value(F.col("statistic"), F.col("df_resid")))
                .withColumn("quantile", t_ppf(F.lit(0.975), F.col("df_resid")))
                .select(*self.by, "position", "term", "coef", "std_err", "statistic", "p_value",
                        (F.col("coef") - reach).alias("ci_low"), (F.col("coef") + reach).alias("ci_high"),
                        F.when(F.col("coef").isNull(), "constant or collinear").otherwise("ok").alias("status")))

    @property
    def fit(self) -> DataFrame:
        """(by, n, rank, df_resid, rss, r2, r2_adj, sigma2, status)."""
        r2 = F.lit(1.0) - F.col("rss") / F.nullif(F.col("tss"), F.lit(0.0))
        n = F.col("n")
        spare = F.when(F.col("df_resid") > 0, F.col("df_resid"))
        full = F.col("rank") == F.lit(len(self.terms) - 1)
        return self.solved.select(*self.by, "n", "rank", "df_resid", "rss", "tss", r2.alias("r2"),
                                  (F.lit(1.0) - (F.lit(1.0) - r2) * (n - 1) / spare).alias("r2_adj"),
                                  (F.col("rss") / spare).alias("sigma2"),
                                  F.when(F.col("tss") <= 0, "degenerate").when(~full, "rank deficient")
                                  .otherwise("ok").alias("status"))

    @cached_property
    def known(self) -> DataFrame:
        """``solved``, stored when it is first used for prediction, so that no plan repeats the fit."""
        return cut(self.solved.select(*self.by, "n", "coef"))

    def predict(self, df: DataFrame, output: str = "predicted") -> DataFrame:
        """Add the fitted value; aliased terms contribute nothing, rows of a group without a fit get NULL.

        The coefficients of an ungrouped fit (one number a term) enter the expression as they
        are; those of groups are looked up, NULL being a group like any other.
        """
        xs = [F.col(t).cast("double") for t in self.terms[1:]]
        if not self.by:
            row = self.known.first()
            coef = row["coef"] if row else [None] * len(self.terms)
            total = F.lit(coef[0]).cast("double")
            for c, x in zip(coef[1:], xs, strict=True):
                if c is not None:
                    total = total + F.lit(float(c)) * x
                else:  # the term still has to be there, as for the fit
                    total = total + F.when(x.isNotNull(), F.lit(0.0))
            return df.withColumn(output, total)
        placed = lookup(df, self.known.withColumnsRenamed({"coef": "__coef", "n": "__n"}), self.by, "__n", nulls=True)
        total = F.get("__coef", F.lit(0))
        for i, x in enumerate(xs, start=1):
            total = total + F.coalesce(F.get("__coef", F.lit(i)), F.lit(0.0)) * x
        return placed.withColumn(output, total).drop("__coef", "__n")

    def residuals(self, df: DataFrame, y: str, output: str = "residual") -> DataFrame:
        """Add fitted value and residual to the complete cases of ``df``."""
        rows = self.predict(present(df, y, *self.terms[1:]))
        return rows.withColumn(output, F.col(y).cast("double") - F.col("predicted"))


def ols(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = ()) -> OlsFit:
    """Least squares of ``y`` on ``xs`` with an intercept, per group if ``by`` is given.

    Constant or collinear predictors are named in the coefficient table (no
    coefficient, status set) and the rest is fitted without them.
    """
    by, xs = list(by), list(xs)
    moments = co_moments(df, [*xs, y], by)
    keys = [f for f in moments.schema.fields if f.name in by]
    schema = StructType([*keys, StructField("n", LongType()),
                         StructField("coef", ArrayType(DoubleType())),
                         StructField("std_err", ArrayType(DoubleType())),
                         StructField("rank", LongType()), StructField("rss", DoubleType()),
                         StructField("tss", DoubleType()), StructField("df_resid", LongType())])
    names = schema.fieldNames()

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if row["n"] < 1:
                    continue
                got = _fit_row(int(row["n"]), np.asarray(row["means"], dtype=float),
                               np.asarray(row["cov"], dtype=float))
                got["coef"], got["std_err"] = _nullable(got["coef"]), _nullable(got["std_err"])
                out.append({**{k: row[k] for k in by}, "n": row["n"], **got})
            yield pd.DataFrame(out, columns=names)

    return OlsFit(moments.mapInPandas(solve, schema), [INTERCEPT, *xs], by)


def _triangle(block: np.ndarray, above: np.ndarray | None = None) -> np.ndarray:
    """The R factor of a block of rows below an earlier R factor."""
    return np.linalg.qr(block if above is None else np.vstack([above, block]), mode="r")


def _solve_triangle(r: np.ndarray, n: int) -> dict:
    """Least squares of the last column of R on the others; dependent columns are found one after another, first come first kept."""
    k = r.shape[1] - 1
    size = np.linalg.norm(r, axis=0)
    kept: list[int] = []
    for j in range(k):
        if not size[j] > 0:
            continue
        rest = r[:, j] / size[j]
        if kept:
            q, _ = np.linalg.qr(r[:, kept] / size[kept])
            rest = rest - q @ (q.T @ rest)
            rest = rest - q @ (q.T @ rest)
        if np.linalg.norm(rest) > ALIASED_QR:
            kept.append(j)
    coef, err = np.full(k, np.nan), np.full(k, np.nan)
    spare, rss = n - len(kept), float(r[:, k] @ r[:, k])
    if kept:
        small = np.linalg.qr(np.column_stack([r[:, kept] / size[kept], r[:, k]]), mode="r")
        m = len(kept)
        inverse = np.linalg.inv(small[:m, :m])
        coef[kept] = inverse @ small[:m, m] / size[kept]
        rss = float(small[m:, m] @ small[m:, m])
        if spare > 0:
            err[kept] = np.sqrt(rss / spare * np.square(inverse).sum(axis=1)) / size[kept]
    return {"coef": coef, "std_err": err, "rss": rss, "df_resid": spare}


def ols_qr(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Least squares by a tall-skinny QR, for designs whose columns are nearly dependent.

    Every task reduces its rows to one small R factor, and R factors are merged ``MERGED`` at a time
    until one is left, so no task sees more than its rows or that many factors. The cross products of
    :func:`ols` square the condition number of the design; R keeps it, so a design with condition 1e7
    loses 7 digits of 16, not 14. Output: (term, coef, std_err, n, df_resid, status); columns that depend on
    earlier ones are named and left out.
    """
    xs = list(xs)
    rows = present(df, y, *xs).select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*xs, y])])
    k = len(xs) + 2
    factor = "part long, n long, r binary"

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, n = None, 0
        for record in batches:
            block = np.column_stack([np.ones(record.num_rows), *[record.column(i).to_numpy() for i in range(k - 1)]])
            if len(block):
                r, n = _triangle(block, r), n + len(block)
        if r is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "n": [n], "r": [r.tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        whole = None
        for _, raw in sorted(zip(table.column("part").to_pylist(), table.column("r").to_pylist(), strict=True)):
            block = np.frombuffer(raw).reshape(-1, k)
            whole = block if whole is None else _triangle(block, whole)
        return pa.table({"part": pa.array([min(table.column("part").to_pylist())], pa.int64()),
                         "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()), "r": pa.array([whole.tobytes()], pa.binary())})

    factors = cut(rows.mapInArrow(reduce_rows, factor))
    last, step = factors.agg(F.max("part")).first()[0] or 0, 1
    while step <= last:
        step *= MERGED
        factors = factors.groupBy(F.floor(F.col("part") / step).alias("way")).applyInArrow(merge, factor)
    terms = [INTERCEPT, *xs]
    schema = StructType([StructField("position", LongType()), StructField("term", StringType()), StructField("coef", DoubleType()),
                         StructField("std_err", DoubleType()), StructField("n", LongType()), StructField("df_resid", LongType())])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, raw in zip(batch["n"], batch["r"], strict=True):
                got = _solve_triangle(np.frombuffer(raw).reshape(-1, k), int(n))
                yield pd.DataFrame({"position": range(k - 1), "term": terms, "coef": _nullable(got["coef"]),
                                    "std_err": _nullable(got["std_err"]), "n": int(n), "df_resid": got["df_resid"]})

    return factors.mapInPandas(solve, schema).withColumn(
        "status", F.when(F.col("coef").isNull(), "constant or collinear").otherwise("ok"))


def holdout_metrics(df: DataFrame, y: str, predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R-squared of predictions, in one aggregation."""
    gap = number(y) - number(predicted)
    known = F.when(gap.isNotNull(), number(y))
    return df.groupBy(*by).agg(F.count(gap).alias("n"), F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae"),
                               F.var_pop(known).alias("variance")).select(
        *by, "n", F.sqrt("mse").alias("rmse"), "mae",
        (F.lit(1.0) - F.col("mse") / F.nullif(F.col("variance"), F.lit(0.0))).alias("r2"))


def breusch_pagan(df: DataFrame, residual: str, xs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Koenker's studentised Breusch-Pagan test: n R^2 of squared residuals on the predictors."""
    squared = df.withColumn("__e2", number(residual) * number(residual))
    fit = ols(squared, "__e2", xs, by).fit
    out = fit.select(*by, "n", (F.col("n") * F.col("r2")).alias("statistic"), F.col("rank").alias("df"), "status")
    return out.withColumn("p_value", chi2_sf(F.col("statistic"), F.col("df")))


def durbin_watson(df: DataFrame, residual: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Durbin-Watson statistic of residuals in the stated, unique order, per group.

    Rows are range-partitioned by group and order key, so a group of any size spans tasks and
    many groups share one. A task returns one summary row for each group it meets (its sums, its
    first and its last residual); the summaries of a group are stitched across task borders.
    """
    by = list(by)
    keys = [f"__g{i}" for i in range(len(by))]
    ways = [*keys, *[f"__o{i}" for i in range(len(order))]]
    rows = present(df, residual).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)],
        *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)], F.col(residual).cast("double").alias("__e"))
    if keys:
        rows = rows.withColumn("__group", F.xxhash64(*keys))
    else:
        rows = rows.withColumn("__group", F.lit(0).cast("long"))
    rows = rows.repartitionByRange(*ways).sortWithinPartitions(*ways).select(*keys, "__group", "__e")
    schema = StructType([*[f for f in rows.schema.fields if f.name in keys], StructField("part", LongType()),
                         StructField("n", LongType()), *[StructField(c, DoubleType()) for c in ("squares", "steps", "first", "last")]])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_ = TaskContext.get().partitionId(), None
        width = len(keys)
        for record in batches:
            group, e = record.column(width).to_numpy(), record.column(width + 1).to_numpy()
            if not len(e):
                continue
            starts = np.flatnonzero(np.diff(group, prepend=group[0] - 1) != 0) if len(e) > 1 else np.array([0])
            starts = np.unique(np.concatenate([[0], starts]))
            ends = np.append(starts[1:], len(e))
            step = np.square(np.diff(e, prepend=e[0]))
            step[starts] = 0.0
            runs = [[int(group[s]), s, int(t - s), float(q), float(d), float(e[s]), float(e[t - 1])] for s, t, q, d in zip(
                starts, ends, np.add.reduceat(np.square(e), starts), np.add.reduceat(step, starts), strict=True)]
            names = [record.column(i).take(pa.array(starts)).to_pylist() for i in range(width)]
            done = []
            for i, run in enumerate(runs):
                label = tuple(c[i] for c in names)
                if open_ is not None and open_[0] == label:
                    _, n, squares, steps, first, last = open_
                    open_ = (label, n + run[2], squares + run[3], steps + run[4] + (run[5] - last) ** 2, first, run[6])
                    continue
                if open_ is not None:
                    done.append(open_)
                open_ = (label, *run[2:])
            if done:
                yield summary(done, part)
        if open_ is not None:
            yield summary([open_], part)

    def summary(done: list, part: int) -> pa.RecordBatch:
        rows = [(*label, part, *rest) for label, *rest in done]
        return pa.RecordBatch.from_pylist([dict(zip(names_, r, strict=True)) for r in rows], schema=arrow)

    names_, arrow = schema.fieldNames(), to_arrow_schema(schema)
    parts = rows.mapInArrow(summarise, schema)
    before = F.lag("last").over(Window.partitionBy(*keys).orderBy("part"))
    joint = parts.withColumn("joint", F.coalesce(F.pow(F.col("first") - before, 2), F.lit(0.0)))
    return joint.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("squares").alias("squares"),
                                    F.sum(F.col("steps") + F.col("joint")).alias("steps")).select(
        *[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], "n",
        (F.col("steps") / F.nullif(F.col("squares"), F.lit(0.0))).alias("durbin_watson"))


def vif(df: DataFrame, xs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Variance inflation factor per predictor (and group), from the correlation matrix.

    A constant predictor counts as uncorrelated; a singular matrix gives no VIF.
    """
    by, xs = list(by), list(xs)
    moments = co_moments(df, xs, by)
    schema = StructType([*[f for f in moments.schema.fields if f.name in by], StructField("position", LongType()),
                         StructField("term", StringType()), StructField("vif", DoubleType())])
    names = schema.fieldNames()

    def invert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(xs)
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                values = np.array([np.nan if v is None else v for v in row["cov"]], dtype=float)
                cov = values.reshape(k, k)
                scale = np.sqrt(np.diag(cov))
                with np.errstate(invalid="ignore", divide="ignore"):
                    corr = np.nan_to_num(cov / np.outer(scale, scale), nan=0.0, posinf=0.0, neginf=0.0)
                np.fill_diagonal(corr, 1.0)
                free = len(independent_columns(corr)) == k
                factors = np.diag(np.linalg.inv(corr)) if free else np.full(k, np.nan)
                out += [{**{g: row[g] for g in by}, "position": i, "term": t, "vif": v}
                        for i, (t, v) in enumerate(zip(xs, _nullable(factors), strict=True), start=1)]
            yield pd.DataFrame(out, columns=names)

    out = moments.mapInPandas(invert, schema)
    return out.withColumn("status", F.when(F.col("vif").isNull(), "singular")
                          .when(F.col("vif") > VIF_ALERT, "alert").otherwise("ok"))


def qq_points(df: DataFrame, value: str, by: Sequence[str] = (), points: int = 200) -> DataFrame:
    """Standardised values against normal quantiles, on a grid of ``points`` over all rows.

    Point i stands at the share (i - 1/2) / points; its value is the smallest that at
    least this share of the rows does not exceed, standardised by mean and population
    deviation.
    """
    by = list(by)
    rows = present(df, value)
    ranked = rank_cells(value_counts(rows, value, by), by, probe(rows, value, by))
    scaled = with_group(ranked, by, source=rows, mean=F.avg(number(value)), std=F.stddev_pop(number(value)))
    return qq_grid(scaled, by, points)


def qq_grid(scaled: DataFrame, by: Sequence[str], points: int) -> DataFrame:
    """The grid from cells with running positions (value, cum_le, tied, total) and the group's mean and std."""
    upto = F.expr(f"({2 * points} * cum_le + total) div (2 * total)")
    after = F.expr(f"({2 * points} * (cum_le - tied) + total) div (2 * total) + 1")
    met = scaled.where(after <= upto).withColumn("point", F.explode(F.sequence(after, upto)))
    return met.withColumn("at", (F.col("point") - F.lit(0.5)) / F.lit(float(points))).select(
        *by, "point", "value", norm_ppf(F.col("at")).alias("theoretical"),
        ((F.col("value") - F.col("mean")) / F.nullif(F.col("std"), F.lit(0.0))).alias("sample"))
