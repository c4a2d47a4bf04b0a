"""Contingency tables, chi-square independence and the missing-value mechanism."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkinfer.functions.effects import cramers_v, effect_label
from sparkinfer.functions.scalars import null_flag
from sparkinfer.functions.tails import chi2_sf
from sparkinfer.operators.joins import FEW_KEYS, join_on, place, with_group
from sparkinfer.sources.landing import cut


def contingency(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Non-empty cells (by, a, b, n); rows without a level are left out."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(*by, a, b).agg(F.count(F.lit(1)).alias("n")))


def contingency_wide(df: DataFrame, a: str, b: str, levels: Sequence | None = None) -> DataFrame:
    """One row per level of ``a``, one column per level of ``b``, zeros filled in."""
    grouped = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a)
    wide = grouped.pivot(b, list(levels) if levels is not None else None).count()
    return wide.na.fill(0)


def counted_with_margins(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Cells, row sums and column sums from one aggregation over grouping sets, stored: (by, a, b, n, margin).

    ``margin`` is 0 for a cell, 1 for a row sum (over ``b``), 2 for a column sum. The table is read
    once, and tasks fold their rows to cells before anything is shuffled.
    """
    by = list(by)
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*by, a, b)
    keys = [F.col(c) for c in by]
    sets = [[*keys, F.col(a), F.col(b)], [*keys, F.col(a)], [*keys, F.col(b)]]
    counted = rows.groupingSets(sets, *keys, F.col(a), F.col(b)).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("margin"))
    return cut(counted)


def chi2_from_cells(counted: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson chi-square from counted cells and margins, Yates-corrected when df = 1.

    Only non-empty cells are touched: an empty cell adds its expected count, and
    those sum to N minus the expected counts of the non-empty cells. Margins are joined back by
    their keys; the side with few levels is measured and broadcast, so that a two-valued
    column does not gather its half of the cells in one task.
    """
    by = list(by)
    sizes = {r["margin"]: r["m"] for r in counted.groupBy("margin").agg(F.count(F.lit(1)).alias("m")).collect()}
    rowsum = counted.where("margin = 1").select(*by, a, F.col("n").alias("_row_sum"))
    colsum = counted.where("margin = 2").select(*by, b, F.col("n").alias("_column_sum"))
    sums = rowsum.groupBy(*by).agg(F.sum("_row_sum").alias("total"), F.count(F.lit(1)).alias("n_rows"))
    kinds = colsum.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cols"))
    cells = counted.where("margin = 0").select(*by, a, b, "n")
    placed = place(cells, rowsum, [*by, a], "_row_sum", sizes.get(1, 0) <= FEW_KEYS, nulls=True)
    placed = place(placed, colsum, [*by, b], "_column_sum", sizes.get(2, 0) <= FEW_KEYS, nulls=True)
    sized = with_group(placed, by, source=rowsum, total=F.sum("_row_sum"))
    expected = F.col("_row_sum") * F.col("_column_sum").cast("double") / F.col("total")
    gap = F.abs(F.col("n") - expected)
    folded = sized.groupBy(*by).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("filled"), F.sum(gap * gap / expected).alias("seen"),
        F.sum(expected).alias("covered"), F.max(gap).alias("gap"))
    if by:
        folded = join_on(join_on(folded, sums.drop("total"), by, "left"), kinds, by, "left")
    else:
        folded = folded.withColumns({"n_rows": sums.select("n_rows").scalar(), "n_cols": kinds.select("n_cols").scalar()})
    rows, cols = F.col("n_rows"), F.col("n_cols")
    full = F.col("filled") == rows * cols
    plain = F.col("seen") + F.when(full, F.lit(0.0)).otherwise(F.col("n") - F.col("covered"))
    # in a 2 x 2 table all four |O - E| are equal, so the correction is one factor
    shrink = F.coalesce((F.col("gap") - F.least(F.lit(0.5), F.col("gap")))
                        / F.nullif(F.col("gap"), F.lit(0.0)), F.lit(0.0))
    freedom = (rows - 1) * (cols - 1)
    testable = (rows >= 2) & (cols >= 2)
    stat = F.when(testable, F.when(freedom == 1, plain * shrink * shrink).otherwise(plain))
    return (folded.select(*by, "n", "n_rows", "n_cols", stat.alias("statistic"),
                          F.when(testable, freedom).alias("df"))
            .withColumn("p_value", chi2_sf(F.col("statistic"), F.col("df")))
            .withColumn("cramers_v", cramers_v(F.col("statistic"), F.col("n"), rows, cols))
            .withColumn("effect_label", effect_label(F.col("cramers_v"), "v"))
            .withColumn("status", F.when(F.col("statistic").isNull(), "not testable").otherwise("ok")))


def chi2_independence(df: DataFrame, a: str, b: str, by: Sequence[str] = ()) -> DataFrame:
    return chi2_from_cells(counted_with_margins(df, a, b, by), a, b, by)


def missingness(df: DataFrame, target: str, factors: Sequence[str], alpha: float = 0.05,
                by: Sequence[str] = ()) -> DataFrame:
    """Does the absence of ``target`` depend on each factor, in all rows or within every group?

    One scan counts (factor, level, is_null) and both margins for all factors; one chi-square per
    factor follows from the stored counts. Verdict: MAR (depends), MCAR (independent) or not testable.
    """
    by = list(by)
    keys = [*by, "factor"]
    flagged = df.select(*by, null_flag(F.col(target)).alias("is_null"),
                        *[F.col(f).cast("string").alias(f"__{f}") for f in factors])
    long = flagged.unpivot([*by, "is_null"], [f"__{f}" for f in factors], "factor", "level").withColumn(
        "factor", F.substring("factor", 3, 1 << 20))
    counted = counted_with_margins(long, "level", "is_null", keys)
    tested = chi2_from_cells(counted, "level", "is_null", keys)
    shares = counted.where("margin = 2").groupBy(*keys).agg(
        F.sum(F.when(F.col("is_null") == 1, F.col("n")).otherwise(0)).alias("n_null"))
    out = join_on(tested, shares, keys, "left")
    return (out.withColumn("null_rate", F.col("n_null") / F.nullif(F.col("n"), F.lit(0)))
            .withColumn("mechanism", F.when(F.col("p_value").isNull(), "not testable")
                        .when(F.col("p_value") < alpha, "MAR").otherwise("MCAR")))
