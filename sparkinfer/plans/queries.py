"""One query per operator, run over the whole driver tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import out_of_range, present
from sparkinfer.operators import (charts, cleaning, contingency, describe, hypothesis, joins, normality,
                                  ranks, reconcile, regression, sampling, sketches, timeseries)
from sparkinfer.operators.cells import count_cells
from sparkinfer.plans.sales import lines, sales, table
from sparkinfer.sources.landing import cut, land, scratch, write_results
from sparkinfer.plans.suites import (SalesColumns, StudyConfig, association_suite, clean_table, event_table,
                                     hypothesis_suite, regression_report as least_squares_report, run_study, temporal_suite)
from sparkinfer.sources.delimited import CORRUPT, parse, scan

SEED = 42
URGENT, LOW = "1-URGENT", "5-LOW"
CHANNELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
STORES = (2, 60)
EVENTS = (("spring", "1996-05-12"), ("winter", "1997-12-24"), ("winter eve", "1997-12-25"),
          ("autumn", "1999-09-18"), ("before the data", "1979-01-01"), ("after the data", "2031-01-01"))
SERIES_START = "1996-03-01"
SPANS = (("one day", "1996-05-12", "1996-05-12"), ("a week", "1996-12-20", "1996-12-26"), ("a season", "1994-02-03", "1994-06-29"),
         ("years", "1997-10-31", "1999-01-02"), ("inside another", "1998-03-01", "1998-03-09"), ("backwards", "1995-05-05", "1995-05-01"),
         ("before the data", "1901-01-01", "1979-12-31"), ("past the end", "2001-06-01", "2090-01-01"))
TEXT_COLUMNS = ["FECHA", "CANAL", "PRODUCTO", "UNIDADES", "PORCENTAJE DESCUENTO", "LOCAL"]
NUMERIC = ["units", "discount", "amount", "age_years"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every floating column, so that summation order does not show."""
    return df.select(*[F.round(c, special.get(c, digits)).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


# ---- cleaning ---------------------------------------------------------------

@query
def clean_derive(spark, sf):
    df = cleaning.derive(sales(spark, sf), birth="birth_text", sold_at="shipped", age="age_from_text")
    return rounded(df.select("row_key", "discount", "amount_per_unit", "age_from_text"), amount_per_unit=8)


@query
def invalid_range_impute(spark, sf):
    df = sales(spark, sf).select("age_years", out_of_range(F.col("age_years"), 0, 110).alias("bad"))
    middle = cleaning.valid_median(df, "age_years")
    fixed = cleaning.impute_invalid(df, "age_years", median=middle)
    return rounded(fixed.agg(F.min("age_years").alias("min_age"), F.max("age_years").alias("max_age"),
                             F.avg("age_years").alias("mean_age"), F.count(F.lit(1)).alias("n"),
                             F.count_if("bad").alias("n_invalid"))
                   .withColumn("median_age", middle.select("median").scalar()))


@query
def invalid_range_count(spark, sf):
    return cleaning.invalid_count(sales(spark, sf), "age_years")


@query
def imputed_rows(spark, sf):
    return rounded(cleaning.impute_invalid(sales(spark, sf), "age_years").select("row_key", "age_years"))


@query
def iqr_fences(spark, sf):
    return rounded(cleaning.iqr_fences(lines(spark, sf), "amount"))


@query
def iqr_fences_by_channel(spark, sf):
    return rounded(cleaning.iqr_fences(sales(spark, sf), "amount", ["channel"]))


@query
def outlier_flag_summary(spark, sf):
    per_unit = cleaning.derive(lines(spark, sf))
    return rounded(cleaning.outlier_summary(cleaning.flag_outliers(per_unit, "amount_per_unit")))


@query
def outlier_flag_by_group(spark, sf):
    per_unit = cleaning.derive(lines(spark, sf))
    marked = cleaning.flag_outliers(per_unit, "amount_per_unit", by=["flag"])
    return marked.groupBy("flag").agg(F.count(F.lit(1)).alias("n"),
                                      F.count_if("is_outlier").alias("n_outliers"))


@query
def zscore_params(spark, sf):
    return rounded(cleaning.scaling_parameters(sales(spark, sf), NUMERIC))


@query
def zscore_rows(spark, sf):
    return rounded(cleaning.standardize(lines(spark, sf), ["units", "discount", "amount"])
                   .select("row_key", "units_scaled", "discount_scaled", "amount_scaled"))


@query
def whitelist_reject_count(spark, sf):
    df = sales(spark, sf)
    return cleaning.rejected_count(df, cleaning.expected_levels(df, "channel", "store", CHANNELS, STORES))


@query
def null_rates(spark, sf):
    return rounded(describe.null_rates(sales(spark, sf), ["discount", "customer_id", "amount"]))


@query
def one_hot_counts(spark, sf):
    df, names = cleaning.one_hot(sales(spark, sf), "channel")
    return df.agg(*[F.sum(n).cast("long").alias(n) for n in names]).unpivot([], names, "dummy", "n")


# ---- joins ------------------------------------------------------------------

@query
def customer_frequency(spark, sf):
    return joins.frequency(sales(spark, sf), "customer_id").select("row_key", "customer_id", "frequency")


@query
def distinct_customers(spark, sf):
    return joins.distinct_keys(sales(spark, sf), "customer_id")


@query
def distinct_customers_rollup(spark, sf):
    """Distinct customers of each channel, and in all, from sketches per day and channel; within three percent."""
    rows = sales(spark, sf).select("channel", F.to_date("ts").alias("day"), "customer_id")
    kept = cut(sketches.distinct_sketches(rows, "customer_id", ["channel", "day"]))
    found = sketches.distinct_rollup(kept, ["channel"], "estimate")
    exact = rows.rollup("channel").agg(F.count_distinct("customer_id").alias("n_exact"), F.grouping_id().cast("int").alias("level"))
    met = joins.join_on(exact, found, ["channel", "level"])
    return met.select(F.coalesce("channel", F.lit("all")).alias("channel"), "level", "n_exact",
                      (F.abs(F.col("estimate") - F.col("n_exact")) <= 0.03 * F.col("n_exact") + 1).alias("within"))


# ---- aggregates -------------------------------------------------------------

@query
def group_sizes(spark, sf):
    return describe.group_sizes(sales(spark, sf), ["channel", "store"])


@query
def contingency_long(spark, sf):
    return contingency.contingency(sales(spark, sf, True), "channel", "segment")


@query
def contingency_wide(spark, sf):
    wide = contingency.contingency_wide(sales(spark, sf), "channel", "gender", ["F", "O"])
    return wide.select("channel", F.col("F").alias("n_f"), F.col("O").alias("n_o"))


@query
def describe_population(spark, sf):
    return rounded(describe.describe(sales(spark, sf), NUMERIC), 5)


@query
def describe_sample(spark, sf):
    return rounded(describe.describe_full(sales(spark, sf), NUMERIC), 5, variance=2)


@query
def describe_by_segment(spark, sf):
    return rounded(describe.describe_full(sales(spark, sf, True), ["amount", "age_years"], ["segment"]), 5, variance=2)


@query
def quantiles_exact(spark, sf):
    points = {"p01": 0.01, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p999": 0.999}
    return rounded(ranks.quantiles(lines(spark, sf), "amount", points))


@query
def quantiles_by_store(spark, sf):
    return rounded(ranks.quantiles(lines(spark, sf), "amount", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["store"]))


def _within(found: DataFrame, points: dict[str, float], share: float) -> DataFrame:
    """(..., quantile, n, within): whether the rank of each found quantile is off by at most ``share`` of the rows."""
    at = F.create_map(*[F.lit(x) for p in points.items() for x in p])[F.col("quantile")]
    slack = F.col("n") * share + 1
    inside = (F.col("below") <= F.col("n") * at + slack) & (F.col("upto") >= F.col("n") * at - slack)
    return found.withColumn("within", inside).drop("below", "upto")


@query
def quantiles_approximate(spark, sf):
    """Approximate quantiles of every store, each with whether its rank is within 1 / accuracy."""
    points = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    rows = lines(spark, sf).select("store", "amount")
    found = ranks.quantiles(rows, "amount", points, ["store"], approximate=True, accuracy=1000)
    return _within(sketches.rank_bounds(rows, "amount", found, list(points), ["store"]), points, 0.001)


@query
def quantiles_sketch_rollup(spark, sf):
    """Quantile sketches per store and flag, merged to flags and to the total; ranks within two percent."""
    points = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99}
    rows = lines(spark, sf).select("store", "flag", "amount")
    kept = cut(sketches.quantile_sketches(rows, "amount", ["store", "flag"]))
    flags = _within(sketches.rank_bounds(rows, "amount", sketches.merged_quantiles(kept, points, ["flag"]), list(points), ["flag"]), points, 0.02)
    total = _within(sketches.rank_bounds(rows, "amount", sketches.merged_quantiles(kept, points), list(points)), points, 0.02)
    return flags.unionByName(total.withColumn("flag", F.lit("all")))


@query
def group_summary(spark, sf):
    return rounded(describe.group_summary(sales(spark, sf), "amount", ["channel", "gender"]), 5)


# ---- ranks and series -------------------------------------------------------

@query
def avg_rank_ties(spark, sf):
    return ranks.average_ranks(lines(spark, sf), "amount").drop("total")


@query
def avg_rank_ties_by_flag(spark, sf):
    return ranks.average_ranks(lines(spark, sf), "discount", ["flag"]).drop("total")


def _series(spark, sf):
    return timeseries.daily_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")


def _events(spark):
    return event_table(spark, EVENTS)


@query
def daily_series_filled(spark, sf):
    return rounded(_series(spark, sf), 2)


@query
def daily_series_by_status(spark, sf):
    return rounded(timeseries.daily_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice",
                                           ["o_orderstatus"]), 2)


@query
def seasonal_decompose_7(spark, sf):
    return rounded(timeseries.seasonal_decompose(_series(spark, sf), 7), 2)


@query
def acf_30(spark, sf):
    return rounded(timeseries.acf(_series(spark, sf), 30))


@query
def pacf_30(spark, sf):
    return rounded(timeseries.pacf(_series(spark, sf), 30))


@query
def event_calendar_status(spark, sf):
    return timeseries.event_calendar(_events(spark), _series(spark, sf))


@query
def event_window_flag(spark, sf):
    return rounded(timeseries.event_flags(_series(spark, sf), _events(spark), 7), 2)


@query
def event_interval_flag(spark, sf):
    """Days of the series inside campaigns of very unequal length, some of them overlapping or outside."""
    spans = spark.createDataFrame(SPANS, "name string, start string, stop string").select(
        F.to_date("start").alias("start"), F.to_date("stop").alias("stop"))
    return rounded(timeseries.interval_flags(_series(spark, sf), spans, "start", "stop"), 2)


@query
def order_spans_by_status(spark, sf):
    """Days of each status's series that lie between an order's date and its last shipment, orders of that status only."""
    orders = table(spark, sf, "orders").where(F.col("o_totalprice") > 400000)
    last = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_key")).agg(F.max("l_shipdate").alias("stop"))
    spans = orders.join(last, orders["o_orderkey"] == last["order_key"]).select(
        "o_orderstatus", F.to_date("o_orderdate").alias("start"), F.to_date("stop").alias("stop"))
    series = timeseries.daily_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", ["o_orderstatus"])
    return rounded(timeseries.interval_flags(series, spans, "start", "stop", ["o_orderstatus"]).drop("pos"), 2)


@query
def event_impact(spark, sf):
    return rounded(timeseries.event_impact(_series(spark, sf), _events(spark), SERIES_START, 7), 4)


@query
def event_impact_by_status(spark, sf):
    series = timeseries.daily_series(table(spark, sf, "orders"), "o_orderdate", "o_totalprice", ["o_orderstatus"])
    return rounded(timeseries.event_impact(series, _events(spark), SERIES_START, 7, ["o_orderstatus"]), 4)


# ---- tests ------------------------------------------------------------------

@query
def chi2_independence(spark, sf):
    return rounded(contingency.chi2_independence(sales(spark, sf), "channel", "store"))


@query
def chi2_yates_by_segment(spark, sf):
    df = sales(spark, sf, True).withColumn("cheap", F.col("amount") < 30000)
    return rounded(contingency.chi2_independence(df, "gender", "cheap", ["segment"]))


@query
def missingness_chi2(spark, sf):
    return rounded(contingency.missingness(sales(spark, sf), "customer_id", ["channel", "store"]))


@query
def missingness_by_segment(spark, sf):
    return rounded(contingency.missingness(sales(spark, sf, True), "customer_id", ["channel", "gender"], by=["segment"]))


@query
def spearman_pair(spark, sf):
    return rounded(hypothesis.spearman(sales(spark, sf), "amount", "age_years"))


@query
def spearman_by_segment(spark, sf):
    return rounded(hypothesis.spearman(sales(spark, sf, True), "units", "discount", ["segment"]))


@query
def spearman_matrix(spark, sf):
    df = sales(spark, sf).withColumn("constant", F.signum("units"))
    return rounded(hypothesis.spearman_matrix(df, ["constant", "units", "discount", "amount"])
                   .select("a", "b", "n", "rho", "p_value", "stars"))


@query
def spearman_matrix_by_flag(spark, sf):
    return rounded(hypothesis.spearman_matrix(lines(spark, sf), ["units", "discount", "amount"], ["flag"])
                   .select("flag", "a", "b", "n", "rho", "stars"))


@query
def anova_oneway(spark, sf):
    return rounded(hypothesis.anova_oneway(sales(spark, sf), "amount", "store"))


@query
def anova_by_segment(spark, sf):
    return rounded(hypothesis.anova_oneway(sales(spark, sf, True), "amount", "channel", ["segment"]))


@query
def kruskal_wallis(spark, sf):
    return rounded(hypothesis.kruskal_wallis(sales(spark, sf), "amount", "store"))


@query
def kruskal_by_segment(spark, sf):
    return rounded(hypothesis.kruskal_wallis(sales(spark, sf, True), "discount", "channel", ["segment"]))


@query
def mann_whitney(spark, sf):
    return rounded(hypothesis.mann_whitney(sales(spark, sf), "amount", "channel", URGENT, LOW,
                                           alternative="greater"))


@query
def mann_whitney_by_segment(spark, sf):
    return rounded(hypothesis.mann_whitney(sales(spark, sf, True), "discount", "gender", "F", "O", ["segment"]))


@query
def mann_whitney_exact_by_store(spark, sf):
    """Amounts with and without a high discount, for each store and month of shipment: mostly a handful of rows."""
    rows = lines(spark, sf).select("store", F.date_format("l_shipdate", "yyyy-MM").alias("month"), "amount",
                                   (F.coalesce("discount", F.lit(0.0)) > 0.055).alias("high"))
    return rounded(hypothesis.mann_whitney_exact(rows, "amount", "high", True, False, ["store", "month"]).select(
        "store", "month", "n1", "n2", "statistic", "p_value", "method", "status"))


@query
def welch_t(spark, sf):
    return rounded(hypothesis.welch_t(sales(spark, sf), "amount", "channel", URGENT, LOW,
                                      alternative="greater"), 4)


@query
def welch_t_by_store(spark, sf):
    return rounded(hypothesis.welch_t(lines(spark, sf), "amount", "gender", "F", "O", ["store"]), 4)


@query
def simple_regression(spark, sf):
    return rounded(hypothesis.simple_regression(sales(spark, sf), "units", "discount"))


@query
def simple_regression_by_store(spark, sf):
    return rounded(hypothesis.simple_regression(lines(spark, sf), "amount", "units", ["store"]), 4)


@query
def shapiro(spark, sf):
    return rounded(normality.shapiro_wilk(lines(spark, sf), "amount", ["row_key"], seed=SEED))


@query
def shapiro_by_flag(spark, sf):
    return rounded(normality.shapiro_wilk(lines(spark, sf), "discount", ["row_key"], ["flag"], 1000, SEED))


@query
def ks_normal(spark, sf):
    return rounded(normality.ks_normal(lines(spark, sf), "amount"))


@query
def ks_normal_by_flag(spark, sf):
    return rounded(normality.ks_normal(lines(spark, sf), "units", ["flag"]))


@query
def shapiro_francia(spark, sf):
    return rounded(normality.shapiro_francia(lines(spark, sf), "amount"))


@query
def shapiro_francia_by_flag(spark, sf):
    """Fifty values hold all rows: each meets the sum of the normal scores of its places."""
    return rounded(normality.shapiro_francia(lines(spark, sf), "units", ["flag"]))


@query
def normality_report(spark, sf):
    rows, columns = lines(spark, sf), ["units", "discount", "amount"]
    distances = count_cells(rows, columns).kolmogorov()
    return rounded(normality.normality(rows, columns, ["row_key"], seed=SEED, distances=distances))


@query
def hypothesis_report(spark, sf):
    config = StudyConfig(columns=SalesColumns(), app_channel=URGENT, web_channel=LOW, genders=("F", "O"), seed=SEED)
    # read by eight tests, so the joined rows are stored once
    df = cut(joins.frequency(sales(spark, sf), "customer_id").select(
        "channel", "gender", "units", "discount", "amount", "age_years", "frequency"))
    return rounded(hypothesis_suite(df, config))


# ---- regression -------------------------------------------------------------

def _design(spark, sf):
    """amount ~ units + flag dummies; the level N is the baseline."""
    df, names = cleaning.one_hot(lines(spark, sf), "flag", ["N", "A", "R"], "N")
    return df, ["units", *names]


@query
def ols_coefficients(spark, sf):
    df, xs = _design(spark, sf)
    return rounded(regression.ols(df, "amount", xs).coefficients.drop("position"), 5)


@query
def ols_fit(spark, sf):
    df, xs = _design(spark, sf)
    return rounded(regression.ols(df, "amount", xs).fit.select("n", "rank", "df_resid", "r2", "r2_adj", "sigma2", "status"),
                   8, sigma2=1)


@query
def ols_by_store(spark, sf):
    return rounded(regression.ols(lines(spark, sf), "amount", ["units", "discount"], ["store"])
                   .coefficients.drop("position"), 3)


@query
def ols_collinear(spark, sf):
    df = lines(spark, sf).withColumn("twice", F.col("units") * 2).withColumn("one", F.lit(1.0))
    return rounded(regression.ols(df, "amount", ["units", "twice", "one"]).coefficients.drop("position"), 5)


@query
def ols_illconditioned(spark, sf):
    """Two predictors that differ by one part in ten million: amount on units and 1e7 units + discount in cents.

    The tall-skinny QR finds all three coefficients; co-moments take the second predictor for a multiple of the first.
    """
    rows = present(lines(spark, sf), "amount", "units", "discount").select(
        "amount", "units", (F.col("units") * 1e7 + F.round(F.col("discount") * 100)).alias("nearly"))
    found = regression.ols_qr(rows, "amount", ["units", "nearly"])
    plain = regression.ols(rows, "amount", ["units", "nearly"]).coefficients.select("position", F.col("status").alias("by_moments"))
    met = joins.join_on(found, plain, ["position"])
    scale = F.when(F.col("term") == "units", F.lit(1e7)).otherwise(F.lit(1.0))
    return met.select("term", "n", F.round(F.col("coef") / scale, 2).alias("coef"), F.round(F.col("std_err") / scale, 2).alias("std_err"),
                      "status", "by_moments")


def _split_fit(spark, sf):
    df, xs = _design(spark, sf)
    flagged = sampling.split_flag(df, ["row_key"], 0.3, SEED)
    return flagged, regression.ols(flagged.where("not is_test"), "amount", xs), xs


@query
def split_sizes(spark, sf):
    flagged = sampling.split_flag(lines(spark, sf), ["row_key"], 0.3, SEED)
    return flagged.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"))


@query
def split_sizes_exact(spark, sf):
    flagged = sampling.split_flag_exact(lines(spark, sf), ["row_key"], 0.3, SEED)
    return rounded(flagged.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")), 2)


@query
def ols_holdout(spark, sf):
    flagged, model, _ = _split_fit(spark, sf)
    held = model.residuals(flagged.where("is_test"), "amount")
    return rounded(regression.holdout_metrics(held, "amount"))


@query
def breusch_pagan(spark, sf):
    df, xs = _design(spark, sf)
    fitted = regression.ols(df, "amount", xs).residuals(df, "amount")
    return rounded(regression.breusch_pagan(fitted, "residual", xs), 4)


@query
def durbin_watson(spark, sf):
    df, xs = _design(spark, sf)
    fitted = regression.ols(df, "amount", xs).residuals(df, "amount")
    return rounded(regression.durbin_watson(fitted, "residual", ["row_key"]))


@query
def vif(spark, sf):
    return rounded(regression.vif(lines(spark, sf), ["units", "amount"]))


@query
def residual_shapiro(spark, sf):
    df, xs = _design(spark, sf)
    fitted = regression.ols(df, "amount", xs).residuals(df, "amount")
    return rounded(normality.shapiro_wilk(fitted, "residual", ["row_key"], seed=SEED), 5)


@query
def qq_points(spark, sf):
    df, xs = _design(spark, sf)
    fitted = regression.ols(df, "amount", xs).residuals(df, "amount").withColumn(
        "residual", F.round("residual", 6))
    return rounded(regression.qq_points(fitted, "residual").drop("value"), 5)


@query
def ols_diagnostics_by_store(spark, sf):
    """Every store's own fit on its training rows, judged on its test rows, with all residual diagnostics."""
    xs = ["units", "discount"]
    rows = present(lines(spark, sf), "amount", *xs).select("store", "row_key", "amount", *xs)
    flagged = cut(sampling.split_flag(rows, ["row_key"], 0.3, SEED))
    train, test = flagged.where("not is_test"), flagged.where("is_test")
    model = regression.ols(train, "amount", xs, ["store"])
    fitted = cut(model.residuals(train, "amount"))
    bp = regression.breusch_pagan(fitted, "residual", xs, ["store"]).select(
        "store", "n", F.col("statistic").alias("bp"), F.col("p_value").alias("bp_p"), F.col("df").alias("bp_df"))
    dw = regression.durbin_watson(fitted, "residual", ["row_key"], ["store"]).drop("n")
    inflated = regression.vif(train, xs, ["store"]).groupBy("store").agg(F.max("vif").alias("vif"), F.count("vif").alias("n_vif"))
    held = regression.holdout_metrics(model.residuals(test, "amount"), "amount", by=["store"]).withColumnsRenamed(
        {"n": "n_test", "r2": "r2_test"})
    out = bp
    for part in (dw, inflated, held):
        out = joins.join_on(out, part, ["store"], "left")
    return rounded(out, 5, r2_test=4, bp=4, rmse=3, mae=3)


# ---- samples ----------------------------------------------------------------

@query
def seeded_sample(spark, sf):
    return sampling.seeded_sample(lines(spark, sf), ["row_key"], 500, SEED).select("row_key", "amount")


@query
def seeded_sample_by_flag(spark, sf):
    return sampling.seeded_sample(lines(spark, sf), ["row_key"], 200, SEED, ["flag"]).select("flag", "row_key", "amount")


@query
def head_sample(spark, sf):
    return sampling.head_sample(table(spark, sf, "orders"), ["o_orderkey"], 1000).select("o_orderkey", "o_totalprice")


# ---- chart tables -----------------------------------------------------------

@query
def hist_density(spark, sf):
    return rounded(charts.histogram(lines(spark, sf), "amount", 40), 10)


@query
def hist_auto_bins(spark, sf):
    return rounded(charts.histogram(sales(spark, sf), "age_years"), 8)


@query
def kde_curve(spark, sf):
    """Density times range, so that six decimals are six digits; the SQL sums a kernel for every row."""
    rows = lines(spark, sf)
    span = rows.agg((F.max("amount") - F.min("amount")).alias("s")).scalar()
    curve = charts.kde_curve(rows, "amount", 100)
    return rounded(curve.select("point", "x", (F.col("density") * span).alias("scaled_density")), 6, x=9)


@query
def boxplot_stats(spark, sf):
    per_unit = cleaning.derive(lines(spark, sf))
    return rounded(charts.boxplot(per_unit, "amount_per_unit", ["flag"]))


@query
def residual_bins(spark, sf):
    df, xs = _design(spark, sf)
    fitted = regression.ols(df, "amount", xs).residuals(df, "amount")
    return charts.histogram(fitted, "residual", 50).select("bin", "n")


@query
def residual_vs_fitted(spark, sf):
    df, xs = _design(spark, sf)
    fitted = regression.ols(df, "amount", xs).residuals(df, "amount")
    return charts.binned_scatter(fitted, "predicted", "residual", 20).select("x_bin", "y_bin", "n")


# ---- comparing metrics ------------------------------------------------------

def _metrics(df: DataFrame, column: str) -> DataFrame:
    """(metric, value) pairs of one column, for the comparisons."""
    row = df.agg(F.count(F.lit(1)).cast("double").alias("row_count"), F.avg(column).alias("mean"),
                 F.min(column).alias("min"), F.max(column).alias("max"),
                 F.count_distinct("store").cast("double").alias("store_count"))
    names = row.columns
    return row.unpivot([], names, "metric", "value")


@query
def reconcile_metrics(spark, sf):
    actual = _metrics(lines(spark, sf), "amount").where("metric <> 'max'")
    shifted = lines(spark, sf).withColumn("amount", F.col("amount") * 1.0005)
    expected = _metrics(shifted, "amount").withColumn("is_count", F.col("metric").isin("row_count", "store_count"))
    expected = expected.withColumn("value", F.when(F.col("metric") == "store_count", F.col("value") + 1)
                                   .otherwise(F.col("value")))
    return rounded(reconcile.check_expected(actual, expected))


@query
def determinism_diff(spark, sf):
    first = _metrics(lines(spark, sf), "amount").where("metric <> 'min'")
    second = _metrics(lines(spark, sf).repartition(7), "units")
    return rounded(reconcile.compare_runs(first, second))




# ---- NULL groups, unlisted levels, one constant sample ----------------------

def _gap(spark, sf):
    """lines with flag R missing."""
    return lines(spark, sf).withColumn("flag", F.nullif("flag", F.lit("R")))


@query
def seeded_sample_null_group(spark, sf):
    return sampling.seeded_sample(_gap(spark, sf), ["row_key"], 200, SEED, ["flag"]).select("flag", "row_key", "amount")


@query
def outlier_flag_null_group(spark, sf):
    marked = cleaning.flag_outliers(cleaning.derive(_gap(spark, sf)), "amount_per_unit", by=["flag"])
    return marked.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_outlier").alias("n_outliers"))


@query
def one_hot_unlisted(spark, sf):
    marked, names = cleaning.one_hot(_gap(spark, sf).withColumn("k", F.coalesce("gender", "flag")), "flag", ["N", "X"], "X")
    return marked.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.count(names[0]).alias("n_known"),
                                      F.sum(names[0]).alias("n_hot"))


@query
def welch_constant_sample(spark, sf):
    df = lines(spark, sf).withColumn("units", F.when(F.col("gender") == "F", 25.0).otherwise(F.col("units")))
    return rounded(hypothesis.welch_t(df, "units", "gender", "F", "O"), 4)


# ---- text rows, cells, columns kept -----------------------------------------

@query
def typed_text_rows(spark, sf):
    """Rows rendered as text, some with a bad, missing or fractional value or a wrong number of fields, and parsed."""
    item = table(spark, sf, "lineitem")
    key = F.col("l_orderkey")
    units = (F.when(key % 7 == 0, "x").when(key % 7 == 1, "n/a").when(key % 7 == 2, F.concat(F.col("l_quantity").cast("int"), F.lit(".0")))
             .when(key % 7 == 3, "2.5").otherwise(F.col("l_quantity").cast("int").cast("string")))
    raw = item.select(units.alias("UNIDADES"), F.col("l_discount").cast("string").alias("PORCENTAJE DESCUENTO"),
                      F.col("l_suppkey").cast("string").alias("LOCAL"), F.col("l_returnflag").alias("CANAL"),
                      F.when(key % 11 == 0, "1;2").alias(CORRUPT))
    columns = ["UNIDADES", "PORCENTAJE DESCUENTO", "LOCAL", "CANAL"]
    good, bad = parse(raw, columns, mode="quarantine")
    kept = good.groupBy("CANAL").agg(F.count(F.lit(1)).alias("n"), F.count("UNIDADES").alias("n_units"),
                                     F.sum("UNIDADES").alias("units"), F.sum("LOCAL").alias("stores"))
    why = bad.groupBy(F.array_join("bad_columns", "+").alias("CANAL")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("long")
    return kept.withColumnRenamed("CANAL", "part").unionByName(why.select(
        F.col("CANAL").alias("part"), "n", none.alias("n_units"), none.alias("units"), none.alias("stores")))


def _as_text_files(spark, sf: str, compression: str) -> str:
    """Line items in the sales file's form: separated by semicolons, quoted, with a header and a column nobody reads."""
    item = table(spark, sf, "lineitem")
    path = scratch(spark, "sales-text")
    item.select(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("FECHA"), F.concat(F.lit('a;"'), "l_returnflag").alias("PRODUCTO"),
        F.col("l_returnflag").alias("CANAL"), F.when(F.col("l_linenumber") % 5 == 0, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("UNIDADES"),
        F.when(F.col("l_discount") > 0, F.col("l_discount").cast("string")).otherwise("NA").alias("PORCENTAJE DESCUENTO"),
        F.col("l_suppkey").cast("string").alias("LOCAL"), F.lit("x;y").alias("OTRA"),
    ).write.option("header", True).option("sep", ";").option("quoteAll", True).option("escape", '"').option("compression", compression).csv(path)
    return path


def _text_summary(data: DataFrame) -> DataFrame:
    return data.groupBy("CANAL").agg(
        F.count(F.lit(1)).alias("n"), F.count("UNIDADES").alias("n_units"), F.sum("UNIDADES").alias("units"),
        F.count("PORCENTAJE DESCUENTO").alias("n_discount"), F.round(F.sum("PORCENTAJE DESCUENTO"), 4).alias("discount"),
        F.sum("LOCAL").alias("stores"), F.date_format(F.max("FECHA"), "yyyy-MM-dd").alias("latest"), F.min("PRODUCTO").alias("product"))


@query
def text_scan_blocks(spark, sf):
    """Plain text files, scanned in blocks with declared types, by header name."""
    found = scan(spark, _as_text_files(spark, sf, "none"), [*TEXT_COLUMNS, "GENERO"])
    return _text_summary(found.data).withColumn("missing", F.lit(",".join(found.missing)))


@query
def gzip_landing_and_sink(spark, sf):
    """Gzip text landed as Parquet, taken again without landing anew, summed up, written as result tables and read back."""
    source, target, out = _as_text_files(spark, sf, "gzip"), scratch(spark, "landed"), scratch(spark, "results")
    land(spark, source, target, columns=TEXT_COLUMNS)
    before = sorted(r[0] for r in spark.read.format("binaryFile").load(target).select("path").collect())
    again = land(spark, source, target, columns=TEXT_COLUMNS)
    kept = before == sorted(r[0] for r in spark.read.format("binaryFile").load(target).select("path").collect())
    results = {"summary": _text_summary(again.data)}
    write_results(results, out)
    write_results(results, f"{out}/json", "json")
    other = spark.read.json(f"{out}/json/summary").agg(F.sum("n").alias("n")).scalar()
    return spark.read.parquet(f"{out}/summary").withColumns({"kept": F.lit(kept), "all_rows": other})


@query
def seed_from_environment(spark, sf):
    """Samples with an explicit seed, one from the environment and one where the environment holds no number."""
    rows, held = lines(spark, sf), os.environ.get(sampling.SEED_VARIABLE)
    parts = []
    try:
        for name, text, seed in (("explicit", "5", SEED), ("environment", str(SEED), None), ("no number", "x", None)):
            os.environ[sampling.SEED_VARIABLE] = text
            parts.append(sampling.seeded_sample(rows, ["row_key"], 100, seed).select(F.lit(name).alias("case"), "row_key"))
    finally:
        os.environ.pop(sampling.SEED_VARIABLE, None)
        if held is not None:
            os.environ[sampling.SEED_VARIABLE] = held
    return _stacked(*parts)


@query
def spearman_cells(spark, sf):
    return hypothesis.spearman_matrix(lines(spark, sf), ["units", "discount", "amount"]).select("a", "b", "cell")


@query
def clean_columns(spark, sf):
    """Column names of the cleaned table: no customer id, no birth date; one row each with its non-null count."""
    config = StudyConfig(columns=SalesColumns(birth="birth_text", ts="shipped"))
    clean = clean_table(sales(spark, sf, True).drop("age_years"), config)
    names = sorted(clean.columns)
    counts = clean.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in names])).alias("r")).select("r.*")


@query
def quantiles_rank_error(spark, sf):
    """Whether each approximate quantile's rank is within 1 / accuracy of what was asked."""
    points, accuracy = {"p25": 0.25, "p50": 0.5, "p75": 0.75}, 10_000
    rows = lines(spark, sf).select(F.col("amount").alias("v"))
    found = ranks.quantiles(rows, "v", points, approximate=True, accuracy=accuracy)
    one = found.select(F.struct(*points).alias("q")).scalar()
    placed = rows.withColumn("q", one).agg(F.count("v").alias("n"), *[
        c for p in points for c in (F.count_if(F.col("v") < F.col(f"q.{p}")).alias(f"{p}_lt"),
                                    F.count_if(F.col("v") <= F.col(f"q.{p}")).alias(f"{p}_le"))])
    slack = F.col("n") / accuracy + 1
    return placed.select(F.explode(F.array(*[F.struct(
        F.lit(p).alias("quantile"), ((F.col(f"{p}_lt") <= F.col("n") * at + slack) & (F.col(f"{p}_le") >= F.col("n") * at - slack))
        .alias("within")) for p, at in points.items()])).alias("r")).select("r.*")


# ---- compositions as long tables --------------------------------------------

def _long(section: str, df: DataFrame, metric, values: list[str], digits: int) -> DataFrame:
    pairs = [F.struct(F.concat_ws(" ", metric, F.lit(v)).alias("metric"),
                      F.round(F.col(v).cast("double"), digits).alias("value")) for v in values]
    return df.select(F.lit(section).alias("section"), F.explode(F.array(*pairs)).alias("r")).select("section", "r.*")


def _stacked(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def regression_report(spark, sf):
    found = least_squares_report(lines(spark, sf), "amount", ["units"], "flag", ["row_key"], ["row_key"], "N",
                                 ["N", "A", "R"], test_share=0.3, seed=SEED, exact_split=False)
    return _stacked(
        _long("coefficients", found["coefficients"], F.col("term"), ["coef", "std_err"], 5),
        _long("fit", found["fit"], F.lit("train"), ["n", "r2", "r2_adj"], 8),
        _long("holdout", found["holdout"], F.lit("test"), ["n", "rmse", "mae", "r2"], 6),
        _long("durbin_watson", found["durbin_watson"], F.lit("train"), ["n", "durbin_watson"], 6),
        _long("breusch_pagan", found["breusch_pagan"], F.lit("train"), ["statistic", "df"], 4),
        _long("residual_shapiro", found["residual_shapiro"], F.lit("sample"), ["n", "n_total", "statistic"], 5))


@query
def association_report(spark, sf):
    config = StudyConfig(columns=SalesColumns(), channels=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
                         store_range=(0, 2**31 - 1))
    found = association_suite(sales(spark, sf), config)
    return _stacked(
        _long("channel_store", found["channel_store_chi2"], F.lit("chi2"), ["statistic", "df"], 6),
        _long("store_anova", found["amount_by_store_anova"], F.lit("anova"), ["statistic"], 6),
        _long("store_kruskal", found["amount_by_store_kruskal"], F.lit("kruskal"), ["statistic"], 6))


@query
def study_summary(spark, sf):
    """The whole study as one long table: every statistic of the cleaned table's cells, tests, charts and fit."""
    config = StudyConfig(columns=SalesColumns(birth="birth_text", ts="shipped"), app_channel=URGENT, web_channel=LOW,
                         channels=CHANNELS, store_range=STORES, genders=("F", "O"), events=EVENTS, series_start=SERIES_START, seed=SEED)
    found = run_study(cut(sales(spark, sf).drop("age_years")), config)
    drawn = ("discount", "amount", "age_years")
    pair = F.concat_ws(" ", "a", "b")
    parts = [
        _long("describe", found["describe_full"], F.col("column"), ["n", "mean", "median", "std", "min", "max", "skew", "kurtosis"], 5),
        _long("scaling", found["scaling"], F.col("column"), ["mean", "std"], 5),
        _long("outliers", found["outliers"], F.lit("amount"), ["n", "n_outliers", "outlier_rate"], 6),
        _long("kolmogorov", found["normality"], F.col("column"), ["n", "ks_d"], 6),
        _long("correlations", found["correlations"].where("a < b"), pair, ["rho"], 6),
        _long("trio", found["trio_correlations"].where("a < b"), pair, ["rho"], 6),
        _long("unexpected", found["unexpected_categories"], F.lit("rows"), ["n", "n_rejected"], 0),
        _long("channel_store", found["channel_store_chi2"], F.lit("chi2"), ["statistic", "df"], 6),
        _long("boxplot", found["boxplot"], F.col("channel"), ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers"], 6),
        _long("hypotheses", found["hypotheses"].where("test <> 'slope'"), F.concat_ws(" ", "hypothesis", "test"), ["n", "statistic"], 4),
        _long("missing", found["discount_missingness"].unionByName(found["birth_missingness"]).groupBy("factor").agg(
            F.min("n_null").alias("least"), F.max("n_null").alias("most")), F.col("factor"), ["least", "most"], 0),
        _long("fit", found["ols_fit"], F.lit("train"), ["n", "r2"], 6),
        _long("holdout", found["ols_holdout"], F.lit("test"), ["n", "rmse", "mae"], 4),
    ]
    parts += [_long(f"{kind} by {factor}", found[f"amount_by_{factor}_{kind}"], F.lit("amount"), ["n", "statistic"], 5)
              for factor in ("channel", "store") for kind in ("anova", "kruskal")]
    parts += [_long(f"histogram {c}", found[f"histogram_{c}"], F.col("bin").cast("string"), ["n"], 0) for c in drawn]
    return _stacked(*parts)


@query
def temporal_report(spark, sf):
    config = StudyConfig(columns=SalesColumns(ts="o_orderdate", amount="o_totalprice"), events=EVENTS, series_start=SERIES_START)
    found = temporal_suite(table(spark, sf, "orders"), config)
    return _stacked(
        _long("daily_series", found["daily_series"], F.date_format("day", "yyyy-MM-dd"), ["value"], 2),
        _long("acf", found["acf"], F.col("lag").cast("string"), ["acf"], 6),
        _long("pacf", found["pacf"], F.col("lag").cast("string"), ["pacf"], 6))
