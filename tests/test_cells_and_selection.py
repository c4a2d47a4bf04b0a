"""Counted cells, grouped selection, grouped diagnostics, sketches, exact U, intervals and QR against brute force."""

import datetime
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkinfer.operators import (cells, charts, cleaning, contingency, describe, hypothesis, joins, normality, ranks, regression,
                                  sketches, timeseries)
from sparkinfer.plans.queries import REGISTRY
from sparkinfer.sources.landing import cut

SF = "/root/testdata/sf0.001"
POINTS = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.75, "f": 0.999, "h": 1.0}


@pytest.fixture(scope="module")
def groups():
    """Groups of very different sizes and shapes; one value holds two fifths of the rows of some."""
    rng, parts = np.random.default_rng(3), []
    for i, n in enumerate([1, 2, 3, 5, 10, 30, 50, 52, 100, 270, 300, 900, 1100, 5000, 40_000]):
        for kind, v in enumerate((rng.random(n), rng.integers(0, 5, n).astype(float), np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n)),
                                  rng.lognormal(0, 3, n))):
            parts.append(pd.DataFrame({"g": float(10 * i + kind), "v": v}))
    return pd.concat(parts).sample(frac=1, random_state=1)


@pytest.mark.parametrize("few", [True, False])
def test_grouped_quantiles_are_exact_for_all_sizes(spark, groups, monkeypatch, few):
    if not few:  # the ways of many groups and of many cells
        monkeypatch.setattr(ranks, "FEW_KEYS", 3)
        monkeypatch.setattr(ranks, "SMALL", 0)
    df = spark.createDataFrame(groups).repartition(16)
    got = ranks.quantiles(df, "v", POINTS, ["g"]).toPandas().set_index("g").sort_index()
    want = groups.groupby("g").v.quantile(list(POINTS.values())).unstack()
    assert np.abs(got[list(POINTS)].to_numpy() - want.to_numpy()).max() < 1e-12
    assert got.n_values.tolist() == groups.groupby("g").size().tolist()


def test_grouped_quantiles_move_few_rows(spark, groups):
    """Rows of large groups: brackets leave well under a tenth to be shuffled."""
    df = spark.createDataFrame(groups[groups.g >= 140]).repartition(4)
    counted = cut(ranks._selected(df, "v", [0.25, 0.5, 0.75], ["g"]))
    assert counted.count() < 0.1 * (groups.g >= 140).sum()


def test_grouped_quantiles_with_null_group_and_missing_values(spark):
    rows = [(None, 1.0), (None, 3.0), ("a", None), ("a", math.nan), ("b", 2.0), ("c", math.inf), ("c", 1.0)]
    got = {r.g: (r.m, r.n_values) for r in ranks.quantiles(spark.createDataFrame(rows, "g string, v double"), "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {None: (2.0, 2), "b": (2.0, 1), "c": (math.inf, 2)}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.lognormal(0, .5, 4000), "b": rng.integers(0, 20, 4000).astype(float),
                        "c": np.where(rng.random(4000) < .1, np.nan, rng.normal(size=4000)), "k": 3.0})
    return spark.createDataFrame(pdf).repartition(5).cache()


COLUMNS = ["a", "b", "c", "k"]


def same(ours, theirs, on):
    x = ours.toPandas().sort_values(on).reset_index(drop=True)
    y = theirs.toPandas().sort_values(on).reset_index(drop=True)[x.columns]
    pd.testing.assert_frame_equal(x, y, rtol=1e-9, check_dtype=False)


@pytest.mark.parametrize("small", [True, False])
def test_cells_give_what_rows_give(table, monkeypatch, small):
    if not small:
        monkeypatch.setattr(ranks, "SMALL", 0)
        monkeypatch.setattr(ranks, "SLICE", 2)
    counted = cells.count_cells(table, COLUMNS)
    assert counted.layout.small == small
    long = describe.melt(table, COLUMNS)
    same(counted.describe_full(), describe.describe_full(table, COLUMNS), "column")
    same(counted.scaling(), cleaning.scaling_parameters(table, COLUMNS), "column")
    same(counted.kolmogorov(), normality.ks_normal(long, "value", ["column"]), "column")
    same(counted.boxplot(), charts.boxplot(long, "value", ["column"]), "column")
    same(counted.qq(50), regression.qq_points(long, "value", ["column"], 50), ["column", "point"])
    for c in COLUMNS:
        same(counted.histogram().where(F.col("column") == c).drop("column"), charts.histogram(table, c), "bin")
    fence = cleaning.iqr_fences(table, "a").first()
    assert counted.fences().where("column = 'a'").first().asDict() == {"column": "a", **fence.asDict()}


def test_cells_recoded_equal_cells_of_recoded_rows(table):
    counted, bad = cells.count_cells(table, COLUMNS), table.where("c is null or isnan(c)").count()
    moved = counted.recoded("c", F.when(F.col("value") > 0, F.col("value")).otherwise(0.5), bad)
    rows = table.withColumn("c", F.when((F.col("c") > 0) & ~F.isnan("c"), F.col("c")).otherwise(0.5))
    same(moved.only(["c"]).describe_full(), describe.describe_full(rows, ["c"]), "column")


def test_cells_ranks_on_rows(table):
    out = cells.count_cells(table, ["b"]).with_ranks(table.select("a", "b"), ["b"]).toPandas()
    want = out.b.rank() - (len(out) + 1) / 2
    assert np.allclose(out.rank_b, want)


def test_cells_of_nothing(spark):
    counted = cells.count_cells(spark.createDataFrame([], "a double, b double"), ["a", "b"])
    assert counted.describe_full().count() == counted.histogram().count() == counted.kolmogorov().count() == 0


def test_density_equals_a_direct_sum(spark):
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.lognormal(0, .5, 3000), [60.0, 60.0]])  # a far pair: kernels reach few points
    got = charts.kde_curve(spark.createDataFrame(pd.DataFrame({"v": v})), "v", 80).toPandas().sort_values("point")
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 80)
    direct = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(axis=1) / np.sqrt(2 * np.pi) / len(v) / h
    assert np.abs(got.density - direct).max() < 1e-7 * direct.max() and len(got) == 80


def test_histogram_with_a_far_outlier(spark, monkeypatch):
    monkeypatch.setattr(charts, "PIECE", 100)
    got = charts.histogram(spark.createDataFrame([(float(i % 50),) for i in range(500)] + [(40_000.0,)], "v double"), "v").toPandas()
    assert got.n.sum() == 501 and sorted(got.bin) == list(range(len(got))) and len(got) > 1000


# ---- regression by group ----------------------------------------------------


@pytest.mark.parametrize("name", ["breusch_pagan", "durbin_watson", "residual_bins", "residual_vs_fitted", "qq_points", "residual_shapiro"])
def test_residual_plans_do_not_repeat_the_fit(spark, name):
    frame = REGISTRY[name](spark, SF)
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [l_orderkey") <= 6 and len(text) < 200_000
    if name in ("breusch_pagan", "durbin_watson"):
        assert text.count("Relation [l_orderkey") <= 2


def test_grouped_fit_predicts_and_is_diagnosed_like_each_group_alone(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"id": range(900), "g": np.where(np.arange(900) % 3 == 0, None, rng.choice(list("ab"), 900)),
                        "x": rng.normal(size=900), "w": rng.normal(size=900)})
    pdf["y"] = pdf.x * pdf.g.map({"a": 1.0, "b": -2.0}).fillna(5.0) + rng.normal(size=900) * (1 + pdf.x ** 2)
    df = spark.createDataFrame(pdf, "id long, g string, x double, w double, y double").repartition(6)
    fit = regression.ols(df, "y", ["x", "w"], ["g"])
    rows = cut(fit.residuals(df, "y"))
    tables = {"bp": regression.breusch_pagan(rows, "residual", ["x", "w"], ["g"]), "dw": regression.durbin_watson(rows, "residual", ["id"], ["g"]),
              "vif": regression.vif(df, ["x", "w"], ["g"]).where("position = 1"), "held": regression.holdout_metrics(rows, "y", by=["g"])}
    found = {k: {r.g: r for r in t.collect()} for k, t in tables.items()}
    for g in (None, "a", "b"):
        part = df.where(F.col("g").eqNullSafe(F.lit(g)))
        own = regression.ols(part, "y", ["x", "w"]).residuals(part, "y")
        assert math.isclose(found["bp"][g].statistic, regression.breusch_pagan(own, "residual", ["x", "w"]).first().statistic, rel_tol=1e-9)
        assert math.isclose(found["dw"][g].durbin_watson, regression.durbin_watson(own, "residual", ["id"]).first().durbin_watson, rel_tol=1e-9)
        assert math.isclose(found["vif"][g].vif, regression.vif(part, ["x", "w"]).first().vif, rel_tol=1e-9)
        assert math.isclose(found["held"][g].rmse, regression.holdout_metrics(own, "y").first().rmse, rel_tol=1e-9)
        e = own.orderBy("id").toPandas().residual.to_numpy()
        assert math.isclose(found["dw"][g].durbin_watson, np.square(np.diff(e)).sum() / np.square(e).sum(), rel_tol=1e-9)


def test_durbin_watson_of_one_hot_group_over_many_tasks(spark):
    e = np.random.default_rng(9).normal(size=5000)
    rows = [(i, "hot" if i % 5 else f"g{i % 7}", float(v)) for i, v in enumerate(e)]
    got = {r.g: r for r in regression.durbin_watson(spark.createDataFrame(rows, "i long, g string, e double"), "e", ["i"], ["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["i", "g", "e"])
    for g, part in pdf.groupby("g"):
        assert got[g].n == len(part)
        assert math.isclose(got[g].durbin_watson, np.square(np.diff(part.e)).sum() / np.square(part.e).sum(), rel_tol=1e-9)


def test_qr_keeps_what_moments_lose(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(size=4000)
    pdf = pd.DataFrame({"x": x, "z": x + 1e-8 * rng.normal(size=4000), "twice": 2 * x, "one": 1.0})
    pdf["y"] = 1 + 2 * pdf.x + 3 * pdf.z
    df = spark.createDataFrame(pdf).repartition(40)
    got = {r.term: r for r in regression.ols_qr(df, "y", ["x", "z", "twice", "one"]).collect()}
    assert [got[t].status for t in ("const", "x", "z", "twice", "one")] == ["ok"] * 3 + ["constant or collinear"] * 2
    assert abs(got["x"].coef - 2) < 1e-5 and abs(got["z"].coef - 3) < 1e-5 and abs(got["const"].coef - 1) < 1e-9
    assert regression.ols_qr(spark.createDataFrame([], "y double, x double"), "y", ["x"]).count() == 0
    plain = regression.ols(df.withColumn("v", F.rand(3)), "y", ["x"]).coefficients.select("term", "coef", "std_err").toPandas()
    qr = regression.ols_qr(df, "y", ["x"]).select("term", "coef", "std_err").toPandas()
    assert np.allclose(plain[["coef", "std_err"]], qr[["coef", "std_err"]], rtol=1e-6)


# ---- tests and sketches -----------------------------------------------------

def test_distribution_of_u_is_counted_out():
    for n1, n2 in itertools.product(range(1, 5), range(1, 5)):
        ranks_ = range(1, n1 + n2 + 1)
        us = [sum(c) - n1 * (n1 + 1) // 2 for c in itertools.combinations(ranks_, n1)]
        want = np.bincount(us, minlength=n1 * n2 + 1) / len(us)
        assert np.allclose(hypothesis.u_distribution(n1, n2), want)
    assert math.isclose(hypothesis.u_distribution(20, 20).sum(), 1.0)


def test_exact_and_normal_groups_are_named(spark):
    rows = [("exact", g, v) for g, v in zip("aabbb", (1.0, 2.0, 3.0, 4.0, 5.0))] + [("tied", g, 1.0) for g in "aab"] + [("one", "a", 1.0)]
    rows += [("large", "ab"[i % 2], float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, g string, v double")
    got = {r.k: r for r in hypothesis.mann_whitney_exact(df, "v", "g", "a", "b", ["k"]).collect()}
    assert got["exact"].method == "exact" and math.isclose(got["exact"].p_value, 2 / 10)
    assert got["tied"].status == "degenerate" and got["one"].status == "too few rows" and got["large"].method == "normal"
    less = hypothesis.mann_whitney_exact(df.where("k = 'exact'"), "v", "g", "a", "b", alternative="less").first()
    assert math.isclose(less.p_value, 1 / 10)


def test_francia_equals_a_plain_sum(spark):
    rng = np.random.default_rng(11)
    from statistics import NormalDist
    for v in (rng.normal(size=700), np.round(rng.normal(size=3000)), rng.integers(0, 3, 2000).astype(float)):
        x = np.sort(v)
        m = np.array([NormalDist().inv_cdf((i - 0.375) / (len(x) + 0.25)) for i in range(1, len(x) + 1)])
        got = normality.shapiro_francia(spark.createDataFrame(pd.DataFrame({"v": v})), "v").first()
        assert got.n == len(v) and math.isclose(got.statistic, np.corrcoef(x, m)[0, 1] ** 2, rel_tol=2e-7)
    few = normality.shapiro_francia(spark.createDataFrame([(1.0,)] * 9, "v double"), "v").first()
    assert few.status == "degenerate" and few.p_value is None


def test_sketches_merge_to_what_one_pass_finds(spark):
    df = spark.range(60_000).select((F.col("id") % 7).cast("string").alias("d"), (F.col("id") % 3).cast("string").alias("g"),
                                    F.pmod(F.xxhash64("id"), F.lit(20_000)).alias("k"), F.rand(1).alias("v"))
    kept = sketches.distinct_sketches(df, "k", ["g", "d"])
    for r in sketches.distinct_rollup(kept, ["g"]).collect():
        exact = df.where(F.col("g") == r.g if r.g is not None else F.lit(True)).select("k").distinct().count()
        assert abs(r.n_keys - exact) <= 0.03 * exact and r.level == (r.g is None)
    merged = sketches.merged_quantiles(sketches.quantile_sketches(df, "v", ["g", "d"]), {"p50": 0.5, "p99": 0.99}).first()
    assert abs(merged.p50 - 0.5) < 0.03 and abs(merged.p99 - 0.99) < 0.01 and merged.n_values == 60_000


def test_margins_of_large_tables_take_the_salted_way(spark, monkeypatch):
    rows = [("a" if i % 3 else None, f"s{i % 40}", i % 2, "h" if i % 5 else "k") for i in range(2000)]
    df = spark.createDataFrame(rows, "f string, a string, b int, g string")
    small = contingency.chi2_independence(df, "a", "g", ["f"]).orderBy("f").collect()
    monkeypatch.setattr(contingency, "FEW_KEYS", 1)
    assert contingency.chi2_independence(df, "a", "g", ["f"]).orderBy("f").collect() == small
    assert len(small) == 2 and small[0].f is None and small[0].status == "ok"


def test_hot_keys_of_attach_are_spread(spark):
    """A key with a third of all rows passes the shuffle under many salts."""
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    found = joins.attach(rows, rows.groupBy("k").agg(F.count("*").alias("w")), ["k"], "w")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "__salt" in plan.split("SortMergeJoin", 1)[-1] or "BroadcastHashJoin" in plan
    assert found.where("k = 7").agg(F.min("w"), F.count("w")).first()[:] == (10_001 - 1 + (7 % 3 != 0), 10_000 + (7 % 3 != 0))


def test_intervals_of_any_length(spark):
    rng = np.random.default_rng(12)
    start = datetime.date(1999, 12, 1)
    days = [(g, start + datetime.timedelta(int(i)), int(i), 1.0) for g in "ab" for i in range(900)]
    spans = []
    for _ in range(40):
        a = int(rng.integers(-300, 1100))
        spans.append(("ab"[int(rng.integers(2))], start + datetime.timedelta(a), start + datetime.timedelta(a + int(rng.choice([0, 1, 5, 63, 64, 400, -3])))))
    spans += [("a", None, start), ("b", start, None)]
    series = spark.createDataFrame(days, "g string, day date, pos int, value double")
    marked = spark.createDataFrame(spans, "g string, s date, e date")
    for by in ([], ["g"]):
        got = {(r.g, r.day): r.is_special for r in timeseries.interval_flags(series, marked, "s", "e", by).collect()}
        want = {(g, d): any(s and e and s <= d <= e and (not by or g == h) for h, s, e in spans) for g, d, *_ in days}
        assert got == want
    none = timeseries.interval_flags(series, marked.where("s is null"), "s", "e")
    assert none.where("is_special").count() == 0
