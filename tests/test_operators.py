"""Operators against brute force, edge cases, and independence of partitioning."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkinfer.operators import (charts, cleaning, contingency, describe, hypothesis, joins, normality, ranks,
                                  reconcile, regression, sampling, timeseries)


@pytest.fixture(scope="module")
def mixed(spark):
    """3,000 rows; a third share one value, one key and one group."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append((i, "hot" if hot else f"k{rng.randrange(200)}", "A" if hot else rng.choice("ABC"),
                     5.0 if hot else round(rng.lognormvariate(1, 2), 3), float(rng.randrange(12)),
                     None if rng.random() < 0.1 else rng.gauss(0, 1)))
    return spark.createDataFrame(rows, "id long, key string, g string, x double, y double, z double").cache()


@pytest.fixture
def ranged(monkeypatch):
    """Force the ranged layout that large tables get."""
    monkeypatch.setattr(ranks, "SMALL", 0)
    monkeypatch.setattr(ranks, "SLICE", 2)


def _rank_table(df):
    p = df.toPandas()
    p["rank"] = p["x"].rank(method="average")
    return p.groupby("x")["rank"].first().to_dict()


def test_small_layout_is_chosen_for_few_values(mixed):
    assert ranks.probe(mixed, "x").small


def test_ranged_ranks_match_brute_force(mixed, ranged):
    layout = ranks.probe(mixed, "x")
    assert not layout.small and len(layout.cuts) > 10
    got = {r.value: r.avg_rank for r in ranks.average_ranks(mixed, "x").collect()}
    assert got == _rank_table(mixed)


def test_ranged_ranks_by_group(mixed, ranged):
    got = {(r.g, r.value): r.avg_rank for r in ranks.average_ranks(mixed, "x", ["g"]).collect()}
    p = mixed.toPandas()
    p["rank"] = p.groupby("g")["x"].rank()
    assert got == p.groupby(["g", "x"])["rank"].first().to_dict()


@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranged_quantiles(mixed, ranged, by):
    points = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.773, "e": 1.0}
    rows = ranks.quantiles(mixed, "x", points, by).collect()
    p = mixed.toPandas()
    for r in rows:
        values = p["x"] if not by else p[p.g == r.g]["x"]
        assert [r[n] for n in points] == pytest.approx(list(values.quantile(list(points.values()))))
        assert r.n_values == len(values)


def test_ranged_and_small_tests_agree(mixed, monkeypatch):
    def all_tests():
        return [hypothesis.kruskal_wallis(mixed, "x", "g").first(), hypothesis.spearman(mixed, "x", "y").first(),
                hypothesis.mann_whitney(mixed, "x", "g", "A", "B").first(), normality.ks_normal(mixed, "x").first(),
                hypothesis.spearman_matrix(mixed, ["x", "y", "z"]).orderBy("a", "b").collect()[1]]
    small = all_tests()
    monkeypatch.setattr(ranks, "SMALL", 0)
    monkeypatch.setattr(ranks, "SLICE", 2)
    for a, b in zip(small, all_tests()):
        for u, v in zip(a, b):
            assert u == pytest.approx(v) if isinstance(u, float) else u == v


def test_results_do_not_depend_on_partitioning(mixed):
    def snapshot(df):
        return (sorted(r.id for r in sampling.seeded_sample(df, ["id"], 100, 1).collect()),
                sorted(r.id for r in sampling.seeded_sample(df, ["id"], 20, 1, ["g"]).collect()),
                sorted(r.id for r in sampling.split_flag_exact(df, ["id"], 0.3, 1).where("is_test").collect()),
                sorted((r.value, r.avg_rank) for r in ranks.average_ranks(df, "x").collect()),
                round(hypothesis.kruskal_wallis(df, "x", "g").first().statistic, 8),
                round(regression.durbin_watson(df, "x", ["id"]).first().durbin_watson, 10))
    first = snapshot(mixed.coalesce(1))
    for n in (4, 16):
        assert snapshot(mixed.orderBy(F.xxhash64("id", F.lit(n))).repartition(n)) == first


def test_sample_sizes(mixed):
    assert sampling.seeded_sample(mixed, ["id"], 5000, 3).count() == 3000
    sizes = {r.g: r.n for r in describe.group_sizes(sampling.seeded_sample(mixed, ["id"], 50, 3, ["g"]), ["g"]).collect()}
    assert set(sizes.values()) == {50}
    flagged = sampling.split_flag_exact(mixed, ["id"], 0.3, 3)
    assert flagged.where("is_test").count() == math.ceil(0.3 * 3000)
    share = sampling.split_flag(mixed, ["id"], 0.3, 3).where("is_test").count() / 3000
    assert abs(share - 0.3) < 0.05


def test_seed_resolution(monkeypatch):
    monkeypatch.setenv(sampling.SEED_VARIABLE, "17")
    assert sampling.resolve_seed() == 17 and sampling.resolve_seed(3) == 3
    monkeypatch.setenv(sampling.SEED_VARIABLE, "x")
    assert sampling.resolve_seed() == 42
    monkeypatch.delenv(sampling.SEED_VARIABLE)
    assert sampling.resolve_seed() == 42


def test_frequency_with_hot_and_missing_keys(spark, mixed):
    holes = mixed.withColumn("key", F.when(F.col("id") % 5 != 0, F.col("key")))
    got = {r.id: r.frequency for r in joins.frequency(holes, "key").collect()}
    p = holes.toPandas()
    n = p.groupby("key")["id"].transform("size").fillna(1).astype(int)
    assert got == dict(zip(p["id"], n))


def test_attach_keeps_every_row(spark, mixed):
    counts = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    assert joins.attach(mixed, counts, ["key"], "n").where(F.col("n").isNull()).count() == 0
    some = counts.where("key in ('hot', 'k1')")
    n = some.agg(F.sum("n")).first()[0]
    assert joins.attach(mixed, some, ["key"], "n", "inner").count() == n
    left = joins.attach(mixed, some, ["key"], "n")
    assert left.count() == 3000 and left.where("n is not null").count() == n


def test_describe_shapes(spark):
    df = spark.createDataFrame([(1.0, 3.0, None), (2.0, 3.0, None), (9.0, 3.0, None), (4.0, 3.0, None)],
                               "a double, c double, e double")
    rows = {r.column: r for r in describe.describe(df, ["a", "c", "e"]).collect()}
    assert rows["a"].skew == pytest.approx(0.768417, abs=1e-6)
    assert rows["a"].kurtosis == pytest.approx(-1.0)
    assert rows["a"]["std"] == pytest.approx(3.559026, abs=1e-6)
    assert rows["c"].skew is None and rows["c"].kurtosis is None and rows["c"]["std"] == 0.0
    assert rows["e"].n == 0 and rows["e"]["mean"] is None
    full = {r.column: r for r in describe.describe_full(df, ["a", "c", "e"]).collect()}
    assert full["a"].skew == pytest.approx(1.330938, abs=1e-6)
    assert full["a"].kurtosis == pytest.approx(1.5)
    assert full["a"].median == 3.0 and full["c"].median == 3.0 and full["e"].median is None
    scaled = cleaning.standardize(df, ["a", "c"]).collect()
    assert [r.c_scaled for r in scaled] == [0.0] * 4
    assert sum(r.a_scaled for r in scaled) == pytest.approx(0.0)
    params = {r.column: r for r in cleaning.scaling_parameters(df, ["a"]).collect()}
    assert params["a"]["std"] == pytest.approx(3.082207, abs=1e-6)


def test_age_repair(spark):
    df = spark.createDataFrame([(30.0,), (50.0,), (-2.0,), (None,), (111.0,)], "age double")
    assert sorted(r.age for r in cleaning.impute_invalid(df, "age").collect()) == [30.0, 40.0, 40.0, 40.0, 50.0]
    assert tuple(cleaning.invalid_count(df, "age").first()) == (5, 3)
    none = spark.createDataFrame([(-2.0,), (None,)], "age double")
    assert [r.age for r in cleaning.impute_invalid(none, "age").collect()] == [35.0, 35.0]


def test_outliers_keep_rows_and_ignore_missing(spark):
    df = spark.createDataFrame([(float(v),) for v in range(20)] + [(500.0,), (None,)], "x double")
    got = cleaning.flag_outliers(df, "x")
    assert got.count() == 22
    assert [r.x for r in got.where("is_outlier").collect()] == [500.0]


def test_one_hot_baseline(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), ("c",)], "g string")
    wide, names = cleaning.one_hot(df, "g")
    assert names == ["g_c", "g_a"]
    assert wide.agg(F.sum("g_c"), F.sum("g_a")).first() == (2.0, 1.0)
    assert cleaning.one_hot(df, "g", baseline="a")[1] == ["g_b", "g_c"]


def test_yates_correction(spark):
    df = spark.createDataFrame([("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 5, "r string, c string")
    row = contingency.chi2_independence(df, "r", "c").first()
    n, a, b, c, d = 65, 10, 20, 30, 5
    expected = n * (abs(a * d - b * c) - n / 2) ** 2 / (30 * 35 * 40 * 25)
    assert row.statistic == pytest.approx(expected) and row.df == 1


def test_empty_cells_count_as_expected(spark):
    df = spark.createDataFrame([("a", "x")] * 4 + [("b", "y")] * 5 + [("c", "z")] * 6, "r string, c string")
    row = contingency.chi2_independence(df, "r", "c").first()
    assert row.statistic == pytest.approx(30.0) and row.df == 4
    assert row.cramers_v == pytest.approx(1.0)


def test_missingness_not_testable(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, v double")
    row = contingency.missingness(df, "v", ["g"]).first()
    assert row.mechanism == "not testable" and row.p_value is None and row.n_null == 0
    gone = contingency.missingness(df.withColumn("v", F.lit(None).cast("double")), "v", ["g"]).first()
    assert gone.mechanism == "not testable" and gone.null_rate == 1.0


def test_degenerate_inputs_are_reported(spark):
    flat = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 2.0), ("b", 1.0, 3.0), ("b", 1.0, 4.0)], "g string, x double, y double")
    for row in (hypothesis.welch_t(flat, "x", "g", "a", "b").first(), hypothesis.mann_whitney(flat, "x", "g", "a", "b").first(),
                hypothesis.kruskal_wallis(flat, "x", "g").first(), hypothesis.anova_oneway(flat, "x", "g").first(),
                hypothesis.spearman(flat, "x", "y").first(), hypothesis.simple_regression(flat, "x", "y").first(),
                normality.ks_normal(flat, "x").first(), normality.shapiro_of_sample(flat, "x").first()):
        assert row.status == "degenerate" and row.p_value is None
    empty = flat.where("x > 5")
    for row in (hypothesis.welch_t(empty, "x", "g", "a", "b").first(), hypothesis.mann_whitney(empty, "x", "g", "a", "b").first(),
                hypothesis.kruskal_wallis(empty, "x", "g").first(), hypothesis.anova_oneway(empty, "x", "g").first(),
                hypothesis.spearman(empty, "x", "y").first(), hypothesis.simple_regression(empty, "x", "y").first()):
        assert row.status == "too few rows" and row.p_value is None
    lonely = flat.where("g = 'a'")
    assert hypothesis.kruskal_wallis(lonely, "y", "g").first().status == "too few rows"
    assert hypothesis.mann_whitney(lonely, "y", "g", "a", "b").first().status == "too few rows"


def test_single_row_groups_are_left_out(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0), ("b", 5.0), ("c", 99.0)], "g string, x double")
    assert hypothesis.kruskal_wallis(df, "x", "g").first().n == 4
    assert hypothesis.anova_oneway(df, "x", "g").first().n_groups == 2


def test_spearman_perfect_orders(spark):
    df = spark.createDataFrame([(float(i), float(i ** 3), float(-i)) for i in range(20)], "a double, b double, c double")
    assert hypothesis.spearman(df, "a", "b").first().rho == pytest.approx(1.0)
    down = hypothesis.spearman(df, "a", "c").first()
    assert down.rho == pytest.approx(-1.0) and down.p_value == pytest.approx(0.0, abs=1e-12)


def test_shapiro_small_samples(spark):
    # published example: 11 weights, W = 0.79 (Shapiro and Wilk 1965)
    weights = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    row = normality.shapiro_of_sample(spark.createDataFrame([(float(w),) for w in weights], "x double"), "x").first()
    assert row.statistic == pytest.approx(0.79, abs=0.005) and row.p_value == pytest.approx(0.0067, abs=0.001)
    three = normality.shapiro_of_sample(spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double"), "x").first()
    assert three.statistic == pytest.approx(27 / 28, abs=1e-4)
    two = normality.shapiro_of_sample(spark.createDataFrame([(1.0,), (2.0,)], "x double"), "x").first()
    assert two.status == "too few rows" and two.p_value is None


def test_weekly_pattern_is_recovered(spark):
    pattern = [3.0, -1.0, 4.0, -2.0, 0.0, -5.0, 1.0]
    rows = [(f"2024-01-{d + 1:02d}", 100.0 + pattern[d % 7]) for d in range(21)]
    df = spark.createDataFrame(rows, "ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    series = timeseries.daily_series(df, "ts", "v")
    out = timeseries.seasonal_decompose(series).orderBy("pos").collect()
    assert [r.seasonal for r in out[:7]] == pytest.approx(pattern)
    assert [r.trend for r in out[:3]] == [None] * 3 and [r.trend for r in out[-3:]] == [None] * 3
    assert all(abs(r.residual) < 1e-9 for r in out[3:-3])


def test_even_period_uses_half_weights(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 3, 2, 6, 4, 8, 5])], "pos long, value double")
    df = df.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("pos").cast("int")))
    trend = [r.trend for r in timeseries.seasonal_decompose(df, 4).orderBy("pos").collect()]
    assert trend[2] == pytest.approx((1 / 2 + 3 + 2 + 6 + 4 / 2) / 4) and trend[:2] == [None, None]


def test_gap_filling_and_groups(spark):
    df = spark.createDataFrame([("a", "2024-02-27 10:00:00", 1.0), ("a", "2024-02-27 23:00:00", 2.0), ("a", "2024-03-02 01:00:00", 5.0),
                                ("b", "2024-01-01 00:00:00", 7.0)], "g string, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    rows = timeseries.daily_series(df, "ts", "v", ["g"]).orderBy("g", "day").collect()
    assert [(r.g, r.pos, r.value) for r in rows] == [("a", 0, 3.0), ("a", 1, 0.0), ("a", 2, 0.0), ("a", 3, 0.0), ("a", 4, 5.0), ("b", 0, 7.0)]


def test_pacf_solves_the_yule_walker_equations(spark):
    rng = np.random.default_rng(5)
    v = [0.0, 0.0]
    for e in rng.normal(size=300):
        v.append(0.6 * v[-1] - 0.3 * v[-2] + e)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "pos long, value double")
    r = [x.acf for x in timeseries.acf(df, 8).orderBy("lag").collect()]
    got = [x.pacf for x in timeseries.pacf(df, 8).orderBy("lag").collect()]
    for k in range(1, 9):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert got[k] == pytest.approx(np.linalg.solve(toeplitz, r[1:k + 1])[-1], abs=1e-10)
    flat = timeseries.pacf(spark.createDataFrame([(i, 2.0) for i in range(10)], "pos long, value double"), 3)
    assert all(x.pacf is None for x in flat.where("lag > 0").collect())


def test_events_outside_the_series_are_ignored(spark):
    df = spark.createDataFrame([(f"2024-01-{d:02d}", float(d)) for d in range(1, 31)], "ts string, v double").withColumn("ts", F.to_timestamp("ts"))
    series = timeseries.daily_series(df, "ts", "v")
    events = spark.createDataFrame([("in", "2024-01-20"), ("late", "2024-02-02")], "name string, day string").withColumn("day", F.to_date("day"))
    assert {r.name: r.in_range for r in timeseries.event_calendar(events, series).collect()} == {"in": True, "late": False}
    flagged = timeseries.event_flags(series, events, 2).where("is_special").collect()
    assert sorted(r.day.day for r in flagged) == [18, 19, 20, 21, 22]
    row = timeseries.event_impact(series, events, "2024-01-05", 2).first()
    assert (row.n_special, row.n_normal) == (5, 21) and row.median_special == 20.0


def _reference_fit(p, y, xs):
    a = np.column_stack([np.ones(len(p)), *[p[x] for x in xs]])
    beta, *_ = np.linalg.lstsq(a, p[y], rcond=None)
    e = p[y] - a @ beta
    s2 = e @ e / (len(p) - a.shape[1])
    return beta, np.sqrt(s2 * np.diag(np.linalg.inv(a.T @ a))), e


def test_ols_against_lstsq_with_large_offsets(spark):
    rng = np.random.default_rng(3)
    p = pd.DataFrame({"a": rng.normal(1e7, 1, 500), "b": rng.uniform(-1, 1, 500)})
    p["y"] = 3 + 2 * (p.a - 1e7) - 4 * p.b + rng.normal(size=500)
    model = regression.ols(spark.createDataFrame(p), "y", ["a", "b"])
    rows = model.coefficients.orderBy("position").collect()
    shifted = p.assign(a=p.a - 1e7)
    beta, se, e = _reference_fit(shifted, "y", ["a", "b"])
    assert [r.coef for r in rows[1:]] == pytest.approx(list(beta[1:]), rel=1e-6)
    assert [r.std_err for r in rows[1:]] == pytest.approx(list(se[1:]), rel=1e-6)
    fit = model.fit.first()
    assert fit.rss == pytest.approx(float(e @ e), rel=1e-6)
    held = regression.holdout_metrics(model.residuals(spark.createDataFrame(p), "y"), "y").first()
    assert held.rmse == pytest.approx(math.sqrt(float(e @ e) / 500), rel=1e-6)


def test_rank_deficiency_is_named(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, float(i * i % 7)) for i in range(30)], "a double, b double, c double, y double")
    model = regression.ols(df, "y", ["a", "b", "c"])
    status = {r.term: r.status for r in model.coefficients.collect()}
    assert status == {"const": "ok", "a": "ok", "b": "constant or collinear", "c": "constant or collinear"}
    assert model.fit.first().status == "rank deficient"
    assert {r.status for r in regression.vif(df, ["a", "b"]).collect()} == {"singular"}
    assert {r.term: r.vif for r in regression.vif(df, ["a", "c"]).collect()} == pytest.approx({"a": 1.0, "c": 1.0})


def test_durbin_watson_over_many_ranges(spark):
    rng = np.random.default_rng(9)
    e = rng.normal(size=1000)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(e)], "i long, e double").orderBy(F.rand(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = regression.durbin_watson(df, "e", ["i"]).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert row.n == 1000
    assert row.durbin_watson == pytest.approx(float(np.square(np.diff(e)).sum() / np.square(e).sum()))


def test_histogram_counts_every_row(mixed):
    rows = charts.histogram(mixed, "x", 25).collect()
    counts, edges = np.histogram(mixed.toPandas()["x"], 25)
    assert [r.n for r in sorted(rows)] == list(counts)
    assert sum(r.density * (r.high - r.low) for r in rows) == pytest.approx(1.0)
    flat = charts.histogram(mixed.withColumn("one", F.lit(1.0)), "one", 4).orderBy("bin").collect()
    assert [r.n for r in flat] == [0, 0, 3000, 0] and flat[0].low == 0.5


def test_kde_close_to_direct_sum(mixed):
    p = mixed.where("z is not null").toPandas()["z"].to_numpy()
    h = p.std(ddof=1) * len(p) ** -0.2
    rows = charts.kde_curve(mixed, "z", 50).orderBy("point").collect()
    direct = [np.exp(-0.5 * ((r.x - p) / h) ** 2).sum() / (len(p) * h * math.sqrt(2 * math.pi)) for r in rows]
    assert [r.density for r in rows] == pytest.approx(direct, rel=1e-4, abs=1e-7)


def test_comparisons(spark):
    actual = spark.createDataFrame([("n", 10.0), ("m", 1.0004), ("bad", 2.0)], "metric string, value double")
    expected = spark.createDataFrame([("n", 10.0, True), ("m", 1.0, False), ("bad", 1.0, False), ("gone", 1.0, False)],
                                     "metric string, value double, is_count boolean")
    assert {r.metric: r.status for r in reconcile.check_expected(actual, expected).collect()} == {
        "n": "PASS", "m": "PASS", "bad": "FAIL", "gone": "MISSING"}
    other = spark.createDataFrame([("n", 10.0), ("m", 1.0004 + 1e-14), ("extra", 2.0)], "metric string, value double")
    assert {r.metric: r.status for r in reconcile.compare_runs(actual, other).collect()} == {
        "n": "IDENTICAL", "m": "IDENTICAL", "bad": "MISSING_IN_ONE", "extra": "MISSING_IN_ONE"}
