"""Special functions against published values and the standard library."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkinfer.functions import effects, normal, scalars, tails


@pytest.mark.parametrize("got, published, rel", [
    (lambda: tails.f_upper(152.5429, 3, 3242874), 7.367832e-99, 1e-3),
    (lambda: 2 * tails.t_upper(2.403, 2270009), 0.01626, 1e-3),
    (lambda: tails.t_upper(-5.3079, 1e5), 9.999999e-01, 1e-6),
    (lambda: tails.shapiro_upper(0.8562, 5000), 1.600758e-55, 0.05),
    (lambda: tails.shapiro_upper(0.3967, 5000), 2.901537e-84, 0.05),
    (lambda: tails.shapiro_upper(0.9797, 5000), 3.788937e-26, 0.05),
    (lambda: tails.shapiro_upper(0.5329, 5000), 1.097612e-78, 0.05),
    # the published D is rounded to 4 digits, which moves these tails by several per cent
    (lambda: tails.kolmogorov_upper(0.0487, 5000), 1.000633e-10, 0.06),
    (lambda: tails.kolmogorov_upper(0.1951, 5000), 3.514943e-167, 0.2),
    (lambda: tails.kolmogorov_upper(0.2539, 5000), 1.268822e-284, 0.3),
])
def test_published_tails(got, published, rel):
    assert float(got()) == pytest.approx(published, rel=rel)


def test_t_quantile_inverts_the_tail():
    df = np.array([1.0, 2.0, 5.0, 30.0, 1e6])
    q = tails.t_quantile(0.975, df)
    assert q[0] == pytest.approx(12.706204736, rel=1e-9)
    assert np.allclose(tails.t_upper(q, df), 0.025, rtol=1e-10)
    assert np.allclose(tails.t_quantile(0.025, df), -q)


def test_chi_square_tail_closed_forms():
    x = np.array([0.1, 1.0, 5.0, 40.0, 700.0])
    assert np.allclose(tails.gamma_upper(1.0, x / 2), np.exp(-x / 2), rtol=1e-12)
    two = np.exp(-x / 2) * (1 + x / 2)
    assert np.allclose(tails.gamma_upper(2.0, x / 2), two, rtol=1e-12)


def test_small_samples_of_kolmogorov_against_exact_formula():
    # n = 1: D = max(u, 1 - u) for uniform u, so P(D >= d) = 2 (1 - d) for d >= 1/2
    for d in (0.55, 0.7, 0.95):
        assert tails.kolmogorov_upper(d, 1) == pytest.approx(2 * (1 - d), abs=1e-12)
    # published table: P(D < 0.274) for n = 10 is 0.6285
    assert tails.kolmogorov_upper(0.274, 10) == pytest.approx(1 - 0.6284796154565043, abs=1e-9)
    # both sides of the switch to the series agree
    assert tails.kolmogorov_upper(0.012, 10_000) == pytest.approx(tails.kolmogorov_upper(0.012, 10_001), abs=1e-3)
    assert tails.kolmogorov_upper(0.0, 10) == 1.0
    assert tails.kolmogorov_upper(1.0, 10) == 0.0


def test_normal_columns(spark):
    df = spark.range(-2000, 2001).select((F.col("id") / 100.0).alias("x"),
                                         ((F.col("id") + 2000.5) / 4002).alias("p"))
    rows = df.select("x", "p", normal.norm_sf(F.col("x")).alias("sf"),
                     normal.norm_ppf(F.col("p")).alias("q")).toPandas()
    exact = np.array([0.5 * math.erfc(v / math.sqrt(2)) for v in rows.x])
    assert np.max(np.abs(rows.sf / exact - 1)) < 1e-12
    assert np.max(np.abs(rows.q - [statistics.NormalDist().inv_cdf(v) for v in rows.p])) < 1e-13


def test_normal_quantile_edges(spark):
    row = spark.range(1).select(normal.norm_ppf(F.lit(0.0)).alias("a"), normal.norm_ppf(F.lit(1.0)).alias("b"),
                                normal.norm_ppf(F.lit(None).cast("double")).alias("c")).first()
    assert list(row) == [None, None, None]


def test_missing_statistic_gives_missing_p(spark):
    null = F.lit(None).cast("double")
    row = spark.range(1).select(tails.t_p_value(null, F.lit(5)).alias("t"), tails.chi2_sf(null, F.lit(2)).alias("c"),
                                tails.f_sf(null, F.lit(2), F.lit(3)).alias("f"), tails.ks_sf(null, F.lit(9)).alias("k"),
                                tails.shapiro_sf(null, F.lit(9)).alias("s")).first()
    assert set(row) == {None}


def test_tails_agree_with_the_bundled_jvm_library(spark):
    maths = spark._jvm.org.apache.commons.math3.distribution
    for t, df in ((0.3, 4.0), (2.5, 17.0), (5.0, 200.0)):
        assert float(tails.t_upper(t, df)) == pytest.approx(1 - maths.TDistribution(df).cumulativeProbability(t), rel=1e-7)
    for f, a, b in ((0.7, 3.0, 9.0), (2.2, 5.0, 100.0)):
        assert float(tails.f_upper(f, a, b)) == pytest.approx(1 - maths.FDistribution(a, b).cumulativeProbability(f), rel=1e-7)


def test_effect_sizes(spark):
    row = spark.range(1).select(
        effects.rank_biserial(F.lit(7430.0), F.lit(63), F.lit(214)).alias("r1"),
        effects.rank_biserial(F.lit(1209372387023.5), F.lit(1055885), F.lit(2186993)).alias("r2"),
        effects.kruskal_eta2(F.lit(5950.5194), F.lit(4), F.lit(3242878)).alias("e1"),
        effects.kruskal_eta2(F.lit(51345.7439), F.lit(792), F.lit(3242878)).alias("e2"),
        effects.kruskal_eta2(F.lit(0.5), F.lit(4), F.lit(100)).alias("floor"),
        effects.cramers_v(F.lit(3242878.0), F.lit(3242878), F.lit(4), F.lit(792)).alias("v"),
        effects.cramers_v(F.lit(3.0), F.lit(10), F.lit(1), F.lit(5)).alias("none")).first()
    assert row.r1 == pytest.approx(-0.1022, abs=5e-5)
    assert row.r2 == pytest.approx(-0.0474, abs=5e-5)
    assert row.e1 == pytest.approx(0.0018, abs=5e-5)
    assert row.e2 == pytest.approx(0.0156, abs=5e-5)
    assert row.floor == 0.0
    assert row.v == pytest.approx(0.5774, abs=5e-5)
    assert row.none is None


@pytest.mark.parametrize("value, kind, name", [
    (0.05, "r", "negligible"), (-0.1, "r", "small"), (0.3, "v", "medium"), (0.5, "r", "large"),
    (0.009, "eta2", "negligible"), (0.01, "eta2", "small"), (0.06, "eta2", "medium"), (0.2, "eta2", "large"),
    (0.2, "something else", "small"), (None, "r", "undefined"), (float("nan"), "r", "undefined")])
def test_effect_labels(spark, value, kind, name):
    column = F.lit(value).cast("double")
    assert spark.range(1).select(effects.effect_label(column, kind)).first()[0] == name


def test_verdict_and_stars(spark):
    df = spark.createDataFrame([(0.0001,), (0.005,), (0.03,), (0.05,), (None,)], "p double")
    rows = df.select(effects.verdict(F.col("p")), effects.stars(F.col("p"))).collect()
    assert [r[0] for r in rows] == ["reject H0"] * 3 + ["do not reject H0", "not testable"]
    assert [r[1] for r in rows] == ["***", "**", "*", " ns", ""]


def test_row_expressions(spark):
    df = spark.createDataFrame(
        [(None, 10.0, 0, "1980-05-01", 30.0), (-0.5, 9.0, 2, "not a date", -1.0), (1.7, 8.0, None, None, 111.0),
         (0.25, None, 4, "2030-01-01", None)],
        "d double, a double, u int, born string, age double")
    rows = df.select(scalars.impute_and_clip(F.col("d")), scalars.safe_ratio(F.col("a"), F.col("u")),
                     scalars.parse_date(F.col("born")).isNull(), scalars.out_of_range(F.col("age"), 0, 110)).collect()
    assert [r[0] for r in rows] == [0.0, 0.0, 1.0, 0.25]
    assert [r[1] for r in rows] == [None, 4.5, None, None]
    assert [r[2] for r in rows] == [False, True, True, False]
    assert [r[3] for r in rows] == [False, True, True, True]


def test_years_round_down_to_whole_days(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (timestamp'2024-03-02 12:00:00', timestamp'2024-03-01 00:00:00'),
        (timestamp'2024-03-02 00:00:00', timestamp'2024-03-01 12:00:00'),
        (timestamp'2024-03-01 12:00:00', timestamp'2024-03-02 00:00:00') AS t(a, b)""")
    got = [r[0] * 365.25 for r in df.select(scalars.years_between(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1, 0, -1])


def test_tails_called_on_the_driver_still_travel_to_executors(spark):
    here = [float(tails.t_upper(2.0, 10.0)), float(tails.f_upper(2.0, 3.0, 10.0)), float(tails.gamma_upper(1.5, 2.0)),
            tails.kolmogorov_upper(0.1, 50), tails.kolmogorov_upper(0.01, 20_000)]
    row = spark.range(1).select(
        tails.t_sf(F.lit(2.0), F.lit(10)), tails.f_sf(F.lit(2.0), F.lit(3), F.lit(10)), tails.chi2_sf(F.lit(4.0), F.lit(3)),
        tails.ks_sf(F.lit(0.1), F.lit(50)), tails.ks_sf(F.lit(0.01), F.lit(20_000))).first()
    assert [round(v, 12) for v in row] == [round(v, 12) for v in here]


def test_tails_at_very_large_sizes():
    assert abs(float(tails.t_upper(2.0, 1e12)) - 0.5 * math.erfc(2 / math.sqrt(2))) < 1e-9
    assert abs(float(tails.f_upper(2.6, 3, 1e12)) - float(tails.gamma_upper(1.5, 3.9))) < 1e-9
    for z in (0.6, 1.0, 1.45, 1.5, 4.0):  # no jump where the method changes
        below, above = (tails.kolmogorov_upper(z / math.sqrt(n), n) for n in (10_000, 10_001))
        assert abs(below / above - 1) < 1e-5
    for n in (20_000, 10**6, 10**12):
        edge = math.sqrt(2.2 / n)
        low, high = tails.kolmogorov_upper(edge * (1 - 1e-9), n), tails.kolmogorov_upper(edge * (1 + 1e-9), n)
        assert abs(low / high - 1) < 1e-5
