"""Whole analyses: hypothesis suite, regression report and the full study."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkinfer.functions.effects import verdict
from sparkinfer.functions.scalars import number, out_of_range, outside, present
from sparkinfer.operators import charts, cleaning, contingency, hypothesis, joins
from sparkinfer.operators import normality, regression, sampling, timeseries
from sparkinfer.operators.cells import ColumnCells, count_cells
from sparkinfer.sources.landing import cut

# Categories a sale may carry, and the store numbers in use.
EXPECTED_CHANNELS = ("APP", "WEB", "POS", "CCT", "SUCURSAL")
STORE_RANGE = (1, 9999)
# Commercial dates looked at, and the end of the ramp-up period.
SPECIAL_DATES = (
    ("Mother's Day", "2024-05-12"),
    ("Christmas (1)", "2023-12-24"),
    ("Christmas (2)", "2023-12-25"),
    ("National Holidays (1)", "2024-09-18"),
    ("National Holidays (2)", "2024-09-19"),
    ("Children's Day", "2024-08-10"),
    ("Cyber Day (1)", "2024-06-03"),
    ("Cyber Day (2)", "2024-06-04"),
    ("Cyber Day (3)", "2024-06-05"),
    ("Black Friday", "2023-11-24"),
)
RAMP_UP_END = "2024-03-01"


@dataclass
class SalesColumns:
    """Which columns of a table play which part."""

    ts: str = "ts"
    channel: str = "channel"
    store: str = "store"
    units: str = "units"
    discount: str = "discount"
    amount: str = "amount"
    customer: str = "customer_id"
    gender: str = "gender"
    birth: str | None = None
    age: str = "age_years"


@dataclass
class StudyConfig:
    columns: SalesColumns = field(default_factory=SalesColumns)
    keys: Sequence[str] = ("row_key",)
    channels: Sequence[str] = EXPECTED_CHANNELS
    store_range: tuple[int, int] = STORE_RANGE
    app_channel: str = "APP"
    web_channel: str = "WEB"
    genders: tuple = (1, 2)
    baseline: str | None = None
    events: Sequence[tuple[str, str]] = SPECIAL_DATES
    event_days: int = 7
    series_start: str | None = RAMP_UP_END
    test_share: float = 0.3
    seed: int | None = None


def event_table(spark, events: Sequence[tuple[str, str]]) -> DataFrame:
    return (spark.createDataFrame([tuple(e) for e in events], "name string, day string")
            .withColumn("day", F.to_date("day")))


def clean_table(df: DataFrame, config: StudyConfig) -> DataFrame:
    """Impute, derive, count purchases per customer, repair ages; customer id is dropped."""
    return clean_with_cells(df, config)[0]


def clean_with_cells(df: DataFrame, config: StudyConfig) -> tuple[DataFrame, ColumnCells]:
    """The cleaned table and the counted cells of its numeric columns.

    The derived table is stored once. One scan of it counts the cells; the age that replaces
    invalid ones and the fences of the amount come from them, so repairs are plain expressions
    and the cells are repaired in place of being counted again.
    """
    c = config.columns
    out = cleaning.derive(df, discount=c.discount, amount=c.amount, units=c.units, sold_at=c.ts,
                          birth=c.birth, age=c.age)
    if c.birth is not None:
        out = out.drop(c.birth)
    base = cut(joins.frequency(out, c.customer).drop(c.customer))
    cells = count_cells(base, [c.units, c.discount, c.amount, "amount_per_unit", c.age, "frequency"])
    low, high = cleaning.MIN_AGE, cleaning.MAX_AGE
    found = cells.only([c.age], F.col("value").between(low, high)).quantiles({"median": 0.5}).first()
    middle = found["median"] if found and found["median"] is not None else cleaning.FALLBACK_AGE
    known = cells.counted.where(F.col("column") == c.age).agg(F.sum("n")).first()[0] or 0

    def repaired(age):
        return F.when(out_of_range(age, low, high), F.lit(middle)).otherwise(age)

    cells = cells.recoded(c.age, repaired(F.col("value")), base.count() - known)
    fence = cells.fences().where(F.col("column") == c.amount).first()
    limits = (fence["low"], fence["high"]) if fence else (None, None)
    flag = outside(number(c.amount), *[F.lit(x).cast("double") for x in limits])
    return base.withColumn(c.age, repaired(number(c.age))).withColumn("is_outlier", flag), cells


def _row(name: str, test: str, result: DataFrame, n, effect=None) -> DataFrame:
    null = F.lit(None)
    label = F.col("effect_label") if effect is not None else null.cast("string")
    return result.select(
        F.lit(name).alias("hypothesis"), F.lit(test).alias("test"), n.cast("long").alias("n"),
        F.col("statistic").cast("double").alias("statistic"), F.col("p_value"),
        (effect if effect is not None else null).cast("double").alias("effect"),
        label.alias("effect_label"), "status")


@dataclass(frozen=True)
class RankedStudy:
    """Rows of the clean table with the ranks of its numeric columns, stored once, and what tests read from them.

    Ranks are those over all rows, so this holds where no numeric column lacks a value and every
    level has at least two rows; :func:`rank_study` checks both.
    """

    rows: DataFrame
    cells: ColumnCells
    correlations: DataFrame
    config: StudyConfig

    @property
    def age_frequency(self) -> DataFrame:
        pair = (F.col("a") == self.config.columns.age) & (F.col("b") == "frequency")
        status = F.when(F.col("n") < 2, "too few rows").when(F.col("rho").isNull(), "degenerate").otherwise("ok")
        return self.correlations.where(pair).select("n", "rho", "p_value", status.alias("status"))

    def kruskal(self, value: str, group: str) -> DataFrame:
        t = F.col("tied").cast("double")
        ties = self.cells.ranked.where(F.col("column") == value).agg(F.sum(F.col("n") * (t * t - 1))).scalar()
        levels = self.rows.groupBy(group).agg(F.count(F.lit(1)).alias("m"), F.sum(f"rank_{value}").alias("shift"))
        share = F.col("m") / F.sum("m").over(Window.partitionBy())  # one row a level
        return hypothesis.h_test(levels.withColumn("ties", ties * share))


def rank_study(clean: DataFrame, cells: ColumnCells, config: StudyConfig) -> RankedStudy | None:
    """Attach the ranks of the numeric columns to the clean table, if they serve all tests (see :class:`RankedStudy`)."""
    c = config.columns
    columns = [c.units, c.discount, c.amount, c.age, "frequency"]
    found = {r["column"]: r["n"] for r in cells.moments.select("column", "n").collect()}
    if len({found.get(x, 0) for x in columns} | {clean.count()}) > 1:
        return None
    rows = cut(cells.with_ranks(clean.select(c.channel, c.store, *columns), columns).drop(*columns))
    least = rows.groupBy(c.channel).count().select("count").unionByName(rows.groupBy(c.store).count().select("count")).agg(F.min("count"))
    missing = rows.where(F.col(c.channel).isNull() | F.col(c.store).isNull())
    if (least.first()[0] or 0) < 2 or not missing.isEmpty():
        return None
    matrix = cut(hypothesis.spearman_of_ranks(rows, columns, [f"rank_{x}" for x in columns]))
    return RankedStudy(rows, cells, matrix, config)


def hypothesis_suite(df: DataFrame, config: StudyConfig, frequency: str = "frequency",
                     alpha: float = 0.05, ranked: RankedStudy | None = None) -> DataFrame:
    """Five questions, each with its tests; ``decides`` marks the p-value that counts."""
    c = config.columns
    both = F.col("n1") + F.col("n2")
    app, web = config.app_channel, config.web_channel
    one, two = config.genders
    h2 = hypothesis.simple_regression(df, c.units, c.discount)
    rho = hypothesis.spearman(df, c.age, frequency) if ranked is None else ranked.age_frequency
    parts = [
        (_row("app_over_web", "welch_t", hypothesis.welch_t(
            df, c.amount, c.channel, app, web, alternative="greater"), both), False),
        (_row("app_over_web", "mann_whitney", hypothesis.mann_whitney(
            df, c.amount, c.channel, app, web, alternative="greater"), both, F.col("effect")), True),
        (_row("discount_moves_units", "slope", h2, F.col("n")), True),
        (_row("gender_amount", "welch_t", hypothesis.welch_t(df, c.amount, c.gender, one, two), both), True),
        (_row("gender_amount", "mann_whitney", hypothesis.mann_whitney(
            df, c.amount, c.gender, one, two), both, F.col("effect")), False),
        (_row("age_frequency", "spearman", rho.withColumnRenamed("rho", "statistic"), F.col("n")), True),
        (_row("discount_by_channel", "anova", hypothesis.anova_oneway(
            df, c.discount, c.channel), F.col("n")), False),
        (_row("discount_by_channel", "kruskal", hypothesis.kruskal_wallis(df, c.discount, c.channel) if ranked is None
              else ranked.kruskal(c.discount, c.channel), F.col("n"), F.col("effect")), True),
    ]
    out = None
    for part, decides in parts:
        part = part.withColumn("decides", F.lit(decides))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("verdict", verdict(F.col("p_value"), alpha))


def association_suite(df: DataFrame, config: StudyConfig, ranked: RankedStudy | None = None) -> dict[str, DataFrame]:
    """Chi-square of channel and store, rank correlations, and amount by channel and store."""
    c = config.columns
    valid = cleaning.expected_levels(df, c.channel, c.store, config.channels, config.store_range)
    trio = [c.units, c.amount, c.discount]
    out = {"unexpected_categories": cleaning.rejected_count(df, valid),
           "channel_store_chi2": contingency.chi2_independence(df.where(valid), c.channel, c.store),
           "trio_correlations": (hypothesis.spearman_matrix(df, trio) if ranked is None else
                                 ranked.correlations.where(F.col("a").isin(trio) & F.col("b").isin(trio)))}
    for factor in (c.channel, c.store):
        out[f"amount_by_{factor}_anova"] = hypothesis.anova_oneway(df, c.amount, factor)
        out[f"amount_by_{factor}_kruskal"] = (hypothesis.kruskal_wallis(df, c.amount, factor) if ranked is None
                                              else ranked.kruskal(c.amount, factor))
    return out


def regression_report(df: DataFrame, y: str, numeric: Sequence[str], factor: str | None,
                      keys: Sequence[str], order: Sequence[str], baseline=None, levels=None,
                      test_share: float = 0.3, seed: int | None = None,
                      exact_split: bool = True) -> dict[str, DataFrame]:
    """Train/test least squares with coefficients, hold-out errors and diagnostics."""
    rows = present(df, y, *numeric, *([factor] if factor else []))
    xs = list(numeric)
    if factor:
        rows, dummies = cleaning.one_hot(rows, factor, levels, baseline)
        xs += dummies
    split = sampling.split_flag_exact if exact_split else sampling.split_flag
    needed = list(dict.fromkeys([y, *xs, *keys, *order]))
    flagged = cut(split(rows.select(*needed), keys, test_share, seed))  # ten tables read it
    train, test = flagged.where("not is_test"), flagged.where("is_test")
    model = regression.ols(train, y, xs)
    fitted, held = model.residuals(train, y), model.residuals(test, y)
    return {
        "coefficients": model.coefficients,
        "fit": model.fit,
        "holdout": regression.holdout_metrics(held, y),
        "breusch_pagan": regression.breusch_pagan(fitted, "residual", xs),
        "residual_shapiro": normality.shapiro_wilk(fitted, "residual", keys, seed=seed),
        "durbin_watson": regression.durbin_watson(fitted, "residual", order),
        "vif": regression.vif(rows, xs),
        "residual_bins": charts.histogram(held, "residual", 50),
        "residual_vs_fitted": charts.binned_scatter(held, "predicted", "residual"),
        "qq_points": regression.qq_points(fitted, "residual"),
    }


def temporal_suite(df: DataFrame, config: StudyConfig) -> dict[str, DataFrame]:
    """Daily series, decomposition, correlograms and the effect of special dates."""
    c = config.columns
    series = timeseries.daily_series(df, c.ts, c.amount)
    events = event_table(df.sparkSession, config.events)
    return {
        "daily_series": series,
        "decomposition": timeseries.seasonal_decompose(series, 7),
        "acf": timeseries.acf(series, 30),
        "pacf": timeseries.pacf(series, 30),
        "event_calendar": timeseries.event_calendar(events, series),
        "event_days": timeseries.event_flags(series, events, config.event_days),
        "event_impact": timeseries.event_impact(series, events, config.series_start, config.event_days),
    }


def run_study(df: DataFrame, config: StudyConfig | None = None) -> dict[str, DataFrame]:
    """The whole analysis as named result tables.

    What many tables read is computed while the plan is made and stored: the cleaned table, the
    counted cells of its numeric columns, their order, the ranked rows and the training rows. The
    result tables are lazy over these; nothing but result tables leaves the cluster.
    """
    config = config or StudyConfig()
    c = config.columns
    results: dict[str, DataFrame] = {
        "discount_missingness": contingency.missingness(df, c.discount, [c.channel])}
    if c.birth is not None:
        results["birth_missingness"] = contingency.missingness(df, c.birth, [c.channel, c.store])
    results["customers"] = joins.distinct_keys(df, c.customer)
    clean, cells = clean_with_cells(df, config)
    ranked = rank_study(clean, cells, config)
    numeric = [c.units, c.discount, c.amount, "amount_per_unit", c.age, "frequency"]
    scaled, drawn = numeric[1:], [c.discount, c.amount, c.age]
    scaling = cut(cells.scaling().where(F.col("column").isin(scaled)))
    shown = cells.only(drawn)
    bins, curves = cut(shown.histogram()), cut(shown.density())
    results |= {
        "clean": cleaning.standardize(clean, scaled, parameters=scaling),
        "outliers": cells.outliers(c.amount),
        "scaling": scaling,
        "describe": cells.describe(),
        "describe_full": cells.describe_full(),
        "normality": normality.normality(clean, drawn, config.keys, seed=config.seed, distances=shown.kolmogorov()),
        "correlations": (ranked.correlations if ranked else
                         hypothesis.spearman_matrix(clean, [c.units, c.discount, c.amount, c.age, "frequency"])),
        "boxplot": charts.boxplot(clean, c.amount, [c.channel]),
    }
    for column in drawn:
        results[f"histogram_{column}"] = bins.where(F.col("column") == column).drop("column")
        results[f"density_{column}"] = curves.where(F.col("column") == column).drop("column")
    results |= association_suite(clean, config, ranked)
    results |= temporal_suite(clean, config)
    results["hypotheses"] = hypothesis_suite(clean, config, ranked=ranked)
    report = regression_report(clean, c.amount, [c.discount], c.channel, config.keys, list(config.keys),
                               config.baseline, test_share=config.test_share, seed=config.seed)
    results |= {f"ols_{name}": table for name, table in report.items()}
    return results
