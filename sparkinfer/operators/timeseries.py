"""Daily series, seasonal decomposition, autocorrelation and event windows.

A series has one row per calendar day, so a window over one series is bounded by
the calendar, not by the fact table; many series (``by``) run in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import number
from sparkinfer.operators.hypothesis import u_test
from sparkinfer.operators.joins import join_on
from sparkinfer.operators.ranks import Layout, rank_cells, value_counts
from sparkinfer.sources.landing import cut

Z_95 = 1.959963984540054
# A day series is bounded by the calendar, so it needs no probe and no ranges.
CALENDAR = Layout(True)
# Days are numbered from here, and intervals of up to 2^DAY_LEVELS days are few blocks.
EPOCH = "0001-01-01"
DAY_LEVELS = 22


def daily_series(df: DataFrame, ts: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum per calendar day with missing days as 0: (by, day, pos, value)."""
    by = list(by)
    daily = (df.where(F.col(ts).isNotNull()).groupBy(*by, F.to_date(ts).alias("day"))
             .agg(F.coalesce(F.sum(number(value)), F.lit(0.0)).alias("value")))
    order, whole = Window.partitionBy(*by).orderBy("day"), Window.partitionBy(*by)
    until = F.coalesce(F.date_sub(F.lead("day").over(order), 1), F.col("day"))
    gaps = (daily.withColumn("until", until).withColumn("start", F.min("day").over(whole))
            .withColumn("each", F.explode(F.sequence("day", "until"))))
    return gaps.select(*by, F.col("each").alias("day"),
                       F.date_diff("each", "start").cast("long").alias("pos"),
                       F.when(F.col("each") == F.col("day"), F.col("value")).otherwise(F.lit(0.0)).alias("value"))


def seasonal_decompose(series: DataFrame, period: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Additive decomposition: centred moving average, phase means, remainder."""
    by, half = list(by), period // 2
    order = Window.partitionBy(*by).orderBy("pos")
    frame = order.rowsBetween(-half, half)
    total, weight = F.sum("value").over(frame), float(period)
    if period % 2 == 0:  # the two end days of an even window count half each
        total = total - (F.lag("value", half).over(order) + F.lead("value", half).over(order)) / 2
    trend = F.when(F.count("value").over(frame) == 2 * half + 1, total / F.lit(weight))
    staged = (series.withColumn("trend", trend)
              .withColumn("phase", F.pmod(F.col("pos"), F.lit(period))))
    mean = F.avg(F.col("value") - F.col("trend")).over(Window.partitionBy(*by, "phase"))
    # the first ``period`` days hold each phase once, so their mean is the mean of the phases
    centre = F.avg(F.when(F.col("pos") < period, F.col("mean"))).over(Window.partitionBy(*by))
    out = staged.withColumn("mean", mean).withColumn("seasonal", F.col("mean") - centre)
    return out.select(*by, "day", "pos", "value", "trend", "seasonal",
                      (F.col("value") - F.col("trend") - F.col("seasonal")).alias("residual"))


def acf(series: DataFrame, lags: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Autocorrelation for lags 0..lags with Bartlett's 95% half-width."""
    by = list(by)
    order = Window.partitionBy(*by).orderBy("pos")
    dev = F.col("value") - F.avg("value").over(Window.partitionBy(*by))
    shifted = series.withColumn("d", dev).select(
        *by, "d", *[F.lag("d", k).over(order).alias(f"d{k}") for k in range(1, lags + 1)])
    folded = shifted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("d") * F.col("d")).alias("s0"),
        *[F.sum(F.col("d") * F.col(f"d{k}")).alias(f"s{k}") for k in range(1, lags + 1)])
    rows = [F.struct(F.lit(k).cast("long").alias("lag"),
                     (F.col(f"s{k}") / F.nullif(F.col("s0"), F.lit(0.0))).alias("acf"))
            for k in range(lags + 1)]
    long = (folded.select(*by, "n", F.explode(F.array(*rows)).alias("r"))
            .select(*by, "n", "r.lag", "r.acf").where(F.col("lag") < F.col("n")))
    earlier = Window.partitionBy(*by).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    power = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(earlier), F.lit(0.0))
    return long.select(*by, "lag", "n", "acf", F.when(F.col("lag") > 0, F.lit(Z_95) * F.sqrt(
        (F.lit(1.0) + 2 * power) / F.col("n"))).otherwise(F.lit(0.0)).alias("band"))


def _dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + v)


def pacf(series: DataFrame, lags: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Partial autocorrelation (Yule-Walker) with the 1.96/sqrt(n) half-width.

    Durbin's recursion over the ``lags + 1`` autocorrelations of each series. The
    state is the list of order-k coefficients and the partial values found so far.
    """
    by = list(by)
    curves = acf(series, lags, by).groupBy(*by).agg(
        F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))),
                                           lambda p: p["acf"]).alias("r"))

    def step(state, k):
        phi, r = state["phi"], F.col("r")
        recent = F.slice(r, F.lit(2), k - 1)                      # r_1 .. r_{k-1}
        gap = F.get(r, k) - _dot(phi, F.reverse(recent))
        last = gap / F.nullif(F.lit(1.0) - _dot(phi, recent), F.lit(0.0))
        shifted = F.zip_with(phi, F.reverse(phi), lambda x, y: x - last * y)
        return F.struct(F.concat(shifted, F.array(last)).alias("phi"),
                        F.concat(state["out"], F.array(last)).alias("out"))

    # nullable elements: an undefined coefficient stays NULL
    one = F.when(F.size("r") > 0, F.lit(1.0))
    start = F.struct(F.array().cast("array<double>").alias("phi"), F.array(one).alias("out"))
    orders = F.when(F.size("r") > 1, F.sequence(F.lit(1), F.size("r") - 1)).otherwise(F.array().cast("array<int>"))
    solved = curves.withColumn("out", F.aggregate(orders, start, step, lambda state: state["out"]))
    return (solved.select(*by, "n", F.posexplode("out").alias("lag", "pacf"))
            .select(*by, F.col("lag").cast("long").alias("lag"), "n", "pacf",
                    F.when(F.col("lag") > 0, F.lit(Z_95) / F.sqrt(F.col("n"))).otherwise(F.lit(0.0)).alias("band")))


def event_calendar(events: DataFrame, series: DataFrame) -> DataFrame:
    """Which events (name, day) fall inside the days covered by the series."""
    span = series.agg(F.struct(F.min("day").alias("start"), F.max("day").alias("stop")).alias("s")).scalar()
    return (events.withColumn("__s", span)
            .withColumn("in_range", F.coalesce(F.col("day").between(F.col("__s.start"), F.col("__s.stop")),
                                               F.lit(False))).drop("__s"))


def event_flags(series: DataFrame, events: DataFrame, days: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Mark the days within ``days`` of an event that lies inside the series.

    Each event becomes its 2*days+1 calendar days, so membership is an equality
    join on the day.
    """
    near = (events.select(F.col("day").alias("event"), F.explode(
        F.sequence(F.date_sub("day", days), F.date_add("day", days))).alias("day"))
        .groupBy("day").agg(F.collect_set("event").alias("events")))
    whole = Window.partitionBy(*by)
    spanned = (series.withColumn("start", F.min("day").over(whole))
               .withColumn("stop", F.max("day").over(whole)))
    hit = F.exists("events", lambda e: e.between(F.col("start"), F.col("stop")))
    return (spanned.join(near, "day", "left").select(
        *series.columns, F.coalesce(hit, F.lit(False)).alias("is_special")))


def _dyadic(start: Column, stop: Column) -> Column:
    """The day numbers start..stop as at most two blocks a level: structs (level, block) of 2^level aligned days each."""
    kind = "array<struct<level:int,block:bigint>>"
    seed = F.struct(start.cast("long").alias("s"), stop.cast("long").alias("e"), F.array().cast(kind).alias("out"))

    def step(state: Column, level: Column) -> Column:
        s, e = state["s"], state["e"]
        odd, even = (s <= e) & (F.pmod(s, F.lit(2)) == 1), F.pmod(e, F.lit(2)) == 0
        first = F.when(odd, F.array(F.struct(level.alias("level"), s.alias("block")))).otherwise(F.array().cast(kind))
        s1 = F.when(odd, s + 1).otherwise(s)
        last = (s1 <= e) & even
        more = F.when(last, F.array(F.struct(level.alias("level"), e.alias("block")))).otherwise(F.array().cast(kind))
        e1 = F.when(last, e - 1).otherwise(e)
        done = s1 > e1
        # an empty range stays empty whatever is halved
        return F.struct(F.when(done, F.lit(1).cast("long")).otherwise(F.shiftright(s1, 1)).alias("s"),
                        F.when(done, F.lit(0).cast("long")).otherwise(F.shiftright(e1, 1)).alias("e"),
                        F.concat(state["out"], first, more).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(DAY_LEVELS)), seed, step, lambda state: state["out"])


def interval_flags(series: DataFrame, intervals: DataFrame, start: str, stop: str, by: Sequence[str] = (),
                   output: str = "is_special") -> DataFrame:
    """Mark the days that lie in any interval (start and stop included, of any and unequal lengths).

    An interval becomes at most two aligned blocks of days a level (a century is some thirty rows, a
    day is one) and each day knows its block on every level that intervals use, so membership is an
    equality join and neither side grows with the lengths. With ``by`` intervals hold for their
    own group. Intervals with a NULL end, or that end before they start, mark nothing.
    """
    by = list(by)
    number_of = [F.datediff(F.col(c).cast("date"), F.lit(EPOCH).cast("date")) for c in (start, stop)]
    blocks = (intervals.where(F.col(start).isNotNull() & F.col(stop).isNotNull()).select(
        *by, F.explode(_dyadic(*number_of)).alias("__b")).select(*by, "__b.level", "__b.block").distinct())
    blocks = cut(blocks)
    levels = [r[0] for r in blocks.select("level").distinct().collect()]  # at most DAY_LEVELS + 1
    if not levels:
        return series.withColumn(output, F.lit(False))
    day = F.datediff("day", F.lit(EPOCH).cast("date")).cast("long")
    places = F.array(*[F.struct(F.lit(x).alias("level"), F.shiftright(day, x).alias("block")) for x in sorted(levels)])
    met = (series.select(*by, "day").distinct().withColumn("__b", F.explode(places)).select(*by, "day", "__b.level", "__b.block"))
    hit = join_on(met, blocks, [*by, "level", "block"], "left_semi").select(*by, "day").distinct().withColumn("__hit", F.lit(True))
    return join_on(series, hit, [*by, "day"], "left").withColumn(output, F.coalesce("__hit", F.lit(False))).drop("__hit")


def event_impact(series: DataFrame, events: DataFrame, start=None, days: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Compare event days with normal days: sizes, means, medians, Mann-Whitney U, for each series.

    ``start`` leaves out the ramp-up days before it (the events are still judged
    against the whole series). Day totals are rounded to 1e-6 before ranking so
    that summation order cannot split ties.
    """
    by = list(by)
    flagged = event_flags(series, events, days, by).withColumn("value", F.round("value", 6))
    if start is not None:
        flagged = flagged.where(F.col("day") >= F.lit(start).cast("date"))
    cells = value_counts(flagged, "value", by, ["is_special"])
    ranked = rank_cells(cells, by, CALENDAR)

    def side(flag):
        inside = F.col("is_special") == flag
        rows = F.when(inside, F.col("n"))
        mean = F.sum(F.when(inside, F.col("value") * F.col("n"))) / F.nullif(F.sum(rows), F.lit(0))
        return mean, F.percentile(F.when(inside, F.col("value")), F.lit(0.5), F.col("n"))

    (mean_special, median_special), (mean_normal, median_normal) = side(True), side(False)
    test = u_test(ranked, "is_special", by, mean_special=mean_special, mean_normal=mean_normal,
                  median_special=median_special, median_normal=median_normal)
    return test.withColumnsRenamed({"n1": "n_special", "n2": "n_normal"})
