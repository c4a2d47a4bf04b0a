"""Global order without a single-task sort: ranks with ties and exact quantiles.

A probe first reads a thin hash slice of the distinct values. It tells whether the
distinct values are few enough for one ordered window, and otherwise where to cut
them into ranges. Each range is then ordered in its own task and the rows before
it are added as an offset. Cut points are plain numbers fixed before the job
starts, so every branch of a plan and every retry agrees on them; they only
balance the work, any cut points give the same result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import number, present
from sparkinfer.operators.joins import FEW_KEYS, attach, join_on
from sparkinfer.sources.landing import cut

# One hash value in SLICE is probed. Up to SMALL distinct cells go to one ordered window.
SLICE = 64
SMALL = 1_000_000
SAMPLE_PER_RANGE = 8
# Approximate quantiles that bracket exact ones have an error of at most 1 / RESOLUTION; brackets
# reach this far to both sides, by the size of the group.
RESOLUTION = 1000
REACHES = (0.004, 0.012, 0.06, 1.0)
# Groups that are ordered whole: rows of one task, and the most that a group may have. Their sizes
# are bounded by those of this many buckets of groups.
TASK_ROWS = 500_000
GROUP_BUCKETS = 1 << 16


@dataclass(frozen=True)
class Layout:
    """How to order a set of values: at once, or in ranges between ``cuts``."""

    small: bool
    cuts: tuple[float, ...] = ()


def range_count(spark: SparkSession) -> int:
    """Ranges per ordering: twice the shuffle width, within 32 and 4096."""
    return max(32, min(4096, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def cut_points(drawn: Sequence[float], ranges: int) -> tuple[float, ...]:
    """At most ``ranges - 1`` cut points that split a sample evenly.

    Midpoints are used so that a value carrying rounding noise does not sit on a cut.
    """
    values = sorted(set(drawn))
    cuts = []
    for i in range(1, ranges):
        j = i * len(values) // ranges
        if j >= 1:
            middle = values[j - 1] / 2 + values[j] / 2
            if math.isfinite(middle) and (not cuts or middle > cuts[-1]):
                cuts.append(middle)
    return tuple(cuts)


def probe(df: DataFrame, value: str, by: Sequence[str] = ()) -> Layout:
    """Decide the layout for ordering ``value``; one narrow job over the column.

    The slice holds about 1/SLICE of the distinct (by, value) cells, chosen by hash
    of the cell itself, so a hot value counts once. What reaches the driver is
    bounded by SMALL/SLICE and the number of ranges.
    """
    ranges = range_count(df.sparkSession)
    limit = max(SMALL // SLICE + 1, SAMPLE_PER_RANGE * ranges)
    cells = present(df, value).select(*by, F.col(value).cast("double").alias("value"))
    digest = F.xxhash64(*by, "value")
    picked = (cells.where(F.pmod(digest, F.lit(SLICE)) == 0).distinct()
              .select("value", digest.alias("h")).orderBy("h", "value").limit(limit))
    drawn = picked.select("value").toPandas()["value"].tolist()
    if len(drawn) * SLICE <= SMALL:
        return Layout(True)
    return Layout(False, cut_points(drawn, ranges))


def value_counts(df: DataFrame, value: str, by: Sequence[str] = (),
                 extra: Sequence[str] = ()) -> DataFrame:
    """Distinct values per group with their row count: (by, extra, value, n)."""
    return (present(df, value).select(*by, *extra, F.col(value).cast("double").alias("value"))
            .groupBy(*by, *extra, "value").agg(F.count(F.lit(1)).alias("n")))


def locate(rows: DataFrame, cuts: Sequence[float]) -> DataFrame:
    """Add ``range``, the number of cut points at or below ``value``."""
    if not cuts:
        return rows.withColumn("range", F.lit(0.0))
    splits = [-math.inf, *cuts, math.inf]
    return Bucketizer(splits=splits, inputCol="value", outputCol="range").transform(rows)


def range_offsets(located: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group and range: rows before it, rows in it, rows of the whole group.

    At most one row per range and group enters each window partition.
    """
    ordered = Window.partitionBy(*by).orderBy("range")
    whole = Window.partitionBy(*by)
    return (located.groupBy(*by, "range").agg(F.sum("n").alias("inside"))
            .withColumn("before", F.sum("inside").over(ordered) - F.col("inside"))
            .withColumn("total", F.sum("inside").over(whole)))


def cumulative_counts(cells: DataFrame, by: Sequence[str], layout: Layout, keep=None) -> DataFrame:
    """Add the running position of every value within its group.

    ``cells`` has (by, ..., value, n); several rows may share a value (for example
    one per sample). Adds ``tied`` (rows with this value), ``cum_le`` (rows at or
    below it) and ``total``. ``keep(before, inside, total)`` may restrict a ranged
    layout to the ranges that matter.
    """
    by = list(by)
    if layout.small:
        running, peers = Window.partitionBy(*by).orderBy("value"), Window.partitionBy(*by, "value")
        return (cells.withColumn("cum_le", F.sum("n").over(running))
                .withColumn("tied", F.sum("n").over(peers if by else running.rangeBetween(0, 0)))
                .withColumn("total", F.sum("n").over(Window.partitionBy(*by))))
    located = locate(cells, layout.cuts)
    offsets = range_offsets(located, by)
    if keep is not None:
        offsets = offsets.where(keep(F.col("before"), F.col("inside"), F.col("total")))
    placed = join_on(located, offsets.drop("inside"), [*by, "range"], small=not by)
    running = Window.partitionBy(*by, "range").orderBy("value")
    peers = Window.partitionBy(*by, "range", "value")
    return (placed.withColumn("cum_le", F.col("before") + F.sum("n").over(running))
            .withColumn("tied", F.sum("n").over(peers)).drop("before", "range"))


def whole_groups(df: DataFrame, by: Sequence[str]) -> DataFrame | None:
    """Rows dealt by group to tasks of about ``TASK_ROWS`` rows, or None where a group may be larger than that.

    No group is larger than its bucket of groups, and counting buckets moves a few numbers a task. The
    number of tasks follows the rows, so their memory does not grow with the table.
    """
    buckets = df.groupBy(F.pmod(F.xxhash64(*by), F.lit(GROUP_BUCKETS)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    size = buckets.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (size["most"] or 0) > TASK_ROWS:
        return None
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-(size["rows"] or 0) // TASK_ROWS))
    return df.repartition(tasks, *by)


def rank_cells(cells: DataFrame, by: Sequence[str], layout: Layout) -> DataFrame:
    """Average rank of every value (ties share the mean of their positions)."""
    return cumulative_counts(cells, by, layout).withColumn(
        "avg_rank", F.col("cum_le") - (F.col("tied") - F.lit(1)) / F.lit(2.0))


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank table: (by, value, n, avg_rank, tie_term, total) with tie_term = t^3 - t."""
    ranked = rank_cells(value_counts(df, value, by), by, probe(df, value, by))
    t = F.col("tied").cast("double")
    return ranked.select(*by, "value", "n", "avg_rank", (t * t * t - t).alias("tie_term"), "total")


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float],
              by: Sequence[str] = (), approximate: bool = False,
              accuracy: int = 10_000, layout: Layout | None = None) -> DataFrame:
    """Quantiles with linear interpolation, one output column per named probability.

    Exact by default. With groups, a first pass brackets every wanted position of every group
    and a second one counts (see :func:`_selected`). Without groups, or with a given ``layout``,
    values that need ranges are cut, and only the ranges that hold a wanted position are ordered.
    """
    by = list(by)
    names, points = list(probabilities), list(probabilities.values())
    if approximate:
        array = F.percentile_approx(number(value), F.array(*[F.lit(float(p)) for p in points]),
                                    F.lit(accuracy))
        return (df.groupBy(*by).agg(array.alias("q"), F.count(number(value)).alias("n_values"))
                .select(*by, *[F.get("q", F.lit(i)).alias(nm) for i, nm in enumerate(names)],
                        "n_values"))

    def keep(before, inside, total):
        hit = F.lit(False)
        for p in points:
            for at in (F.floor(position(p, total)), F.ceil(position(p, total))):
                hit = hit | ((at >= before) & (at < before + inside))
        return hit

    if by and layout is None:
        return _interpolated(_selected(df, value, points, by), names, points, by)
    layout = layout or probe(df, value, by)
    if by or layout.small:
        placed = cumulative_counts(value_counts(df, value, by), by, layout, keep)
    else:
        placed = _bracketed(df, value, layout, keep)
    return _interpolated(placed, names, points, by)


def position(p: float, total):
    """0-based place of a quantile among ``total`` ordered rows, with a fraction."""
    return F.lit(float(p)) * (total - F.lit(1))


def _interpolated(placed: DataFrame, names: Sequence[str], points: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles from cells with running positions (by, value, cum_le, total)."""
    total = F.col("total")
    parts = []
    for i, p in enumerate(points):
        for side, at in (("lo", F.floor(position(p, total))), ("hi", F.ceil(position(p, total)))):
            parts.append(F.min(F.when(F.col("cum_le") > at, F.col("value"))).alias(f"{side}{i}"))
    found = placed.groupBy(*by).agg(*parts, F.max("total").alias("total"))
    out = []
    for i, (name, p) in enumerate(zip(names, points)):
        share = position(p, total) - F.floor(position(p, total))
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        # equal neighbours are returned as they are, which also covers infinities
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * share).alias(name))
    return found.select(*by, *out, F.coalesce(total, F.lit(0)).cast("long").alias("n_values"))


def cell_quantiles(counted: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of counted values (by, value, n), best stored, as they are read for the layout and for the order."""
    by, points = list(by), list(probabilities.values())
    placed = cumulative_counts(counted, by, probe(counted, "value", by))
    return _interpolated(placed, list(probabilities), points, by)


def _selected(df: DataFrame, value: str, points: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Cells around the wanted positions of every group, with running positions.

    Pass one brackets each position by two approximate quantiles, further apart than their error
    bound (small groups: further apart, the smallest: all values), in partial aggregates. Pass two
    counts: values in a bracket become cells of their own, all others of a group fall into one cell
    a gap between brackets. So under one in a hundred rows a position is shuffled, a hot group
    is no more than its cells, and the ordered cells give the exact positions. A wanted
    position that lies in a gap would be an error and is reported as one, never answered.
    """
    rows = present(df, value).select(*by, F.col(value).cast("double").alias("value"))
    marks = [m for reach in REACHES for p in points for m in (max(0.0, p - reach), min(1.0, p + reach))]
    n, each = F.col("__rows"), 2 * len(points)
    sketch = rows.groupBy(*by).agg(F.percentile_approx("value", F.array(*map(F.lit, marks)), F.lit(RESOLUTION)).alias("__marks"),
                                   F.count(F.lit(1)).alias("__rows"))
    # three ranks of room beside the error bound, so that rounding cannot leave a bracket
    level = F.when(n > 0, len(REACHES) - 1)
    for i, reach in reversed(list(enumerate(REACHES[:-1]))):
        level = F.when(n * (reach - 1.0 / RESOLUTION) >= 3, F.lit(i)).otherwise(level)
    first = cut(sketch.select(*by, "__rows", F.slice("__marks", level * each + 1, F.lit(each)).alias("__marks")))
    size = first.agg(F.sum("__rows").alias("rows"), F.count(F.lit(1)).alias("groups")).first()
    if size["groups"] <= FEW_KEYS:
        placed = join_on(rows, first, by, small=True)
    else:
        placed = attach(rows, first, by, "__rows", nulls=True)
    inside, gap = F.lit(False), F.lit(0)
    for i in range(len(points)):
        low, high = F.get("__marks", F.lit(2 * i)), F.get("__marks", F.lit(2 * i + 1))
        inside = inside | F.col("value").between(low, high)
        gap = gap + (F.col("value") > high).cast("int")
    cells = (placed.select(*by, "value", gap.alias("gap"), inside.alias("whole"))
             .groupBy(*by, "gap", "whole", F.when(F.col("whole"), F.col("value")).alias("cell"))
             .agg(F.min("value").alias("value"), F.count(F.lit(1)).alias("n")))
    layout = Layout(True)
    if (size["rows"] or 0) * min(1.0, 3 * REACHES[0] * len(points)) > SMALL:
        cells = cut(cells)
        layout = probe(cells, "value", by)
    counted = cumulative_counts(cells, by, layout)
    missed = F.raise_error(F.lit("a quantile lies outside its bracket"))
    wanted = F.lit(False)
    for p in points:
        for at in (F.floor(position(p, F.col("total"))), F.ceil(position(p, F.col("total")))):
            wanted = wanted | ((F.col("cum_le") > at) & (F.col("cum_le") - F.col("n") <= at))
    checked = F.when(F.col("whole") | ~wanted | (F.col("n") == 1), F.col("value")).otherwise(missed.cast("double"))
    return counted.withColumn("value", checked)


def _bracketed(df: DataFrame, value: str, layout: Layout, keep) -> DataFrame:
    """Cumulative counts of only those value ranges that ``keep`` selects."""
    located = locate(present(df, value).select(F.col(value).cast("double").alias("value")), layout.cuts)
    offsets = range_offsets(located.withColumn("n", F.lit(1).cast("long")), []).where(
        keep(F.col("before"), F.col("inside"), F.col("total"))).drop("inside")
    wanted = join_on(located, offsets, ["range"], small=True)
    cells = wanted.groupBy("range", "before", "total", "value").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("range").orderBy("value")
    return cells.withColumn("cum_le", F.col("before") + F.sum("n").over(running))


def medians(df: DataFrame, value: str, by: Sequence[str] = (), layout: Layout | None = None) -> DataFrame:
    return quantiles(df, value, {"median": 0.5}, by, layout=layout)
