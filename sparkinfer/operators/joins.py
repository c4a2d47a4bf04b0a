"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkinfer.sources.landing import cut

# A key is "hot" when it holds more than 1/HOT_SHARE of all rows, so there are
# always fewer than HOT_SHARE hot keys: that is the proven bound of the broadcast.
HOT_SHARE = 1024
#: Ways over which settled rows pass a join that they take no part in.
SALTS = 1 << 20
#: A measured table of up to this many keys is broadcast.
FEW_KEYS = 50_000


def same(left: DataFrame, right: DataFrame, pairs) -> Column:
    """Null-safe equality over pairs of column names."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
            small: bool = False) -> DataFrame:
    """Join on same-named keys where NULL matches NULL; the keys appear once.

    ``small`` is set only where the row count of ``right`` is bounded by
    construction; otherwise the strategy is left to the optimizer.
    """
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    if small:
        renamed = F.broadcast(renamed)
    condition = same(left, renamed, [(k, f"__{k}") for k in keys])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__{k}" for k in keys])


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str,
           how: str = "left", nulls: bool = False) -> DataFrame:
    """Look up ``table`` (one row per key, ``weight`` = rows per key) from every row.

    ``rows`` is read once. Rows of hot keys take their values from a broadcast of the hot
    part of the table; with those without a key they pass the join of the others under
    salts that match nothing, so that no task gets more than 1/HOT_SHARE of the rows
    for one key. Columns of
    ``table`` other than the keys are added, ``weight`` included. Rows with a NULL
    key match nothing, unless ``nulls``: then NULL is a key like any other, as it is
    for groups.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    values = [c for c in table.columns if c not in keys]
    has_key = F.lit(True) if nulls else reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed = table.where(has_key)
    total = keyed.agg(F.sum(weight).alias("t")).scalar()
    heavy = F.col(weight) * F.lit(HOT_SHARE) > total

    def renamed(part, value):
        return part.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*values).alias(value))

    def on(left, right):
        return reduce(lambda a, b: a & b, [
            left[k].eqNullSafe(right[f"__{k}"]) if nulls else left[k] == right[f"__{k}"] for k in keys])

    hot = F.broadcast(renamed(keyed.where(heavy), "__hot"))
    marked = rows.join(hot, on(rows, hot), "left").select(*rows.columns, "__hot")
    settled = F.col("__hot").isNotNull() | ~has_key
    spread = F.lit(1) + F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    salted = marked.withColumn("__salt", F.when(settled, spread).otherwise(F.lit(0)))
    # always 0, but no literal: the optimizer would take a constant out of the join's keys, and the salts with it
    zero = F.pmod(F.xxhash64(*[F.col(f"__{k}") for k in keys]), F.lit(1).cast("long"))
    cold = renamed(keyed.where(~heavy), "__cold").withColumn("__zero", zero)
    joined = salted.join(cold, on(salted, cold) & (salted["__salt"] == cold["__zero"]), "left")
    value = F.coalesce("__hot", "__cold")
    found = joined if how == "left" else joined.where(value.isNotNull())
    return found.select(*rows.columns, *[value.getField(v).alias(v) for v in values])


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, how: str = "left",
           nulls: bool = False) -> DataFrame:
    """As :func:`attach`, for a table that is mostly small: it is stored and measured first.

    With at most ``FEW_KEYS`` keys it is broadcast and ``rows`` are not shuffled; with more they
    take the way of :func:`attach`.
    """
    table = cut(table)
    return place(rows, table, keys, weight, table.limit(FEW_KEYS + 1).count() <= FEW_KEYS, how, nulls)


def place(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, few: bool, how: str = "left",
          nulls: bool = False) -> DataFrame:
    """The lookup itself, where ``few`` says that the table has been measured to hold at most ``FEW_KEYS`` keys."""
    if not few:
        return attach(rows, table, keys, weight, how, nulls)
    right = F.broadcast(table.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in table.columns if c not in keys]))
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(right[f"__{k}"]) if nulls else rows[k] == right[f"__{k}"] for k in keys])
    return rows.join(right, on, how).drop(*[f"__{k}" for k in keys])


def frequency(df: DataFrame, key: str, output: str = "frequency") -> DataFrame:
    """Number of rows sharing each row's key; rows without a key count as 1."""
    counts = (df.where(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias(output)))
    joined = lookup(df, counts, [key], output)
    return joined.withColumn(output, F.coalesce(F.col(output), F.lit(1)).cast("long"))


def distinct_keys(df: DataFrame, key: str, output: str = "n_keys") -> DataFrame:
    """Number of distinct non-null keys."""
    return df.agg(F.count_distinct(F.col(key)).alias(output))


def with_group(df: DataFrame, by: Sequence[str], source: DataFrame | None = None,
               **aggregates: Column) -> DataFrame:
    """Add per-group aggregates of ``source`` (default: ``df`` itself) to every row.

    Meant for tables of groups or values. Without groups the aggregates arrive as
    one scalar subquery row; with groups through a join on the group columns.
    """
    by, source = list(by), df if source is None else source
    if by:
        table = source.groupBy(*by).agg(*[c.alias(a) for a, c in aggregates.items()])
        return join_on(df, table, by)
    row = source.agg(F.struct(*[c.alias(a) for a, c in aggregates.items()]).alias("r")).scalar()
    return (df.withColumn("__r", row)
            .select(*df.columns, *[F.col("__r").getField(a).alias(a) for a in aggregates]))
