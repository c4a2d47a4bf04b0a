"""Seeded samples and splits that do not depend on how the data is partitioned.

A row's place is decided by a digest of its key columns and the seed. The key
should identify a row; rows that share a key stay together in a split.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import stable_hash
from sparkinfer.operators.joins import lookup

DEFAULT_SEED = 42
SEED_VARIABLE = "SPARKINFER_SEED"
DIGEST_VALUES = 16 ** 8
#: Digits of the digest prefixes that are counted: few enough for small hash maps, and one holds 1/65,536 of the rows.
PREFIX = 4


def resolve_seed(seed: int | None = None) -> int:
    """Explicit seed, else the environment's, else 42; text that is no integer is ignored."""
    if seed is not None:
        return int(seed)
    try:
        return int(os.environ.get(SEED_VARIABLE, DEFAULT_SEED))
    except ValueError:
        return DEFAULT_SEED


def _digest_slot() -> Column:
    return F.substring("__digest", 1, PREFIX)


def _cut(df: DataFrame, by: Sequence[str], wanted: Column) -> DataFrame:
    """Per group: the first digest prefix at which ``wanted`` rows have been seen, all rows and those of earlier prefixes.

    At most 16**PREFIX prefixes per group enter a window partition.
    """
    counts = df.groupBy(*by, _digest_slot().alias("slot")).agg(F.count(F.lit(1)).alias("m"))
    running = Window.partitionBy(*by).orderBy("slot")
    whole = Window.partitionBy(*by)
    seen = (counts.withColumn("upto", F.sum("m").over(running))
            .withColumn("rows", F.sum("m").over(whole)))
    short = F.col("upto") - F.col("m") < wanted
    return seen.where(short).groupBy(*by).agg(
        F.max("slot").alias("slot"), F.max("rows").alias("rows"), F.max(F.col("upto") - F.col("m")).alias("before"))


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int | None = None,
                  by: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows (per group) with the smallest digests: a sample without replacement.

    Digest prefixes are counted first, so that only about ``n`` rows, not ``n`` rows
    per input partition, are moved to be ordered. Rows without a group form one of their own.
    """
    by, columns = list(by), df.columns
    marked = df.withColumn("__digest", stable_hash(keys, resolve_seed(seed)))
    if not by:
        last = _cut(marked, [], F.lit(n)).select("slot").scalar()
        return (marked.where(_digest_slot() <= last).orderBy("__digest").limit(n).select(*columns))
    cuts = _cut(marked, by, F.lit(n)).drop("before")
    # groups are mostly few: rows are then sifted where they stand, and only those kept are moved
    kept = lookup(marked, cuts, by, "rows", "inner", nulls=True).where(_digest_slot() <= F.col("slot"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy("__digest"))
    return kept.withColumn("__place", place).where(F.col("__place") <= n).select(*columns)


def split_flag(df: DataFrame, keys: Sequence[str], test_share: float = 0.3,
               seed: int | None = None, output: str = "is_test") -> DataFrame:
    """Add a test-set flag. One pass, no shuffle; the share holds up to sampling noise."""
    limit = format(int(round(test_share * DIGEST_VALUES)), "08x")
    return df.withColumn(output, stable_hash(keys, resolve_seed(seed)) < F.lit(limit))


def split_flag_exact(df: DataFrame, keys: Sequence[str], test_share: float = 0.3,
                     seed: int | None = None, output: str = "is_test") -> DataFrame:
    """Add a test-set flag on exactly ceil(share * n) rows (keys must be unique)."""
    columns = df.columns
    marked = df.withColumn("__digest", stable_hash(keys, resolve_seed(seed)))
    wanted = F.ceil(F.lit(float(test_share)) * F.col("rows"))
    edge = _cut(marked, [], wanted).select(F.struct("slot", (wanted - F.col("before")).alias("room")).alias("e")).scalar()
    # rows of the last prefix only, about n / 16**PREFIX of them
    inside = marked.where(_digest_slot() == edge.getField("slot")).select("__digest")
    place = F.row_number().over(Window.orderBy("__digest"))
    final = inside.withColumn("p", place).where(F.col("p") <= edge.getField("room")).agg(F.max("__digest")).scalar()
    return marked.select(*columns, F.coalesce(F.col("__digest") <= final, F.lit(False)).alias(output))


def head_sample(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in a stated order (a table has no order of its own)."""
    return df.orderBy(*order).limit(n)
