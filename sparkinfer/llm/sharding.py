"""Jump consistent hashing of stable keys into shards, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkinfer.llm.common import fresh, stored

# Multiplier and increment of the generator in the published algorithm, as 32-bit halves.
MULTIPLIER = 2862933555777941757
INCREMENT = 1
_C_HIGH, _C_LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_MASK = 0xFFFFFFFF
#: Jumps tried before the unbounded loop; a key needs about ln(shards) of them.
USUAL_JUMPS = 48
#: Upper bound of numbering blocks, so that the offsets of ``shards x BLOCKS`` cells stay small.
BLOCKS = 4096


def _low32(a: Column, c: int) -> Column:
    """Low 32 bits of a product of 32-bit numbers, without passing 63 bits (ANSI mode raises there)."""
    upper = (F.shiftright(a, 16) * F.lit(c)).bitwiseAND(F.lit(0xFFFF))
    return (a.bitwiseAND(F.lit(0xFFFF)) * F.lit(c) + F.shiftleft(upper, 16)).bitwiseAND(F.lit(_MASK))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """One step of the 64-bit generator on two 32-bit halves."""
    first = low.bitwiseAND(F.lit(0xFFFF)) * F.lit(_C_LOW) + F.lit(INCREMENT)
    second = F.shiftright(low, 16) * F.lit(_C_LOW)
    sum_low = first + F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16)
    carry = F.shiftright(sum_low, 32) + F.shiftright(second, 16)
    rest = _low32(high, _C_LOW) + _low32(low, _C_HIGH) + carry
    return rest.bitwiseAND(F.lit(_MASK)), sum_low.bitwiseAND(F.lit(_MASK))


def jump_hash(key: Column, shards: int, grown: int | None = None) -> Column:
    """Struct (shard, grown): the bucket of a 64-bit key among ``shards`` and among ``grown`` buckets.

    A key's jumps do not depend on the number of shards, so a walk up to the larger number
    gives both. Null keys count as key 0.
    """
    top = max(shards, grown or shards)
    value = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(value, 32).alias("high"), value.bitwiseAND(F.lit(_MASK)).alias("low"),
        F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))

    def jump(s: Column, _: Column) -> Column:
        high, low = _next(s["high"], s["low"])
        # key >> 33 of the published text is the upper half without its lowest bit
        draw = (F.shiftright(high, 1) + F.lit(1)).cast("double")
        target = F.floor((s["at"] + F.lit(1)).cast("double") * (F.lit(2147483648.0) / draw))
        moved = F.struct(high.alias("high"), low.alias("low"), target.alias("at"),
                         F.when(target < shards, target).otherwise(s["shard"]).alias("shard"),
                         F.when(target < F.lit(grown or shards), target).otherwise(s["grown"]).alias("grown"))
        return F.when(s["at"] >= F.lit(top), s).otherwise(moved)

    # The first jump of the published loop starts at bucket -1 and lands on 0: j = floor(0 * ...) = 0.
    usual = F.aggregate(F.sequence(F.lit(1), F.lit(min(top, USUAL_JUMPS))), start, jump)
    if top <= USUAL_JUMPS:
        return usual
    return F.when(usual["at"] >= F.lit(top), usual).otherwise(
        F.aggregate(F.sequence(F.lit(1), F.lit(top)), start, jump))


def shard(df: DataFrame, key: str, shards: int, order_by: list[str] | None = None, grown: bool = True) -> DataFrame:
    """Assign every row a shard by its key, and a gapless slot within the shard.

    Returns the rows with ``shard`` int, ``slot`` long and, with ``grown``, ``grown_shard``
    int: the shard once one more is appended. Columns of these names in the input are
    replaced. Integer keys are hashed as they are, other types through xxhash64.

    Null keys count as key 0. Rows repeated in full share a shard and get different slots.
    An empty table gives no rows. Texts are not looked at here, so their length is no matter;
    select the columns to carry before the call, since slots need one shuffle of what is
    carried and one of the same rows within shard and range.

    Slots follow the key (then ``order_by``, then the input's order). Rows are dealt into
    key ranges; a key held by many rows spans several, because the row's place in the input
    is part of the range key. Counts per (shard, range) are at most shards x BLOCKS numbers.
    """
    spark = df.sparkSession
    df = df.drop("shard", "slot", *(["grown_shard"] if grown else []))
    integral = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    hashed = F.col(f"`{key}`") if integral else F.xxhash64(F.col(f"`{key}`"))
    place, block, at, rank, offset, count = (
        fresh(df.columns, n) for n in ("place", "block", "target", "rank", "offset", "count"))
    ways = [F.col(f"`{key}`"), *(F.col(f"`{c}`") for c in order_by or []), F.col(place)]
    parts = min(BLOCKS, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    placed = (df.withColumn(at, jump_hash(hashed, shards, shards + 1 if grown else None))
              .withColumn("shard", F.col(at)["shard"].cast("int")))
    if grown:
        placed = placed.withColumn("grown_shard", F.col(at)["grown"].cast("int"))
    ranged = (placed.drop(at).withColumn(place, F.monotonically_increasing_id())
              .repartitionByRange(parts, *ways).withColumn(block, F.spark_partition_id()))
    ranged = stored(ranged, "shard-ranges")
    before = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("shard", block).agg(F.count("*").alias(count))
               .withColumn(offset, F.coalesce(F.sum(count).over(before), F.lit(0))).drop(count))
    within = Window.partitionBy("shard", block).orderBy(*ways)
    numbered = ranged.withColumn(rank, F.row_number().over(within).cast("long"))
    return (numbered.join(F.broadcast(offsets), ["shard", block])
            .withColumn("slot", F.col(offset) + F.col(rank) - F.lit(1)).drop(block, offset, rank, place))
