"""What only larger tables meet: many groups, tables beyond a broadcast, tasks with many rows."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparkinfer.operators import hypothesis, joins, ranks, sampling, sketches


def test_ranks_of_quantiles_beyond_a_broadcast(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 7).alias("g"), F.sqrt("id").alias("v")).withColumn("g", F.nullif("g", F.lit(3)))
    found = ranks.quantiles(df, "v", {"a": 0.25, "b": 0.75}, ["g"], approximate=True, accuracy=1000)
    few = {tuple(r) for r in sketches.rank_bounds(df, "v", found, ["a", "b"], ["g"]).collect()}
    monkeypatch.setattr(joins, "FEW_KEYS", 2)
    many = {tuple(r) for r in sketches.rank_bounds(df, "v", found, ["a", "b"], ["g"]).collect()}
    assert len(many) == 14 and many == few


def test_attach_takes_rows_with_any_column_name(spark):
    rows = spark.range(100).select((F.col("id") % 4).alias("k"), F.col("id").cast("double").alias("__v"))
    table = spark.createDataFrame([(0, 25, 1.0), (1, 25, 2.0)], "k long, n long, x double")
    inner = joins.attach(rows, table, ["k"], "n", "inner")
    assert inner.columns == ["k", "__v", "n", "x"] and inner.count() == 50
    assert inner.agg(F.sum("__v")).first()[0] == sum(i for i in range(100) if i % 4 < 2)
    left = joins.attach(rows, table, ["k"], "n")
    assert left.count() == 100 and left.where("x is null").count() == 50


def test_grouped_sample_sifts_rows_in_place(spark, monkeypatch):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    few = sampling.seeded_sample(rows, ["id"], 40, 7, ["g"])
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" not in plan  # no join that moves the rows
    picked = {tuple(r) for r in few.collect()}
    monkeypatch.setattr(joins, "FEW_KEYS", 1)
    many = sampling.seeded_sample(rows, ["id"], 40, 7, ["g"])
    assert len(picked) == 120 and picked == {tuple(r) for r in many.collect()}


def test_small_groups_are_ordered_in_one_shuffle(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = spark.createDataFrame(pd.DataFrame({"g": rng.integers(0, 300, 6000) * 1.0, "v": rng.integers(0, 400, 6000) * 0.5,
                                               "s": rng.random(6000) < 0.4})).withColumn("g", F.nullif("g", F.lit(7.0)))

    def found():
        out = hypothesis.mann_whitney_exact(rows, "v", "s", True, False, ["g"])
        return out._jdf.queryExecution().optimizedPlan().toString(), {tuple(r) for r in out.collect()}

    plan, whole = found()
    assert " Join " not in plan and "RepartitionByExpression" in plan
    assert ranks.whole_groups(rows, ["g"]).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(ranks, "TASK_ROWS", 100)
    assert ranks.whole_groups(rows, ["g"]).rdd.getNumPartitions() == 60  # tasks follow the rows
    monkeypatch.setattr(ranks, "TASK_ROWS", 5)  # a group is too large: ranges
    assert ranks.whole_groups(rows, ["g"]) is None
    plan, ranged = found()
    assert "RepartitionByExpression" not in plan and len(whole) == 300 and whole == ranged


@pytest.mark.parametrize("width", [1, 4])
def test_split_and_sample_from_one_count_of_prefixes(spark, monkeypatch, width):
    monkeypatch.setattr(sampling, "PREFIX", width)
    for n in (1, 7, 1000):
        rows = spark.range(n)
        cut = sampling._cut(rows.withColumn("__digest", F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit("7")))), [], F.lit(1))
        assert cut.first()["before"] == 0 and cut.first()["rows"] == n
        order = sorted(range(n), key=lambda i: hashlib.md5(f"{i}|7".encode()).hexdigest())
        for share in (0.0, 0.3, 1.0):
            flagged = sampling.split_flag_exact(rows, ["id"], share, 7).where("is_test")
            assert {r[0] for r in flagged.collect()} == set(order[:math.ceil(share * n)])
        assert {r[0] for r in sampling.seeded_sample(rows, ["id"], 5, 7).collect()} == set(order[:5])
    empty = sampling.split_flag_exact(spark.range(0), ["id"], 0.3, 7)
    assert empty.count() == 0
