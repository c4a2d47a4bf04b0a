"""The sales view the queries run on, bound to the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkinfer.functions.scalars import years_between
from sparkinfer.sources.landing import balance


def fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows are spread over all cores when its files have too few splits."""
    return balance(table(spark, sf_dir, name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _row_key():
    """Text that identifies a lineitem row, free of floating-point formatting."""
    return F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                       F.date_format("l_shipdate", "yyyy-MM-dd"),
                       F.round(F.col("l_extendedprice") * 100).cast("long"))


def _line_columns():
    return [F.col("l_suppkey").alias("store"), F.col("l_quantity").alias("units"),
            F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
            F.col("l_extendedprice").alias("amount"), F.col("l_linestatus").alias("gender"),
            F.col("l_returnflag").alias("flag"), _row_key().alias("row_key")]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales columns that come from lineitem alone (no join)."""
    return fact(spark, sf_dir, "lineitem").select("l_shipdate", *_line_columns())


def sales(spark: SparkSession, sf_dir: str, segments: bool = False) -> DataFrame:
    """lineitem with its order; a third of the rows have no customer id.

    The customer table gives the segment and nothing else (every order has its customer), so it is
    joined only where ``segments`` are asked for.
    """
    item, order = fact(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = item.join(order, item["l_orderkey"] == order["o_orderkey"])
    if segments:
        customer = table(spark, sf_dir, "customer")
        joined = joined.join(customer, order["o_custkey"] == customer["c_custkey"])
    age = years_between(F.col("l_shipdate"), F.col("o_orderdate"))
    return joined.select(
        F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("channel"),
        *([F.col("c_mktsegment").alias("segment")] if segments else []), *_line_columns(),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("unknown"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("birth_text"),
        F.col("l_shipdate").alias("shipped"), age.alias("age_years"))
