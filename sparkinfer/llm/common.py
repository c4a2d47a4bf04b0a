"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def fresh(names: Iterable[str], base: str) -> str:
    """A column name that no given name clashes with, whatever the case of letters."""
    taken = {n.lower() for n in names}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share: spark.checkpoint.dir, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a step to the shared folder and read it back: its lineage ends there.

    A lost executor re-reads the files; nothing before the step runs again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(name: str, build: Callable[[], object]) -> object:
    """An object that a Python worker builds once and keeps for its later tasks of the same kind.

    Package functions travel by value, so their module globals do not outlive a task. A worker
    holds one object only: asking for another name lets the last one go.
    """
    holder = sys.modules.setdefault("_worker_object", types.ModuleType("_worker_object"))
    if getattr(holder, "name", None) != name:
        holder.name = holder.object = None  # free the old one before the new one is built
        holder.object = build()
        holder.name = name
    return holder.object


def let_go() -> None:
    """Free what a worker keeps from tasks of another kind (:func:`per_worker`), before this task needs the memory."""
    holder = sys.modules.get("_worker_object")
    if holder is not None:
        holder.name = holder.object = None
