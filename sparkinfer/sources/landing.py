"""Landing of slow sources as Parquet, spreading and caching, and result sinks."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkinfer.sources.delimited import Scan, scan


def _newest(spark: SparkSession, path: str):
    """Latest modification time under a path; only the file listing is read."""
    try:
        listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                   .where(~F.col("path").rlike(r"/[_.][^/]*$")))
        return listing.agg(F.max("modificationTime")).first()[0]
    except AnalysisException:
        return None


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to a path has been finished."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def land(spark: SparkSession, source: str, target: str, partitions: int | None = None, **options) -> Scan:
    """Convert a delimited source (a gzip file is not splittable) to Parquet, once.

    The copy is reused while it is complete, newer than the source and has the wanted columns
    with their types. Returns the scan over the
    landed table; ``options`` go to :func:`sparkinfer.sources.delimited.scan`.
    """
    read = scan(spark, source, **options)
    landed, original = _newest(spark, target), _newest(spark, source)
    fresh = (landed is not None and original is not None and landed >= original and _complete(spark, target)
             and spark.read.parquet(target).dtypes == read.data.dtypes)
    if not fresh:
        spread = read.data.repartition(partitions) if partitions else balance(read.data)
        spread.write.mode("overwrite").parquet(target)
    return Scan(spark.read.parquet(target), read.missing, read.rejected)


def balance(df: DataFrame, minimum: int | None = None) -> DataFrame:
    """Spread rows over at least ``minimum`` tasks (default: the cluster's cores).

    A table that already has enough partitions is returned as it is.
    """
    wanted = minimum or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def keep(df: DataFrame) -> DataFrame:
    """Cache for reuse by several jobs; spills to disk and survives executor loss by recompute."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def shared_folder(spark: SparkSession) -> str:
    """The folder driver and executors share: spark.checkpoint.dir, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints").rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Store a step in the shared folder as compressed Parquet and read it back: its lineage ends there.

    Later steps then plan against a stored table and read only the columns they need, and a
    lost executor re-reads the files. They are removed when the application ends; the session's
    settings are not touched.
    """
    spark = df.sparkSession
    path = scratch(spark, "step")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_results(results: dict[str, DataFrame], path: str, fmt: str = "parquet") -> None:
    """Write every result table under ``path/name`` as Parquet or JSON."""
    if fmt not in ("parquet", "json"):
        raise ValueError("fmt must be 'parquet' or 'json'")
    for name, table in results.items():
        table.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{name}")
