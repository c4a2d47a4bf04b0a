"""Token ids in ORC files: run-length encoded stripes with row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import fresh, per_worker, text_of
from sparkinfer.llm.tokens import WordCoder, coder_name, tokenizer_json

STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000
BLOOM_FPP = 0.01
#: The table of what stands before each file is broadcast up to so many files (16 bytes each).
BROADCAST_FILES = 100_000


def write_token_files(df: DataFrame, path: str, id_col: str, text_col: str, tokenizer: str,
                      end_id: int | None = 1) -> None:
    """Encode every text and write the ids under ``path`` in ascending order of ``id_col``.

    Columns: ``id_col``, ``first`` (ids before the document in its file), ``n_tokens``,
    ``ids`` (array of int; ORC stores integers run-length encoded). Files sort by name as
    their ids do. Null and empty texts are the end id alone (or no ids without one); null ids
    come first; repeated rows are all written, in the order of the input; an empty table gives
    files without rows. A text is one row, however long. Only the two named columns are read.

    Rows are dealt into id ranges by one shuffle, on id and place in the input, so that an id
    with very many rows spans several tasks. Each task writes one file; if it is lost, it
    encodes its range again.
    """
    json_text = tokenizer_json(tokenizer)
    source, name = df.sparkSession.sparkContext.broadcast(json_text), coder_name(json_text)
    names = [id_col]
    text, place = fresh(names, "text"), fresh(names, "place")
    rows = (df.select(F.col(f"`{id_col}`"), text_of(text_col).alias(text))
            .withColumn(place, F.monotonically_increasing_id()))
    ordered = rows.repartitionByRange(F.col(f"`{id_col}`"), F.col(place)).sortWithinPartitions(f"`{id_col}`", place)
    tail = b"" if end_id is None else end_id.to_bytes(4, "little")
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("first", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker(name, lambda: WordCoder(source.value))
        first = 0
        for record in batches:
            for lot in range(0, record.num_rows, 2000):
                part = record.slice(lot, 2000)
                coded = [c + tail for c in coder.encode(part.column(1).to_pylist())]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                ends = first + np.cumsum(sizes)
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"))
                bounds = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ends - sizes), pa.array(sizes),
                     pa.ListArray.from_arrays(bounds, values)], names=schema.names)
                first = int(ends[-1])

    (ordered.mapInArrow(encode, schema).write
     .option("orc.bloom.filter.columns", id_col).option("orc.bloom.filter.fpp", BLOOM_FPP)
     .option("orc.row.index.stride", INDEX_STRIDE).option("orc.stripe.size", STRIPE_BYTES)
     .option("compression", "zstd").orc(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """All documents of :func:`write_token_files`, with ``start``: ids of all documents before each.

    Stripes are read in parallel. What stands before a file is summed over one row a file.
    """
    data = spark.read.orc(path)
    file, before = fresh(data.columns, "file"), fresh(data.columns, "before")
    tagged = data.withColumn(file, F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long"))
    files = (tagged.groupBy(file).agg(F.max(F.col("first") + F.col("n_tokens")).alias(before)))
    ahead = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    sums = files.withColumn(before, F.coalesce(F.sum(before).over(ahead), F.lit(0)))
    if files.count() <= BROADCAST_FILES:
        sums = F.broadcast(sums)
    return tagged.join(sums, file).withColumn("start", F.col(before) + F.col("first")).drop(file, before)


def find_documents(spark: SparkSession, path: str, id_col: str, ids: list) -> DataFrame:
    """Documents of a few ids; file and stripe statistics, row indexes and Bloom filters rule out the rest."""
    return spark.read.orc(path).where(F.col(f"`{id_col}`").isin(ids))


def ids_crc32(df: DataFrame, ids: str, into: str) -> DataFrame:
    """Add the unsigned crc32 of an array of ids, taken as little-endian unsigned 32-bit integers."""
    kept = [c for c in df.columns if c not in (ids, into)]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(into, T.LongType())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            lists = record.column(len(kept))
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False))
            view = memoryview(values).cast("B")
            bounds = lists.offsets.to_pylist()
            sums = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [*(record.column(i) for i in range(len(kept))), pa.array(sums, pa.int64())], names=schema.names)

    return df.select(*[f"`{c}`" for c in kept], f"`{ids}`").mapInArrow(digest, schema)
