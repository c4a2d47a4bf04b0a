"""URL allow and block lists: a blocked Bloom filter ahead of an exact hash join."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import fresh

BLOCK_BITS = 512
PROBES = 8
#: The filter never takes more than this; a list beyond it only lets more false hits through to the join.
MAX_FILTER_BYTES = 64 << 20
BITS_PER_KEY = 16
#: Lists up to so many rules (their keys bounded by MAX_KEY_BYTES) are broadcast to the exact join.
BROADCAST_RULES = 100_000
MAX_KEY_BYTES = 1024
SALTS = 16


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = re.search(r"[/?#]", rest)
    host, tail = (rest[:end.start()], rest[end.start():]) if end else (rest, "")
    path = re.split(r"[?#]", tail, maxsplit=1)[0]
    return host.translate(LOWER), path


#: ASCII capitals to small letters.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _key_hash(key: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))


def _probe_bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number of each hash, and its bit positions (one row a hash) inside that block."""
    block = (hashes >> np.uint64(32)) % np.uint64(blocks)
    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint64)
    step = ((low >> np.uint64(9)) | np.uint64(1))[:, None]
    bits = (low[:, None] + np.arange(PROBES, dtype=np.uint64) * step) % np.uint64(BLOCK_BITS)
    return block, bits


class BlockedBloom:
    """Bits in blocks of one cache line; a key touches one block only."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits  # uint8, blocks x BLOCK_BITS / 8

    def might_hold(self, hashes: np.ndarray) -> np.ndarray:
        block, bits = _probe_bits(hashes, len(self.bits))
        byte = self.bits[block[:, None], bits >> np.uint64(3)]
        return ((byte >> (bits & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def build_bloom(rules: DataFrame, key: str, count: int) -> BlockedBloom:
    """Filter over a key column: tasks set bits, equal bits meet in one aggregation.

    What reaches the driver is the set bits as (block, byte, value), so at most MAX_FILTER_BYTES cells.
    """
    blocks = int(min(MAX_FILTER_BYTES * 8, max(1, count) * BITS_PER_KEY) // BLOCK_BITS) + 1

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.fromiter((_key_hash(k) for k in batch.column(0).to_pylist()), np.uint64)
            block, bits = _probe_bits(hashes, blocks)
            cell = (block[:, None] * np.uint64(BLOCK_BITS // 8) + (bits >> np.uint64(3))).ravel().astype(np.int64)
            value = (1 << (bits & np.uint64(7)).astype(np.int32)).ravel().astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(value)], names=["cell", "value"])

    cells = (rules.select(key).mapInArrow(set_bits, "cell long, value int")
             .groupBy("cell").agg(F.bit_or("value").alias("value")).toPandas())
    bits = np.zeros(blocks * BLOCK_BITS // 8, np.uint8)
    bits[cells["cell"].to_numpy(np.int64)] = cells["value"].to_numpy(np.uint8)
    return BlockedBloom(bits.reshape(blocks, BLOCK_BITS // 8))


def judge_urls(pages: DataFrame, id_col: str, url_col: str, rules: DataFrame, default: str = "allow",
               max_filter_bytes: int | None = None) -> DataFrame:
    """Verdict of every url under the longest fitting rule.

    ``rules`` has ``host``, ``path`` and ``verdict`` strings; hosts are lower-cased. A rule fits
    its host and all subdomains where the url's path starts with the rule's path; of several
    the longest (host and path together) wins; of one listed twice the smallest verdict.
    Urls under no rule get ``default``. Returns ``id_col``, ``host``, ``path``, ``rule``
    (host followed by path, or null) and ``verdict``, one row per input row.

    Every suffix of the host with every prefix of the path, of a length that some rule's path has,
    is a canonical candidate. Candidates the filter rejects are in no rule. The rest meet the
    rules in a hash join: broadcast for lists of a checked size, else salted, so that one rule
    fitting a third of all urls is spread. Rows of an empty or null url have empty host and path
    and fall under the default, unless a rule lists the empty host. Other columns are not read.
    """
    lower = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    clean = (rules.select(lower.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
             .where(F.col("host").isNotNull())
             .withColumn("rule", F.concat_ws("\t", "host", "path"))
             .groupBy("rule").agg(F.min("verdict").alias("rule_verdict")))
    sizes = clean.agg(F.count("*").alias("n"), F.max(F.octet_length("rule")).alias("longest")).first()
    count, longest = sizes["n"], sizes["longest"] or 0
    # distinct lengths of rule paths: bounded by the longest url, not by the number of rules
    lengths = sorted(r[0] for r in clean.select(
        F.length(F.substring_index("rule", "\t", -1)).alias("n")).distinct().collect())
    spark = pages.sparkSession
    bits = spark.sparkContext.broadcast(build_bloom(clean, "rule", count).bits)
    id_type = pages.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("host", T.StringType()),
                           T.StructField("path", T.StringType()), T.StructField("hits", T.ArrayType(T.StringType()))])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = BlockedBloom(bits.value)
        for batch in batches:
            parsed = [host_and_path(u) for u in batch.column(1).to_pylist()]
            owner, keys = [], []
            for i, (host, path) in enumerate(parsed):
                labels = host.split(".")
                for k in range(len(labels)):
                    suffix = ".".join(labels[k:])
                    for n in lengths:
                        if n <= len(path):
                            owner.append(i)
                            keys.append(f"{suffix}\t{path[:n]}")
            hits: list[list[str]] = [[] for _ in parsed]
            if keys:
                passed = bloom.might_hold(np.fromiter(map(_key_hash, keys), np.uint64, len(keys)))
                for j in np.flatnonzero(passed):
                    hits[owner[j]].append(keys[j])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p[0] for p in parsed], pa.string()),
                 pa.array([p[1] for p in parsed], pa.string()), pa.array(hits, pa.list_(pa.string()))],
                names=[id_col, "host", "path", "hits"])

    found = pages.select(F.col(f"`{id_col}`"), F.col(f"`{url_col}`").cast("string").alias("url")).mapInArrow(
        candidates, schema)
    if count <= BROADCAST_RULES and longest <= MAX_KEY_BYTES:
        return _joined(found, F.broadcast(clean), id_col, default, salts=1)
    return _joined(found, clean, id_col, default, salts=SALTS)


def _joined(found: DataFrame, rules: DataFrame, id_col: str, default: str, salts: int) -> DataFrame:
    """Exact match of the possible hits; the longest matching rule per row."""
    names = {id_col, "host", "path"}
    row, salt = fresh(names, "row_no"), fresh(names, "salt")
    rows = found.withColumn(row, F.monotonically_increasing_id())
    hits = rows.select(F.col(f"`{id_col}`"), "host", "path", row, F.explode_outer("hits").alias("rule"))
    if salts > 1:
        hits = hits.withColumn(salt, F.pmod(F.col(row), F.lit(salts)))
        rules = rules.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    matched = hits.join(rules, ["rule", salt] if salts > 1 else ["rule"], "left")
    fits = F.col("rule_verdict").isNotNull()
    size = F.when(fits, F.length("rule"))
    best = (matched.groupBy(row).agg(
        F.first(f"`{id_col}`").alias(id_col), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max(F.struct(size.alias("size"), F.when(fits, F.col("rule")).alias("rule"),
                       F.when(fits, F.col("rule_verdict")).alias("verdict"))).alias("best")))
    return best.select(F.col(f"`{id_col}`"), "host", "path",
                       F.regexp_replace(F.col("best")["rule"], "\t", "").alias("rule"),
                       F.coalesce(F.col("best")["verdict"], F.lit(default)).alias("verdict"))
