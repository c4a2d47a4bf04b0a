"""Exact deduplication by an extendible-hash index on shared files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import fresh, let_go, stored, text_of

#: A bucket splits beyond this many bytes of text; its size also bounds an owner task's share.
BUCKET_BYTES = 8 << 20
#: Directory depth at most; 2^16 slots are what the directory may ever cost the driver and a broadcast.
MAX_DEPTH = 16
#: A task writes out what it has chained when it holds so many bytes.
LOT_BYTES = 64 << 20


def _with_type(df: DataFrame, extra: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in extra)])


class Index:
    """Rows chained within their task, stored; one entry a distinct text and task.

    ``rows`` has every input row's columns but the text, with task, chain and, on a chain's
    best row only, the text's hash, the text and the number of its rows.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str):
        self.id_col, self.text_col = id_col, text_col
        self.columns = df.columns
        names = list(df.columns)
        self.task, self.chain, self.hash, self.count, self.best, self.digest, self.place = (
            fresh(names, n) for n in ("task", "chain", "hash", "count", "best", "digest", "place"))
        self.bucket, self.keep, self.size, self.wins = (
            fresh(names, n) for n in ("bucket", "keep", "size", "wins"))
        self.rows = stored(self._chained(df), "exact-index")

    def _chained(self, df: DataFrame) -> DataFrame:
        """One pass without a shuffle: equal texts of a task get one chain; the largest id leads it."""
        id_at, text_at = df.columns.index(self.id_col), df.columns.index(self.text_col)
        # the text's type stays as it is; a null leader stays null and is compared as empty
        schema = _with_type(df, [(self.task, T.LongType()), (self.chain, T.LongType()), (self.place, T.LongType()),
                                 (self.count, T.LongType())])

        def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            task = TaskContext.get().partitionId()
            held: list[pa.RecordBatch] = []
            size = base = place = 0

            def flush() -> pa.RecordBatch:
                nonlocal base, place
                table = pa.Table.from_batches(held).combine_chunks()
                ids, texts = table.column(id_at).to_pylist(), table.column(text_at).to_pylist()
                number: dict[str, int] = {}
                chain = [number.setdefault(t or "", len(number)) for t in texts]
                lead, count = [-1] * len(number), [0] * len(number)
                for i, c in enumerate(chain):
                    count[c] += 1
                    if lead[c] < 0 or ids[i] is not None and (ids[lead[c]] is None or ids[i] > ids[lead[c]]):
                        lead[c] = i
                leads = np.zeros(len(chain), bool)
                leads[lead] = True
                only_leads = pa.array([t if k else None for t, k in zip(texts, leads, strict=True)],
                                      table.column(text_at).type)
                table = table.set_column(text_at, table.field(text_at), only_leads)
                counts = pa.array([count[c] if k else None for c, k in zip(chain, leads, strict=True)], pa.int64())
                n = len(chain)
                out = [*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns),
                       pa.array(np.full(n, task, np.int64)), pa.array(np.array(chain, np.int64) + base),
                       pa.array(np.arange(place, place + n, dtype=np.int64)), counts]
                base += len(number)
                place += n
                return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in out],
                                                  names=schema.names)

            for record in batches:
                held.append(record)
                size += record.nbytes
                if size >= LOT_BYTES:
                    yield flush()
                    held, size = [], 0
            if sum(r.num_rows for r in held):
                yield flush()

        return df.mapInArrow(chains, schema)

    def entries(self) -> DataFrame:
        """The leading rows, with the hash that places their text in the index."""
        return self.rows.where(F.col(self.count).isNotNull()).withColumn(self.hash, F.xxhash64(text_of(self.text_col)))

    def directory(self, entries: DataFrame) -> tuple[int, list[tuple[int, int]]]:
        """Global depth and buckets (prefix, depth), grown by doubling while a bucket is overfull.

        Sizes by hash prefix of MAX_DEPTH bits are one aggregation, 2^MAX_DEPTH numbers at most.
        Each doubling splits the overfull buckets; a bucket of one slot that is still overfull
        chains its collisions.
        """
        slot = F.shiftrightunsigned(F.col(self.hash), 64 - MAX_DEPTH)
        sizes = np.zeros(1 << MAX_DEPTH, np.int64)
        met = entries.groupBy(slot.alias("slot")).agg(
            F.sum(F.octet_length(text_of(self.text_col)) + F.lit(64)).alias("bytes")).toPandas()
        sizes[met["slot"].to_numpy(np.int64)] = met["bytes"].to_numpy(np.int64)
        # never more buckets than slots: on very large inputs a bucket holds a larger share
        room = max(BUCKET_BYTES, int(sizes.sum() >> (MAX_DEPTH - 1)))
        depth, buckets = 0, [(0, 0)]
        while depth < MAX_DEPTH:
            totals = sizes.reshape(1 << depth, -1).sum(axis=1)
            full = {p for p, d in buckets if d == depth and totals[p] > room}
            if not full:
                break
            buckets = [b for b in buckets if b[1] < depth or b[0] not in full] + [
                (2 * p + bit, depth + 1) for p in sorted(full) for bit in (0, 1)]
            depth += 1
        return depth, sorted(buckets, key=lambda b: b[0] << (MAX_DEPTH - b[1]))

    def owned(self, columns: list[str]) -> DataFrame:
        """Every entry after its owner task has met all entries of its bucket: keep, size, wins.

        ``wins`` is true on the entry whose row stays: the largest id of the group, of equal
        ids the first in the input.
        """
        entries = self.entries()
        depth, buckets = self.directory(entries)
        spark = entries.sparkSession
        slots = [(s, i) for i, (p, d) in enumerate(buckets)
                 for s in range(p << (depth - d), (p + 1) << (depth - d))]
        table = spark.createDataFrame(slots, "slot long, bucket long")
        slot = F.shiftrightunsigned(F.col(self.hash), 64 - depth) if depth else F.lit(0).cast("long")
        dealt = (entries.join(F.broadcast(table.select(F.col("slot").alias(self.keep), F.col("bucket").alias(self.bucket))),
                              slot == F.col(self.keep)).drop(self.keep))
        carried = [*columns, *(c for c in (self.id_col, self.text_col) if c not in columns)]
        inner = [self.task, self.chain, self.place, self.count, self.hash]
        rows = dealt.select(*[F.col(f"`{c}`") for c in carried], *inner, self.bucket)
        owners = rows.repartition(len(buckets), self.bucket).sortWithinPartitions(self.bucket, self.hash)
        return self._owners(owners.drop(self.bucket), columns, carried)

    def _owners(self, owners: DataFrame, columns: list[str], carried: list[str]) -> DataFrame:
        at = {c: i for i, c in enumerate(owners.columns)}
        id_at, text_at = at[self.id_col], at[self.text_col]
        id_type = owners.schema[self.id_col].dataType
        fields = [owners.schema[c] for c in columns] + [
            T.StructField(self.task, T.LongType()), T.StructField(self.chain, T.LongType()),
            T.StructField(self.keep, id_type), T.StructField(self.size, T.LongType()),
            T.StructField(self.wins, T.BooleanType()), T.StructField(self.digest, T.StringType())]
        schema = T.StructType(fields)
        positions = [at[c] for c in columns]
        task_at, chain_at, place_at, count_at, hash_at = (
            at[c] for c in (self.task, self.chain, self.place, self.count, self.hash))

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            import hashlib

            # a run of equal hashes may go on in the next batch: its rows are held back until it ends
            held: list[pa.RecordBatch] = []

            def judge(records: list[pa.RecordBatch]) -> pa.RecordBatch:
                table = pa.Table.from_batches(records).combine_chunks()
                hashes = table.column(hash_at).to_numpy()
                ids, texts = table.column(id_at).to_pylist(), table.column(text_at).to_pylist()
                tasks, places = table.column(task_at).to_pylist(), table.column(place_at).to_pylist()
                counts = table.column(count_at).to_pylist()
                n = len(ids)
                group = np.zeros(n, np.int64)
                heads: list[int] = []  # one row of each distinct text met
                best, total = [], []
                a = 0
                bounds = [*np.flatnonzero(np.diff(hashes)) + 1, n]
                rank = lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, -tasks[i], -places[i])
                for b in bounds:
                    chain: list[int] = []
                    for i in range(a, b):
                        for g in chain:  # collisions of the hash: compare the texts themselves
                            if (texts[heads[g]] or "") == (texts[i] or ""):
                                break
                        else:
                            g = len(heads)
                            chain.append(g)
                            heads.append(i)
                            best.append(i)
                            total.append(0)
                        group[i] = g
                        total[g] += counts[i]
                        if rank(i) > rank(best[g]):
                            best[g] = i
                    a = b
                digests = [hashlib.sha256((texts[h] or "").encode("utf-8", "surrogatepass")).hexdigest() for h in heads]
                keep = [ids[best[g]] for g in group]
                out = [table.column(i) for i in positions] + [table.column(task_at), table.column(chain_at)]
                out = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in out]
                out = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in out]
                out += [pa.array(keep, table.column(id_at).type), pa.array([total[g] for g in group], pa.int64()),
                        pa.array([best[g] == i for i, g in enumerate(group)], pa.bool_()),
                        pa.array([digests[g] for g in group], pa.string())]
                return pa.RecordBatch.from_arrays(out, names=schema.names)

            for record in batches:
                if not record.num_rows:
                    continue
                hashes = record.column(hash_at).to_numpy()
                changes = np.flatnonzero(np.diff(hashes)) + 1
                cut = int(changes[-1]) if len(changes) else 0
                if cut:
                    yield judge([*held, record.slice(0, cut)])
                    held = [record.slice(cut)]
                elif held and held[-1].column(hash_at)[-1].as_py() != hashes[0]:
                    yield judge(held)
                    held = [record]
                else:
                    held.append(record)
            if held:
                yield judge(held)

        return owners.mapInArrow(meet, schema)


def exact_groups(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row's group of equal texts: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical; null counts as empty. Of a group the row with the largest
    id stays (``kept``), of repeated ids the first in the input; rows without an id stay only
    where no row of the group has one. An empty table gives no rows. Other columns may have any
    name. See :class:`Index` for the method: tasks chain their own rows, a directory of hash
    prefixes doubles until no bucket is overfull, owners compare the texts of colliding hashes.
    A group of copies, however large, reaches its owner as one entry a task, and its verdict
    returns by (task, chain), a key with no more rows than one task has read.
    """
    index = Index(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), id_col, text_col)
    verdict = index.owned([])
    pair = [index.task, index.chain]
    lead = F.col(index.count).isNotNull()
    rows = index.rows.select(F.col(f"`{id_col}`"), *pair, lead.alias(index.best))
    return rows.join(verdict, pair).select(
        F.col(f"`{id_col}`"), F.col(index.keep).alias("keep_id"), F.col(index.size).alias("group_size"),
        (F.col(index.best) & F.col(index.wins)).alias("kept"), F.col(index.digest).alias("text_sha256"))


def drop_copies(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows that stay, with all their columns; see :func:`exact_groups` for which."""
    index = Index(df, id_col, text_col)
    return index.owned(index.columns).where(F.col(index.wins)).select(*[F.col(f"`{c}`") for c in index.columns])
