"""Hierarchical packing of token sequences into windows of several lengths."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import fresh, per_worker, text_of
from sparkinfer.llm.tokens import WordCoder, coder_name, tokenizer_json

#: Window lengths, longest first.
TIERS = (4096, 2048, 1024, 512)
#: Tokens a task gathers before it packs them.
LOT_TOKENS = 4_000_000
#: Tokens of a step group.
STEP_TOKENS = 32_768


class Packer:
    """Packs pieces (length, document, start) of one task into windows of the tiers.

    A document's whole windows are cut off at once. Its rest waits in the shortest tier that
    holds it. From the longest tier down, every rest opens a window; the gap takes the
    longest waiting pieces of shorter tiers that fit, and at last a cut one. Pieces of the
    shortest tier fill windows among themselves. What fills no window waits for the next lot;
    at the end it is laid in a row, cut into windows of the longest tier, and the tail into
    windows of powers of two. No window has padding.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self.pool: list[tuple[int, int, int]] = []
        self.waiting = 0
        self.windows: list[tuple[int, list[tuple[int, int, int]]]] = []

    def add(self, document: int, tokens: int) -> None:
        top, start = self.tiers[0], 0
        while tokens - start >= top:
            self.windows.append((top, [(top, document, start)]))
            start += top
        if tokens > start:
            self.pool.append((tokens - start, document, start))
            self.waiting += tokens - start

    def _fill(self, tier: int, own: list, lower: list, left: list) -> None:
        while own:
            window, gap = [own.pop()], tier - 0
            gap -= window[0][0]
            while gap and lower:
                k = bisect_right(lower, (gap, 1 << 62)) - 1
                if k >= 0:
                    piece = lower.pop(k)
                else:
                    length, document, start = lower.pop(0)
                    insort(lower, (length - gap, document, start + gap))
                    piece = (gap, document, start)
                window.append(piece)
                gap -= piece[0]
            if gap:
                left.extend(window)
            else:
                self.windows.append((tier, window))

    def pack(self) -> None:
        """Fill what windows can be filled; the rest stays."""
        lower, left = sorted(self.pool), []
        for tier in self.tiers[:-1]:
            cut = bisect_left(lower, (tier // 2 + 1,))
            own, lower = lower[cut:], lower[:cut]
            self._fill(tier, own, lower, left)
        self._fill(self.tiers[-1], lower, lower, left)
        self.pool, self.waiting = left, sum(p[0] for p in left)

    def finish(self) -> None:
        """Pack, then cut the rest into whole windows and a tail of powers of two."""
        self.pack()
        rest = sorted(self.pool, key=lambda p: p[1:], reverse=True)
        total = sum(p[0] for p in rest)
        while total:
            size = self.tiers[0] if total >= self.tiers[0] else 1 << (total.bit_length() - 1)
            window, gap = [], size
            while gap:
                length, document, start = rest.pop()
                if length > gap:
                    rest.append((length - gap, document, start + gap))
                    length = gap
                window.append((length, document, start))
                gap -= length
            self.windows.append((size, window))
            total -= size
        self.pool, self.waiting = [], 0

    def take(self) -> list[tuple[int, list[tuple[int, int, int]]]]:
        out, self.windows = self.windows, []
        return out


def pack_documents(df: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int = 2,
                   tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pack every document's ids, ``end_id`` appended, into windows without padding.

    ``tokenizer`` is the path of a tokenizers file. One row per piece: ``id_col``, ``start``
    (ids of the document before the piece), ``length``, ``ids`` (binary, little-endian unsigned
    32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence), ``tier`` (the
    sequence's length) and ``step_id``: sequences of one tier in groups of ``step_tokens``
    tokens, so that all steps but a task's last of each tier hold the same number of tokens.

    A null or empty text is its end id alone; a very long one fills whole windows of its own
    before its rest is packed. Repeated rows and null ids are packed each for itself. An empty
    table gives no rows. Only the two named columns are read.

    Each task packs the rows of its own input split, nothing is shuffled, and a task holds one
    lot of LOT_TOKENS and the pieces that wait. The same split packs the same way when it is
    run again, so read the input from files, as a lost executor's splits are read anew.
    """
    spark = df.sparkSession
    text = tokenizer_json(tokenizer)
    source, name = spark.sparkContext.broadcast(text), coder_name(text)
    id_type = df.schema[id_col].dataType
    rows = df.select(F.col(f"`{id_col}`"), text_of(text_col).alias(fresh([id_col], "text")))
    fields = [("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()),
              ("sequence_id", T.LongType()), ("offset", T.LongType()), ("tier", T.IntegerType()),
              ("step_id", T.LongType())]
    schema = T.StructType([T.StructField(id_col, id_type), *(T.StructField(n, t) for n, t in fields)])
    tail = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker(name, lambda: WordCoder(source.value))
        base = TaskContext.get().partitionId() << 36
        packer = Packer(tiers)
        ids: dict[int, tuple[object, bytes]] = {}
        counts: dict[int, int] = {}
        made = number = 0
        id_arrow = None

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal made
            columns: list[list] = [[] for _ in schema.fields]
            size = 0

            def batch() -> pa.RecordBatch:
                types = [id_arrow, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

            for tier, window in packer.take():
                at, group = 0, max(1, step_tokens // tier)
                nth = counts.get(tier, 0)
                counts[tier] = nth + 1
                step = base | (tier.bit_length() << 30) | (nth // group)
                for length, document, start in window:
                    owner, whole = ids[document]
                    row = (owner, start, length, whole[4 * start:4 * (start + length)], len(whole) // 4,
                           base | made, at, tier, step)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    at += length
                    size += 4 * length
                made += 1
                if size > 8_000_000 or len(columns[0]) > 20_000:
                    yield batch()
                    columns, size = [[] for _ in schema.fields], 0
            if columns[0]:
                yield batch()
            waiting = {p[1] for p in packer.pool}
            for document in [d for d in ids if d not in waiting]:
                del ids[document]

        gathered = 0
        for record in batches:
            id_arrow = record.schema.field(0).type
            for lot in range(0, record.num_rows, 2000):
                part = record.slice(lot, 2000)
                names = part.column(0).to_pylist()
                for owner, coded in zip(names, coder.encode(part.column(1).to_pylist()), strict=True):
                    whole = coded + tail
                    ids[number] = (owner, whole)
                    packer.add(number, len(whole) // 4)
                    gathered += len(whole) // 4
                    number += 1
                if gathered >= LOT_TOKENS:
                    packer.pack()
                    yield from out()
                    gathered = packer.waiting
        packer.finish()
        if number:
            yield from out()

    return rows.mapInArrow(run, schema)
