"""Removal of long repeated byte strings by interval expansion on Burrows-Wheeler transforms.

Equal strings of the minimum length choose the same anchor (the k-byte string of smallest hash
inside them). So texts fall into runs of windows with one anchor; only runs whose anchor
occurs again can repeat, and all places of a string meet under its anchor's hash. There,
the transform of the runs' distinct texts is extended backwards, breadth first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import per_worker, stored
from sparkinfer.llm.shingles import mix

#: Bytes of an anchor, at most; shorter strings in common cost no work beyond their hash.
ANCHOR = 64
#: Texts are hashed in parts of so many bytes.
PART_BYTES = 1 << 22
#: Bytes of distinct runs in one transform; its arrays stay in a core's cache.
LOT_BYTES = 1 << 19
#: Distinct runs a transform takes of one anchor; anchors with more are decided window by window.
MAX_RUNS = 1000
#: Open rows of the transform are looked up, not counted over all rows, below one in so many.
OPEN_SHARE = 12
_BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of an odd base and of its inverse, modulo 2^64, and a number for every byte."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = pow(_BASE, -1, 1 << 64)
            self.up, self.down = (self._powers(x, size) for x in (_BASE, inverse))

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        factors = np.full(size + 1, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)


def window_hashes(data: np.ndarray, k: int, powers: _Powers) -> np.ndarray:
    """64-bit hashes of all k-byte strings, from one running sum."""
    powers.reach(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(powers.byte[data] * powers.down[:len(data)], dtype=np.uint64)])
    return mix((sums[k:] - sums[:-k]) * powers.up[:len(data) - k + 1])


def anchor_runs(data: np.ndarray, length: int, k: int, powers: _Powers) -> tuple[np.ndarray, np.ndarray]:
    """First window of every run of windows (of ``length`` bytes) with one anchor, and the anchors' hashes.

    Of equal hashes in a window the first place counts, so the choice depends on the window's bytes alone.
    """
    starts, hashes = [], []
    span = length - k + 1
    for at in range(0, len(data) - length + 1, PART_BYTES):
        part = data[at:at + PART_BYTES + length - 1]
        h = window_hashes(part, k, powers)
        keyed = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        n = len(h)
        blocks = -(-n // span)
        padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = keyed
        square = padded.reshape(blocks, span)
        ahead = np.minimum.accumulate(square, axis=1).reshape(-1)
        behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        low = np.minimum(behind[:n - span + 1], ahead[span - 1:n])
        place = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
        starts.append(first + at)
        hashes.append(h[place[first]])
    return np.concatenate(starts), np.concatenate(hashes)


def suffix_order(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of texts with an end mark each, its inverse, and the joined symbols.

    Marks are smaller than all bytes and ordered by text, so no comparison passes one.
    Prefix doubling; only suffixes that still tie are sorted again.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    total = int(sizes.sum())
    symbols = np.zeros(total, np.int64)
    ends = np.cumsum(sizes) - 1
    inside = np.ones(total, bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
    last = np.repeat(ends, sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    step = 6
    key = np.zeros(total, np.int64)
    place = np.arange(total)
    for j in range(step):
        key = (key << 9) | np.where(place + j <= last, symbols[np.minimum(place + j, total - 1)], 0)
    order = np.argsort(key)
    fresh_group = np.concatenate([[True], np.diff(key[order]) != 0])
    rank = np.empty(total, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh_group, np.arange(total), 0))
    while True:
        head = rank[order]
        tied = np.zeros(total, bool)
        tied[1:] |= head[1:] == head[:-1]
        tied[:-1] |= head[:-1] == head[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            return order, rank, symbols
        at = order[slots]
        # suffixes that have reached their mark are ordered by text, before all that go on
        ahead = np.where(at + step <= last[at], rank[np.minimum(at + step, total - 1)] + len(texts), owner[at])
        # both numbers are below the number of symbols and texts, so their pair is one number
        pair = rank[at] * np.int64(total + len(texts) + 1) + ahead
        by = np.argsort(pair)
        order[slots] = at[by]
        pair = pair[by]
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        rank[order[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        step *= 2


def repeated_places(texts: list[bytes], length: int) -> np.ndarray:
    """Whether the string of ``length`` bytes at each place of the joined texts occurs at another place.

    Neighbouring suffixes start with the same symbol c exactly when both come, by the
    last-to-first mapping, from rows with c in the transform; they share one symbol more than
    the least of the rows between. So values l + 1 follow from values up to l: level by level
    all rows whose common prefix is l get known, and what is unknown after ``length`` levels
    shares at least that much. While many rows are open a running count over all of them tells whether
    a known one lies between; later the open ones are looked up.
    """
    order, rank, symbols = suffix_order(texts)
    n = len(order)
    first = symbols[order]
    # row of the suffix that is one symbol shorter, for each row; ends have none
    shorter = rank[np.minimum(order + 1, n - 1)]
    known = np.ones(n + 1, bool)
    known[1:n] = (first[1:] != first[:-1]) | (first[1:] == 0)
    rows = np.flatnonzero(~known)
    lo, hi = shorter[rows - 1], shorter[rows]
    for _ in range(length - 1):
        if not len(rows):
            break
        if len(rows) * OPEN_SHARE > n:
            count = np.cumsum(known[:n], dtype=np.int32)
            met = count[hi] != count[lo]
        else:  # few rows are open: count those between, and see whether they are all
            met = np.searchsorted(rows, hi, "right") - np.searchsorted(rows, lo, "right") < hi - lo
        known[rows[met]] = True
        rows, lo, hi = rows[~met], lo[~met], hi[~met]
    same = np.zeros(n, bool)
    same[rows] = True
    same[rows - 1] = True
    out = np.zeros(n, bool)
    out[order[same]] = True
    return out


def _intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


def _digest(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


_PAIRS = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def _pairs(values: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"a": a, "b": b} for a, b in v] for v in values],
                    pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))


class Repeats:
    """Steps of :func:`repeated_spans`; each stored step is named after what it holds."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, length: int):
        self.length, self.k = length, min(ANCHOR, max(1, length // 2))
        self.source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        self.rows = stored(self._anchored(), "repeat-rows")
        self.classes = stored(self.rows.groupBy("fa", "fb").agg(
            F.min("uid").alias("node"), F.count("*").alias("copies"), F.max("n_bytes").alias("n_bytes")), "repeat-classes")
        self.texts = stored(self._suspects(), "repeat-texts")
        self.repeated = self._repeated()

    def _anchored(self) -> DataFrame:
        """Every row with its size and digest; the first row of a text in its task has its runs."""
        length, k = self.length, self.k
        schema = T.StructType([self.source.schema["id"], *(T.StructField(n, T.LongType()) for n in (
            "uid", "n_bytes", "fa", "fb")), T.StructField("text_sha256", T.StringType()),
            T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("hashes", T.ArrayType(T.LongType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = per_worker("powers", _Powers)
            base, number, seen = TaskContext.get().partitionId() << 36, 0, set()
            for record in batches:
                cols: list[list] = [[] for _ in range(7)]
                for text in record.column(1).to_pylist():
                    data = (text or "").encode("utf-8", "surrogatepass")
                    sha = hashlib.sha256(data)
                    mark = sha.digest()[:16]
                    starts = hashes = None
                    if len(data) >= length and mark not in seen:
                        seen.add(mark)
                        starts, hashes = anchor_runs(np.frombuffer(data, np.uint8), length, k, powers)
                        hashes = hashes.view(np.int64)
                    for c, v in zip(cols, (base + number, len(data), int.from_bytes(mark[:8], "little", signed=True),
                                           int.from_bytes(mark[8:], "little", signed=True), sha.hexdigest(), starts,
                                           hashes), strict=True):
                        c.append(v)
                    number += 1
                types = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [record.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=schema.names)

        return self.source.mapInArrow(run, schema)

    def _flagged(self) -> DataFrame:
        """Runs (node, start, end, hash) whose anchor occurs again.

        Tasks first count their own anchors: those met twice are settled there, and one entry
        of each anchor and task goes on. So an anchor reaches its owner at most once a task.
        """
        length = self.length
        nodes = (self.rows.where(F.col("starts").isNotNull()).select("uid", "starts", "hashes", "n_bytes")
                 .join(self.classes.select(F.col("node").alias("uid")), "uid")
                 .select("uid", "n_bytes", "starts", "hashes"))

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0

            def out() -> pa.RecordBatch:
                table = pa.Table.from_batches(held).combine_chunks()
                counts = table.column(2).combine_chunks().value_lengths().to_numpy()
                starts = table.column(2).combine_chunks().flatten().to_numpy()
                hashes = table.column(3).combine_chunks().flatten().to_numpy()
                node = np.repeat(table.column(0).to_numpy(), counts)
                ends = np.concatenate([starts[1:] - 1, [0]])
                last = np.cumsum(counts) - 1
                ends[last] = table.column(1).to_numpy() - length
                _, first, inverse, met = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                again = met[inverse] > 1
                leads = np.zeros(len(hashes), bool)
                leads[first] = True
                return pa.RecordBatch.from_arrays(
                    [pa.array(hashes), pa.array(node), pa.array(starts), pa.array(ends), pa.array(again), pa.array(leads)],
                    names=["hash", "node", "start", "end", "again", "leads"])

            for record in batches:
                if not record.num_rows:
                    continue
                held.append(record)
                size += record.nbytes
                if size >= 32 << 20:
                    yield out()
                    held, size = [], 0
            if held:
                yield out()

        entries = stored(nodes.mapInArrow(
            local, "hash long, node long, start long, end long, again boolean, leads boolean"), "repeat-anchors")
        over = Window.partitionBy("hash")
        met = (entries.where("leads").withColumn("tasks", F.count("*").over(over))
               .where("tasks > 1 and not again").select("node", "start", "end", "hash"))
        return entries.where("again").select("node", "start", "end", "hash").unionByName(met)

    def _suspects(self) -> DataFrame:
        """Texts with the runs to look at: one row a distinct text, in (fa, fb, text, runs)."""
        runs = self._flagged().groupBy("node").agg(F.collect_list(F.struct(
            F.col("start").alias("a"), F.col("end").alias("b"), F.col("hash").alias("h"))).alias("runs"))
        wanted = runs.join(self.classes.select("node", "fa", "fb"), "node").select("fa", "fb", "node", "runs")

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = set()
            for record in batches:
                fa, fb, at = [], [], []
                for i, text in enumerate(record.column(0).to_pylist()):
                    mark = hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).digest()[:16]
                    if mark not in seen:
                        seen.add(mark)
                        at.append(i)
                        fa.append(int.from_bytes(mark[:8], "little", signed=True))
                        fb.append(int.from_bytes(mark[8:], "little", signed=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fa, pa.int64()), pa.array(fb, pa.int64()), record.column(0).take(pa.array(at, pa.int64()))],
                    names=["fa", "fb", "text"])

        texts = self.source.where(F.octet_length("text") >= self.length).select("text").mapInArrow(
            named, "fa long, fb long, text string")
        # several tasks may bring the same text: one stays
        return texts.join(wanted, ["fa", "fb"]).dropDuplicates(["node"]).select("node", "text", "runs")

    def _segments(self) -> DataFrame:
        """Bytes under every suspect run, each distinct one once a task, with the number of its places there."""
        length = self.length

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[tuple[int, bytes], int] = {}
            size = 0

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in found], pa.int64()), pa.array([s for _, s in found], pa.binary()),
                     pa.array(list(found.values()), pa.int64())], names=["hash", "segment", "places"])

            for record in batches:
                for _, data, run in _runs_of(record):
                    segment = data[run["a"]:run["b"] + length]
                    key = (run["h"], segment)
                    if key not in found:
                        size += len(segment) + 100
                    found[key] = found.get(key, 0) + 1
                    if size > 32 << 20:
                        yield out()
                        found.clear()
                        size = 0
            if found:
                yield out()

        return stored(self.texts.mapInArrow(cut, "hash long, segment binary, places long"), "repeat-segments")

    def _repeated(self) -> DataFrame:
        """Distinct segments by digest (d1, d2) with their repeated windows as (first, last) pairs."""
        length = self.length
        segments = self._segments()
        crowded = stored(segments.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") > MAX_RUNS), "repeat-crowded")
        few = segments.join(crowded.select("hash"), "hash", "left_anti")
        many = segments.join(crowded.select("hash"), "hash", "left_semi")

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lot: dict[bytes, int] = {}  # segments of whole anchors, more than one each
            alone: list[bytes] = []
            own: dict[bytes, int] = {}
            at, size = None, 0

            def close() -> None:
                nonlocal size
                if len(own) > 1:
                    for s, n in own.items():
                        lot[s] = lot.get(s, 0) + n
                        size += len(s)
                elif own:
                    alone.extend(s for s, n in own.items() if n > 1)
                own.clear()

            def out() -> Iterator[pa.RecordBatch]:
                nonlocal size
                names, windows = [_digest(s) for s in alone], [[(0, len(s) - length)] for s in alone]
                if lot:
                    texts = list(lot)
                    flags = repeated_places(texts, length)
                    start = 0
                    for s in texts:
                        own_flags = np.ones(len(s) - length + 1, bool) if lot[s] > 1 else flags[start:start + len(s) - length + 1]
                        start += len(s) + 1
                        if own_flags.any():
                            names.append(_digest(s))
                            windows.append(_intervals(own_flags))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()),
                     _pairs(windows)], names=["d1", "d2", "windows"])
                lot.clear()
                alone.clear()
                size = 0

            for record in batches:
                hashes, parts, places = (record.column(i).to_pylist() for i in range(3))
                for h, s, n in zip(hashes, parts, places, strict=True):
                    if h != at:
                        close()
                        at = h
                        if size >= LOT_BYTES or len(alone) > 20_000:
                            yield from out()
                    own[s] = own.get(s, 0) + n
            close()
            yield from out()

        fields = "d1 long, d2 long, windows array<struct<a:long,b:long>>"
        few = few.repartition("hash").sortWithinPartitions("hash").select("hash", "segment", "places").mapInArrow(expand, fields)
        return stored(few.unionByName(self._window_by_window(many).select("d1", "d2", "windows")), "repeat-windows")

    def _window_by_window(self, many: DataFrame) -> DataFrame:
        """For anchors with very many distinct segments: every window by its digest, counted."""
        length = self.length

        def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for record in batches:
                cols: list[list] = [[] for _ in range(6)]
                for s, n in zip(record.column(0).to_pylist(), record.column(1).to_pylist(), strict=True):
                    d1, d2 = _digest(s)
                    for i in range(len(s) - length + 1):
                        for c, v in zip(cols, (d1, d2, i, *_digest(s[i:i + length]), n), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 names=["d1", "d2", "at", "w1", "w2", "places"])

        every = stored(many.select("segment", "places").mapInArrow(
            windows, "d1 long, d2 long, at long, w1 long, w2 long, places long"), "repeat-every-window")
        again = every.groupBy("w1", "w2").agg(F.sum("places").alias("n")).where("n > 1").select("w1", "w2")
        hit = every.join(again, ["w1", "w2"]).select("d1", "d2", "at").distinct()

        def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for record in batches:
                found = []
                for places in record.column(2).to_pylist():
                    flags = np.zeros(max(places) + 1, bool)
                    flags[places] = True
                    found.append(_intervals(flags))
                yield pa.RecordBatch.from_arrays([record.column(0), record.column(1), _pairs(found)],
                                                 names=["d1", "d2", "windows"])

        # neighbouring windows of a segment are one interval, as from a transform
        return hit.groupBy("d1", "d2").agg(F.collect_list("at").alias("places")).mapInArrow(
            runs, "d1 long, d2 long, windows array<struct<a:long,b:long>>")

    def spans(self) -> DataFrame:
        """Suspect texts (node) with the byte spans to remove, first and end, merged."""
        length = self.length

        def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for record in batches:
                cols: list[list] = [[] for _ in range(4)]
                nodes = record.column(0).to_pylist()
                for row, data, run in _runs_of(record):
                    a = run["a"]
                    for c, v in zip(cols, (*_digest(data[a:run["b"] + length]), nodes[row], a), strict=True):
                        c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["d1", "d2", "node", "start"])

        places = self.texts.mapInArrow(name, "d1 long, d2 long, node long, start long")
        found = places.join(self.repeated, ["d1", "d2"])
        shifted = F.transform("windows", lambda w: F.struct(
            (w["a"] + F.col("start")).alias("a"), (w["b"] + F.col("start") + F.lit(length)).alias("b")))
        pieces = found.select("node", F.explode(shifted).alias("span")).groupBy("node").agg(
            F.array_sort(F.collect_list("span")).alias("spans"))
        empty = F.array().cast(_PAIRS)

        def join(done, s):
            last = F.element_at(done, -1)
            return F.when((F.size(done) > 0) & (s["a"] <= last["b"]), F.concat(
                F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                    last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b"))))).otherwise(
                        F.concat(done, F.array(s)))

        return pieces.select("node", F.aggregate("spans", empty, join).alias("spans"))


def _runs_of(record: pa.RecordBatch) -> Iterator[tuple[int, bytes, dict]]:
    """Row, bytes and run, for each text of (node, text, runs) and each of its runs."""
    for i, (text, runs) in enumerate(zip(record.column(1).to_pylist(), record.column(2).to_pylist(), strict=True)):
        data = text.encode("utf-8", "surrogatepass")
        for r in runs:
            yield i, data, r


def repeated_spans(df: DataFrame, id_col: str, text_col: str, length: int = 200) -> DataFrame:
    """What of every text is covered by strings of ``length`` bytes that start anywhere else too.

    Returns ``id_col``, ``n_bytes``, ``spans`` (array of (a, b), byte places, end exclusive,
    merged), ``n_removed``, ``text_sha256`` of the whole text, and ``kept``: the remaining bytes,
    null where nothing is removed. Texts are judged as given, as UTF-8; null is empty; texts
    shorter than ``length`` keep all. Equal texts of at least ``length`` bytes, so also rows repeated in
    full, are removed whole. Matches end with a text. Very long texts are hashed in parts that
    overlap. Ids may be null or repeated; an empty table gives no rows; other columns are not read.
    """
    r = Repeats(df, id_col, text_col, length)
    spans = r.spans()

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            kept = []
            for text, spans_ in zip(record.column(1).to_pylist(), record.column(2).to_pylist(), strict=True):
                data, at, parts = text.encode("utf-8", "surrogatepass"), 0, []
                for s in spans_:
                    parts.append(data[at:s["a"]])
                    at = s["b"]
                kept.append(b"".join([*parts, data[at:]]))
            yield pa.RecordBatch.from_arrays([record.column(0), record.column(2), pa.array(kept, pa.binary())],
                                             names=["node", "spans", "kept"])

    partly = r.texts.select("node", "text").join(spans, "node").select("node", "text", "spans").mapInArrow(
        rest, "node long, spans array<struct<a:long,b:long>>, kept binary")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= F.lit(length))
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("b")))
    judged = (r.classes.join(partly, "node", "left")
              .select("fa", "fb", F.when(whole, all_of).otherwise(F.coalesce("spans", F.array().cast(_PAIRS))).alias("spans"),
                      F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept")))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return r.rows.drop("starts", "hashes", "uid").join(judged, ["fa", "fb"]).select(
        F.col("id").alias(id_col), "n_bytes", "spans", removed.alias("n_removed"), "text_sha256", "kept")
