"""Jaccard join of word shingles: token-combination prefixes find candidates, whole sets decide.

Shingles of a set are ordered by an estimate of how many sets hold them, rarest first. Sets A and B that
reach the threshold share o >= max(a, b) shingles, where a = ceil(percent |A| / 100) and b likewise, so their
first |A| - a + e and |B| - b + e shingles share at least e of them. Rare shingles are indexed alone.
Frequent ones fall into m groups by hash and are indexed as pairs of one group: with e = m + 1 either a rare
one is shared or, of m + 1 frequent ones, two lie in one group. A set whose first |A| - a + 1 shingles are
all rare needs no longer prefix (e = 1).

Near copies under the threshold share keys without links. Large buckets of them are divided by what tells their
members from one of them, instead of what they share.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import stored
from sparkinfer.llm.components import components
from sparkinfer.llm.shingles import GOLDEN, fingerprint, mix, shingle_hashes, shingle_set, words_of
from sparkinfer.operators.joins import attach

#: Cells of the sketch of shingle counts: at most 2^22 (8 MB), about 64 shingles a cell below that.
LEAST_BITS, MOST_BITS, SHINGLES_A_CELL = 12, 22, 64
#: A part of the sketch that one task adds up.
PART_BITS = 14
#: A shingle is frequent when its cell holds FLOOR and WIDTH square roots of the median cell more than that, so what other shingles bring into
#: a cell, which grows with the table, does not hide it.
FLOOR, WIDTH = 4, 4
#: Frequent shingles of a prefix that a group should hold at most, about.
GROUP = 8
#: Texts that a Python worker holds at once.
LOT = 256
#: Members of a bucket that meet its pivots in one task.
SHARE = 256
#: Members outside the largest component that an open bucket compares with all others; with more it is divided first.
FEW = 32
#: What the index has of a bucket's member: ``far`` is the size of the set whose shingles are keys, ``slack`` how far past its prefix start.
MEMBER = ("key", "node", "n", "far", "slack")
#: Pairs that the buckets of a round may make (places and sizes leave few of them): at least so many, and as many a member.
PAIRS, PAIRS_A_MEMBER = 20_000_000, 64


class Counts:
    """About how many sets hold a shingle: exact counts of cells of the hashes (up to 65,535), and ``base``, what a cell holds of others."""

    def __init__(self, leads: DataFrame, k: int, shingles: int):
        self.bits = int(min(MOST_BITS, max(LEAST_BITS, int(shingles // SHINGLES_A_CELL).bit_length())))
        bits, part = self.bits, 1 << min(self.bits, PART_BITS)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = np.zeros(1 << bits, np.uint32)
            for record in batches:
                for lot in range(0, record.num_rows, LOT):
                    for text in record.column(0).slice(lot, LOT).to_pylist():
                        np.add.at(cells, (shingle_hashes(words_of(text), k) >> np.uint64(64 - bits)).astype(np.int64), np.uint32(1))
            for at in range(0, len(cells), part):
                if cells[at:at + part].any():
                    yield pa.RecordBatch.from_pydict({"part": [at // part], "cells": [zlib.compress(cells[at:at + part].tobytes(), 1)]})

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, total = None, np.zeros(part, np.uint64)
            for record in batches:
                for number, cells in zip(record.column(0).to_pylist(), record.column(1).to_pylist(), strict=True):
                    if key != number:
                        if key is not None:
                            yield pa.RecordBatch.from_pydict({"part": [key], "cells": [at_most(total).tobytes()]})
                        key, total = number, np.zeros(part, np.uint64)
                    total += np.frombuffer(zlib.decompress(cells), np.uint32)
            if key is not None:
                yield pa.RecordBatch.from_pydict({"part": [key], "cells": [at_most(total).tobytes()]})

        def at_most(total: np.ndarray) -> np.ndarray:
            return np.minimum(total, np.iinfo(np.uint16).max).astype(np.uint16)

        cells = np.zeros(1 << bits, np.uint16)
        parts = (leads.mapInArrow(count, "part long, cells binary").repartition("part").sortWithinPartitions("part")
                 .mapInArrow(add, "part long, cells binary"))
        for r in parts.toLocalIterator():
            cells[r["part"] * part:(r["part"] + 1) * part] = np.frombuffer(r["cells"], np.uint16)
        self.base = int(np.median(cells))
        self.limit = self.base + int(max(FLOOR, WIDTH * self.base ** 0.5))
        self.cells = leads.sparkSession.sparkContext.broadcast(cells)


def groups_of(label: int, percent: int) -> int:
    """Groups of frequent shingles for pairs whose smaller set has 2^label shingles or more, fewer than twice as many.

    Fewer than the shingles that such a pair must share, so that a prefix can be long enough;
    without groups frequent shingles are indexed alone.
    """
    low = 1 << label
    must = -(-percent * low // 100)
    return max(0, min(must - 1, (2 * low * (100 - percent) // 100 + 1) // GROUP + 1))


def signatures(hashes: np.ndarray, counts: np.ndarray, limit: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct index keys of a set and, for each, how far past its prefix start it is found.

    ``counts`` estimates how many sets hold each hash. The second array has place - e: a partner that
    needs o common shingles need only look at keys where it is at most |A| - o.
    """
    n = len(hashes)
    order = np.lexsort((hashes, counts))
    ranked, often = hashes[order], counts[order] > limit
    must = -(-percent * n // 100)
    label = n.bit_length() - 1
    labels = [label] if must >= 1 << label or label == 0 else [label, label - 1]
    keys, slack = [], []
    first = n - must + 1
    for at in labels:
        m = groups_of(at, percent)
        if m == 0 or not often[:first].any():
            keys.append(mix(ranked[:first] + GOLDEN))
            slack.append(np.arange(first))  # place counted from 1, less e = 1
            continue
        prefix = min(n, first + m)
        rare = np.flatnonzero(~often[:prefix])
        keys.append(mix(ranked[rare] + GOLDEN))
        slack.append(rare - m)
        freq = np.flatnonzero(often[:prefix])
        group = (mix(ranked[freq] ^ GOLDEN) % np.uint64(m)).astype(np.int64)
        by = np.lexsort((freq, group))
        freq, group = freq[by], group[by]
        edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            if hi - lo > 1:
                i, j = np.triu_indices(hi - lo, 1)
                i, j = freq[lo + i], freq[lo + j]
                keys.append(mix(mix(ranked[i] + np.uint64(at + 2)) ^ (ranked[j] * GOLDEN)))
                slack.append(j - m)
    key, place = np.concatenate(keys), np.concatenate(slack)
    by = np.lexsort((place, key))
    key, place = key[by], place[by]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return key[new].view(np.int64), place[new].astype(np.int64)


def similar(a: set, b: set, percent: int) -> bool:
    """Whether |A and B| / |A or B| >= percent / 100."""
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common)


class NgramJoin:
    """Components of rows linked by |A and B| / |A or B| >= percent / 100 over their k-word shingles.

    ``rows`` (stored) has ``id``, ``uid``, ``n`` (shingles), a 128-bit fingerprint ``fa, fb`` of the set and, on
    the first row of a set in its task, the text. Every set has one node, the smallest uid.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, k: int, percent: int):
        self.k, self.percent = k, percent
        self.rows = stored(self._read(df, id_col, text_col), "join-rows")
        self.classes = stored(self.rows.where("n > 0").groupBy("fa", "fb").agg(
            F.min("uid").alias("node"), F.count("*").alias("rows"), F.min("id").alias("low")), "join-classes")
        links = self._links()
        self.roots = None if links is None else components(links, "a", "b")

    def _read(self, df: DataFrame, id_col: str, text_col: str) -> DataFrame:
        k = self.k
        source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        long = T.LongType()
        schema = T.StructType([source.schema["id"], *(T.StructField(c, long) for c in ("uid", "n", "fa", "fb")),
                               T.StructField("text", T.StringType())])

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            base, number = TaskContext.get().partitionId() << 36, 0
            seen: set[tuple[int, int]] = set()
            for record in batches:
                for lot in range(0, record.num_rows, 512):
                    part = record.slice(lot, 512)
                    sizes, marks, texts = [], [], []
                    for text in part.column(1).to_pylist():
                        hashes = shingle_hashes(words_of(text), k)
                        mark = fingerprint(hashes) if len(hashes) else None
                        lead = mark is not None and mark not in seen
                        if lead:
                            seen.add(mark)
                        sizes.append(len(hashes))
                        marks.append(mark or (None, None))
                        texts.append(text if lead else None)
                    yield pa.RecordBatch.from_arrays([
                        part.column(0), pa.array(np.arange(base + number, base + number + len(sizes))), pa.array(sizes, pa.int64()),
                        pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                        pa.array(texts, pa.string())], names=schema.names)
                    number += len(sizes)

        return source.mapInArrow(read, schema)

    def _indexed(self) -> DataFrame:
        """(node, n, key, slack) for all keys of all nodes."""
        leads = self.rows.where("text is not null")
        k, percent = self.k, self.percent
        total = leads.agg(F.sum("n")).first()[0]
        counts = self.counts = Counts(leads.select("text"), k, total or 0)
        cells, bits, limit = counts.cells, counts.bits, counts.limit

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = cells.value
            for record in batches:
                for lot in range(0, record.num_rows, LOT):
                    part = record.slice(lot, LOT)
                    keys, slack = [], []
                    for text in part.column(2).to_pylist():
                        hashes = shingle_hashes(words_of(text), k)
                        own, place = signatures(hashes, held[(hashes >> np.uint64(64 - bits)).astype(np.int64)], limit, percent)
                        keys.append(own)
                        slack.append(place)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys, pa.list_(pa.int64())),
                                                      pa.array(slack, pa.list_(pa.int64()))], names=["node", "n", "keys", "slack"])

        signed = leads.select("uid", "n", "text").mapInArrow(sign, "node long, n long, keys array<long>, slack array<long>")
        nodes = signed.join(self.classes.select("node"), "node")
        return nodes.select("node", "n", F.explode(F.arrays_zip("keys", "slack")).alias("s")).select(
            F.col("s.keys").alias("key"), "node", "n", F.col("s.slack").alias("slack"))

    def _links(self) -> DataFrame | None:
        """Verified links between nodes that give all components.

        A bucket's node that meets most others is compared with its members first, one pair a member.
        Buckets whose members then lie in one component are done. Where at most FEW members lie outside the
        largest component, those are compared with all members of other components. Members of
        larger open buckets meet again under the shingles in which they differ from the bucket's
        first node (:meth:`_apart`), as long as that halves the pairs left to compare and they are more than those of
        the small buckets; what is then open is compared as in these. So at the end every pair that shares a key (and can reach the
        threshold by its places and sizes) was compared, lies in one component or met under a later key.
        """
        index = stored(self._indexed().withColumn("far", F.col("n")), "join-keys")
        shared = stored(index.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "join-shared")
        buckets = stored(attach(index, shared, ["key"], "members", how="inner"), "join-buckets")
        if buckets.isEmpty():
            return None
        self.texts = stored(self.rows.where("text is not null").select(F.col("uid").alias("node"), "text").join(
            buckets.select("node").distinct(), "node", "left_semi"), "join-texts")
        links, before = None, None
        while True:
            popular = buckets.groupBy("node").agg(F.sum("members").alias("popular"))
            pivots = stored(buckets.join(popular, "node").groupBy("key").agg(
                F.max(F.struct("popular", "node", "n", "far", "slack")).alias("top"), F.count("*").alias("members")).select(
                    "key", F.col("top.node").alias("pivot"), F.col("top.n").alias("pn"), F.col("top.far").alias("pfar"),
                    F.col("top.slack").alias("pslack"), "members"), "join-pivots")
            rows = buckets.select(*MEMBER)
            more = self._verified(attach(rows, pivots, ["key"], "members", how="inner").where("node != pivot"))
            links = more if links is None else stored(links.unionByName(more), "join-links")
            open_ = self._open(rows.join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti"), links)
            large = open_.where(F.col("few") > FEW)
            every, pairs = open_.agg(F.sum("few"), F.sum(F.when(F.col("few") > FEW, F.col("few")))).first()
            if pairs is None or 2 * pairs <= every or before is not None and 2 * pairs > before:
                return self._met(open_, links)
            links, before = self._met(open_.where(F.col("few") <= FEW), links), pairs
            near, index = self._apart(attach(large.select("key", "node", "n"), pivots.select("key", "pivot", "members"),
                                             ["key"], "members", how="inner"))
            links = stored(links.unionByName(near), "join-links")
            buckets = self._open(index, links)
            if buckets.isEmpty():
                return links

    @staticmethod
    def _open(rows: DataFrame, links: DataFrame) -> DataFrame:
        """Members of the buckets that hold more than one component, with the component (root), the bucket's
        members, its largest component (most) and the members outside it (few)."""
        labelled = stored(rows.join(components(links, "a", "b"), "node", "left").select(
            *MEMBER, F.coalesce("root", "node").alias("root")), "join-labelled")
        sizes = labelled.groupBy("key", "root").agg(F.count("*").alias("many"))
        mixed = stored(sizes.groupBy("key").agg(
            F.sum("many").alias("members"), F.max_by("root", "many").alias("most"), (F.sum("many") - F.max("many")).alias("few"))
            .where("few > 0"), "join-mixed")
        return stored(attach(labelled, mixed, ["key"], "members", how="inner"), "join-open")

    def _met(self, open_: DataFrame, links: DataFrame) -> DataFrame:
        """``links`` and those of all members outside a bucket's largest component with members of other components.

        A share of these members a round where pairs are many; what they link may close a bucket before the others' turn.
        """
        turn = 0
        while True:
            size = open_.agg(F.count("*").alias("members"), F.sum("few").alias("pairs")).first()
            if not size["members"]:
                return links
            rounds = -(-size["pairs"] // max(PAIRS, PAIRS_A_MEMBER * size["members"]))
            drawn = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(rounds)) == 0
            pivots = stored(open_.where("root != most").where(drawn), "join-pivots")
            ways = F.ceil(F.col("members") / SHARE)
            many = pivots.select("key", F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("far").alias("pfar"),
                                 F.col("slack").alias("pslack"), F.col("root").alias("proot"),
                                 F.explode(F.sequence(F.lit(0).cast("long"), ways - 1)).alias("way"))
            met = open_.withColumn("way", F.pmod(F.xxhash64("node"), ways)).join(many, ["key", "way"]).where("root != proot")
            links = stored(links.unionByName(self._verified(met)), "join-links")
            if rounds == 1:
                return links
            open_ = self._open(open_.select(*MEMBER).join(pivots.select("key", "node"), ["key", "node"], "left_anti"), links)
            turn += 1

    def _apart(self, members: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Links of ``members`` (key, node, n, pivot) to their pivots, and an index of the shingles in which they differ.

        Let D(x) be the shingles that only one of x and the pivot holds. Two sets differ in the shingles in which
        D(x) and D(y) differ, and similar ones in at most d(x, y) = |x| + |y| - 2 needed. So D(x) and D(y) share
        o >= (|D(x)| + |D(y)| - d) / 2 shingles, and if o > 0 one of these is among the first |D(x)| - o + 1 of D(x) and
        |D(y)| - o + 1 of D(y) in any common order. If |D(x)| + |D(y)| <= d, both are similar to the pivot and
        linked here: d(x, y) changes by 1 when a size does, and the sizes of y and the pivot differ by |D(y)| at most.
        d(x, y) <= reach = |x| (100 - percent) / percent, so the first reach + 1 shingles are enough for any partner.

        The order is rarest first, counted over the D of at most as many shingles as the pivot has (``near``). The D of sets that have little
        in common with the pivot hold nearly all of it; of these only the prefix leaves the worker, in the order
        of the sketch. |D(x)| and |D(y)| differ by d(x, y) at most, so a set that a partner beyond the pivot's size can reach is in both indexes.
        """
        k, percent, base = self.k, self.percent, self.counts.base
        cells, bits = self.counts.cells, self.counts.bits
        met = stored(members.select("pivot", "node", "n").distinct(), "join-met")
        met = attach(met, met.groupBy("pivot").agg(F.count("*").alias("members")), ["pivot"], "members", how="inner")
        both = self._with_texts(met.select(F.col("pivot").alias("a"), F.col("node").alias("b"), "n", "members",
                                           F.ceil(F.col("members") / SHARE).alias("ways")))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, own, whole, none = cells.value, np.zeros(0, np.uint64), set(), np.zeros(0, np.int64)
            for record in batches:
                for lot in range(0, record.num_rows, LOT):
                    part = record.slice(lot, LOT).select(["a", "b", "n", "members", "text"])
                    linked, far, near, apart = [], [], [], []
                    for b, n, members, text in zip(*(part.column(i).to_pylist() for i in range(1, 5)), strict=True):
                        words = words_of(text)
                        hashes, shingles = shingle_hashes(words, k), shingle_set(words, k)
                        if b is None:
                            own, whole = hashes, shingles
                            continue
                        differ, reach = np.setxor1d(own, hashes, assume_unique=True), n * (100 - percent) // percent
                        linked.append(similar(whole, shingles, percent))
                        far.append(len(differ))
                        near.append(differ.view(np.int64) if len(differ) <= len(own) else none)
                        if len(differ) + reach <= len(own):
                            apart.append(none)
                            continue
                        # how many of the pivot's members have it in D: those that hold it, or lack what the pivot holds
                        holders = held[(differ >> np.uint64(64 - bits)).astype(np.int64)].astype(np.int64) - base
                        rank = np.maximum(np.where(np.isin(differ, own, assume_unique=True), members - holders, holders), 1)
                        apart.append(differ[np.lexsort((differ, rank))[:reach + 1]].view(np.int64))
                    part = part.filter(part.column(1).is_valid())
                    yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), pa.array(linked, pa.bool_()), pa.array(far, pa.int64()),
                                                      pa.array(near, pa.list_(pa.int64())), pa.array(apart, pa.list_(pa.int64()))],
                                                     names=["a", "b", "n", "linked", "far", "near", "apart"])

        found = stored(both.mapInArrow(compare, "a long, b long, n long, linked boolean, far long, near array<long>, apart array<long>"), "join-apart")
        of = (F.col("a").alias("pivot"), F.col("b").alias("node"), "n", "far")
        each = found.select(*of, F.explode("near").alias("shingle"))
        often = stored(each.groupBy("pivot", "shingle").agg(F.count("*").alias("sets")).where("sets > 1"), "join-often")
        order = Window.partitionBy("pivot", "node").orderBy(F.coalesce("sets", F.lit(1)), "shingle")
        ranked = (attach(each, often, ["pivot", "shingle"], "sets").withColumn("slack", F.row_number().over(order).cast("long") - 1)
                  .where("sets is not null").where(F.col("slack") * percent <= F.col("n") * (100 - percent)))
        cut = found.select(*of, F.posexplode("apart").alias("slack", "shingle")).withColumn("slack", F.col("slack").cast("long"))
        index = ranked.drop("sets").withColumn("near", F.lit(True)).unionByName(cut.withColumn("near", F.lit(False)), allowMissingColumns=True)
        return (found.where("linked").select("a", "b"),
                stored(index.withColumn("key", F.xxhash64("near", "pivot", "shingle")).select(*MEMBER), "join-keys"))

    def _with_texts(self, pairs: DataFrame) -> DataFrame:
        """The rows of ``pairs`` (a, b, ways and others) with the text of ``b``, after a row with no ``b`` and the text of ``a``.

        So a text is sent once for all its partners in a task; it is laid out once for each way, so no task gets all pairs of an ``a``.
        """
        pairs = pairs.withColumn("way", F.pmod(F.xxhash64("b"), F.col("ways"))).drop("ways")
        texts = self.texts
        sides = pairs.select("a", "way").distinct().join(texts.withColumnRenamed("node", "a"), "a")
        partners = pairs.join(texts.withColumnRenamed("node", "b"), "b")
        return partners.unionByName(sides, allowMissingColumns=True).repartition("a", "way").sortWithinPartitions(
            "a", "way", F.col("b").asc_nulls_first())

    def _verified(self, met: DataFrame) -> DataFrame:
        """Distinct pairs of ``met`` (pivot, node, with sizes and places) whose whole sets are similar, compared as words."""
        k, percent = self.k, self.percent
        needed = F.ceil(F.lit(percent) * (F.col("n") + F.col("pn")) / F.lit(100 + percent))
        spare = F.col("n") + F.col("pn") - 2 * needed
        fit = met.where(F.lit(100) * F.least("n", "pn") >= F.lit(percent) * F.greatest("n", "pn")).where(
            (2 * F.col("slack") + F.col("pfar") - F.col("far") <= spare) & (2 * F.col("pslack") + F.col("far") - F.col("pfar") <= spare))
        pairs = stored(fit.groupBy(F.least("pivot", "node").alias("lo"), F.greatest("pivot", "node").alias("hi")).agg(
            F.max(F.struct("members", "pivot")).alias("top")).select(
                F.col("top.pivot").alias("a"), F.when(F.col("top.pivot") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b"),
                F.ceil(F.col("top.members") / SHARE).alias("ways")), "join-pairs")
        both = self._with_texts(pairs).select("a", "b", "text")

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = set()
            for record in batches:
                for lot in range(0, record.num_rows, LOT):
                    part, keep = record.slice(lot, LOT), []
                    for b, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                        shingles = shingle_set(words_of(text), k)
                        if b is None:
                            own = shingles
                        keep.append(b is not None and similar(own, shingles, percent))
                    yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return stored(both.mapInArrow(verify, "a long, b long"), "join-links")


def similar_groups(df: DataFrame, id_col: str, text_col: str, k: int = 5, percent: int = 80) -> DataFrame:
    """Every row's component: ``id_col``, ``n_shingles`` and ``component_id`` (smallest id reachable by links).

    A row's set holds its distinct ``k``-word shingles; fewer words are one shingle. Rows link when
    100 |A and B| >= percent |A or B|. Null and empty texts, and texts without words, have empty
    sets and are linked with nothing. Rows with null ids belong to components but do not
    name them, unless no row has an id: then the component is null. ``percent`` is over 50, at most 100. Repeated ids and rows are rows
    like others. An empty table gives no rows. Other columns are not read; an id named like
    a column of the result raises ValueError.
    """
    if id_col.lower() in ("n_shingles", "component_id"):
        raise ValueError(f"the id column cannot be named {id_col}: the result has a column of this name")
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    found = NgramJoin(df, id_col, text_col, k, percent)
    classes = found.classes.withColumn("root", F.col("node"))
    if found.roots is not None:
        classes = found.classes.join(found.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = stored(classes.select("fa", "fb", "rows", "low", "root"), "join-roots")
    lows = stored(classes.groupBy("root").agg(F.min("low").alias("component"), F.count("*").alias("sets")), "join-lows")
    named = stored(attach(classes.select("fa", "fb", "rows", "root"), lows, ["root"], "sets").select(
        "fa", "fb", "rows", "component"), "join-named")
    rows = attach(found.rows.select("id", "n", "fa", "fb"), named, ["fa", "fb"], "rows")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                       F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"))
