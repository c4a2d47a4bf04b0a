"""Near-duplicates by SuperMinHash signatures, banding, exact verification and union-find."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import fresh, let_go, stored
from sparkinfer.llm.components import components
from sparkinfer.llm.shingles import GOLDEN, fingerprint, mix, shingle_hashes, shingle_set, words_of

#: Bands and ranks a band: a pair at 0.8 shares no band with a probability of 5e-6.
BANDS, RANKS = 40, 6
#: Elements of a signature lot; a lot holds one permutation of the ranks for each.
LOT_ELEMENTS = 32_768
#: Nodes a bucket compares with all its members in a later round.
PIVOTS = 512
#: Ratio of the sizes that bound a class of sets.
SIZE_CLASS = 1.05


def super_minhash(elements: np.ndarray, sizes: np.ndarray, ranks: int) -> np.ndarray:
    """Signatures (sets x ranks) of sets of 64-bit elements, laid one after another.

    In round j an element draws its next place of a permutation of all ranks and offers
    (j, draw) there; so the offers of one element are spread evenly over the ranks, which
    lowers the variance. A set is done when j has passed its largest rank value: nothing
    later can be smaller.
    """
    out = np.full((len(sizes), ranks), np.iinfo(np.uint64).max, np.uint64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(elements), LOT_ELEMENTS):
        x, doc = elements[at:at + LOT_ELEMENTS], owner[at:at + LOT_ELEMENTS]
        first, last = doc[0], doc[-1] + 1
        order = np.tile(np.arange(ranks, dtype=np.uint16), (len(x), 1))
        row = np.arange(len(x))
        for j in range(ranks):
            live = (out[first:last].max(axis=1) >> np.uint64(32)) >= j
            if not live.all():
                stay = live[doc - first]
                if not stay.any():
                    break
                x, doc, row = x[stay], doc[stay], row[stay]
            draw = mix(x + np.uint64(((j + 1) * int(GOLDEN)) & 0xFFFFFFFFFFFFFFFF))
            k = j + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(ranks - j)) >> np.uint64(32)).astype(np.int64)
            place = order[row, k]
            order[row, k] = order[row, j]
            offer = (draw >> np.uint64(32)) | np.uint64(j << 32)
            np.minimum.at(flat, doc * ranks + place, offer)
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band, as signed numbers; keys of different bands differ."""
    parts = signatures.reshape(len(signatures), bands, -1)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN, parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        key = mix(key ^ parts[:, :, i]) + GOLDEN
    return key.view(np.int64)


class NearDuplicates:
    """Groups of rows linked by shingle sets with |A and B| / |A or B| >= percent / 100.

    ``rows`` (stored) has the input's carried columns with ``uid``, ``n`` (size of the set),
    a 128-bit fingerprint ``fa, fb`` of the set, and, on the first row of a set in its task, the
    text and the band keys. ``roots`` gives every set's component.
    """

    def __init__(self, df: DataFrame, text_col: str, carry: list[str], k: int, percent: int,
                 bands: int = BANDS, ranks: int = RANKS):
        self.k, self.percent, self.bands, self.ranks = k, percent, bands, ranks
        self.carry = carry
        names = list(df.columns)
        self.uid, self.n, self.fa, self.fb, self.text, self.keys = (
            fresh(names, x) for x in ("uid", "n_shingles", "fa", "fb", "set_text", "band_keys"))
        self.rows = stored(self._signed(df, text_col), "near-rows")
        # every set has one node: the smallest uid that holds it
        self.classes = stored(self.rows.where(F.col(self.n) > 0).groupBy(self.fa, self.fb).agg(
            F.min(self.uid).alias("node")), "near-classes")
        self.links = self._links()
        self.roots = None if self.links is None else components(self.links, "a", "b")

    def _signed(self, df: DataFrame, text_col: str) -> DataFrame:
        k, bands, ranks = self.k, self.bands, self.bands * self.ranks
        source = df.select(*[F.col(f"`{c}`") for c in self.carry], F.col(f"`{text_col}`").cast("string").alias(self.text))
        at = len(self.carry)
        long = T.LongType()
        schema = T.StructType([*source.schema.fields[:at], T.StructField(self.uid, long), T.StructField(self.n, long),
                               T.StructField(self.fa, long), T.StructField(self.fb, long),
                               T.StructField(self.text, T.StringType()), T.StructField(self.keys, T.ArrayType(long))])

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            base, number = TaskContext.get().partitionId() << 36, 0
            seen: set[tuple[int, int]] = set()
            for record in batches:
                for lot in range(0, record.num_rows, 512):
                    part = record.slice(lot, 512)
                    texts = part.column(at).to_pylist()
                    sets = [shingle_hashes(words_of(t), k) for t in texts]
                    marks = [fingerprint(s) if len(s) else None for s in sets]
                    lead = []
                    for i, mark in enumerate(marks):
                        if mark is not None and mark not in seen:
                            seen.add(mark)
                            lead.append(i)
                    keys: list = [None] * len(sets)
                    if lead:
                        signed = super_minhash(np.concatenate([sets[i] for i in lead]),
                                               np.array([len(sets[i]) for i in lead]), ranks)
                        for i, own in zip(lead, band_keys(signed, bands), strict=True):
                            keys[i] = own
                    chosen = set(lead)
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays([
                        *(part.column(c) for c in range(at)),
                        pa.array(np.arange(base + number, base + number + n)), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([m and m[0] for m in marks], pa.int64()), pa.array([m and m[1] for m in marks], pa.int64()),
                        pa.array([t if i in chosen else None for i, t in enumerate(texts)], pa.string()),
                        pa.array(keys, pa.list_(pa.int64()))], names=schema.names)
                    number += n

        return source.mapInArrow(sign, schema)

    def _links(self) -> DataFrame | None:
        """Verified links between nodes; all of them stem from shared bands, none from a sample.

        In a bucket of one band key one node is compared with every member, which costs one pair a
        member: the one that meets most others in its buckets, as of many edited copies that is
        the one closest to all. A bucket whose members then lie in one component is done. Nodes of the
        others, mostly copies edited too much to be linked, meet again under the rarest shingles
        of their sets (:meth:`_rare`), which is exact; there, members outside the most frequent
        component are compared with all others, PIVOTS of them a round, and leave. At the end every
        pair that can be linked has been compared or was in one component already.
        """
        leads = self.rows.where(F.col(self.keys).isNotNull())
        nodes = leads.join(self.classes.select(F.col("node").alias(self.uid)), self.uid)
        self.texts = nodes.select(F.col(self.uid).alias("node"), F.col(self.text).alias("text"))
        members = nodes.select(F.explode(self.keys).alias("key"), F.col(self.uid).alias("node"), F.col(self.n).alias("n"))
        shared = members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        buckets = stored(members.join(shared, "key"), "near-buckets")
        if buckets.isEmpty():
            return None
        self.texts = stored(self.texts.join(buckets.select("node").distinct(), "node", "left_semi"), "near-texts")
        popular = buckets.groupBy("node").agg(F.sum("members").alias("popular"))
        pivots = stored(buckets.join(popular, "node").groupBy("key").agg(
            F.max(F.struct("popular", "node", "n")).alias("top")).select(
                "key", F.col("top.node").alias("pivot"), F.col("top.n").alias("pn")), "near-pivots")
        links = self._verified(buckets.join(pivots, "key").where("node != pivot"))
        roots = components(links, "a", "b")
        rest = buckets.join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti")
        open_ = self._mixed(rest.withColumn("place", F.lit(1)), roots)
        if open_.isEmpty():
            return links
        open_ = self._mixed(self._rare(open_.select("node", "n").distinct()), roots)
        while not open_.isEmpty():
            sizes = open_.groupBy("key", "root").agg(F.count("*").alias("members"))
            most = sizes.groupBy("key").agg(F.max_by("root", "members").alias("most"))
            few = open_.join(most, "key").where("root != most")
            order = Window.partitionBy("key").orderBy("node")
            pivots = stored(few.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= PIVOTS).select(
                "key", F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("root").alias("proot"),
                F.col("place").alias("pplace")), "near-pivots")
            needed = F.ceil(F.lit(self.percent) * (F.col("n") + F.col("pn")) / F.lit(100 + self.percent))
            near_enough = (F.col("place") <= F.col("n") - needed + 1) & (F.col("pplace") <= F.col("pn") - needed + 1)
            more = self._verified(open_.join(pivots, "key").where("proot != root").where(near_enough))
            links = stored(links.unionByName(more), "near-links")
            roots = components(links, "a", "b")
            rest = open_.join(pivots.select("key", F.col("pivot").alias("node")), ["key", "node"], "left_anti")
            open_ = self._mixed(rest, roots)
        return links

    @staticmethod
    def _mixed(buckets: DataFrame, roots: DataFrame) -> DataFrame:
        """Members (key, node, n, place, root) of the buckets that hold more than one component."""
        labelled = (buckets.select("key", "node", "n", "place").join(roots, "node", "left")
                    .withColumn("root", F.coalesce("root", "node")))
        labelled = stored(labelled, "near-labelled")
        mixed = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
        return stored(labelled.join(mixed.select("key"), "key", "left_semi"), "near-open")

    def _rare(self, nodes: DataFrame) -> DataFrame:
        """Buckets (key, node, n, place in the order) such that any two similar sets of ``nodes`` share one.

        Sets A and B reach the threshold only if they share t = percent (|A| + |B|) / (100 + percent)
        shingles, so in any common order each has one of the shared ones among its first
        |A| - t + 1. The order is by the number of sets, rarest first: what edits have added comes
        before what all copies hold. Sizes fall into classes, and a key is a shingle and two classes, so
        that t follows from it. Shingles of one set make no key.
        """
        k, percent = self.k, self.percent

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            for record in batches:
                for lot in range(0, record.num_rows, 256):
                    part = record.slice(lot, 256)
                    sets = [shingle_hashes(words_of(t), k).view(np.int64) for t in part.column(2).to_pylist()]
                    sizes = [len(s) for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(part.column(i).to_numpy(), sizes)) for i in (0, 1)]
                        + [pa.array(np.concatenate(sets))], names=["node", "n", "shingle"])

        each = stored(nodes.join(self.texts, "node").select("node", "n", "text").mapInArrow(
            cut, "node long, n long, shingle long"), "near-shingles")
        often = each.groupBy("shingle").agg(F.count("*").alias("sets")).where("sets > 1")
        order = Window.partitionBy("node").orderBy(F.coalesce("sets", F.lit(1)), "shingle")
        first = (each.join(often, "shingle", "left").withColumn("nth", F.row_number().over(order))
                 .where("sets is not null").where(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1))
        step = math.log(SIZE_CLASS)

        def size_class(n):
            return F.floor(F.log(n.cast("double")) / F.lit(step) + F.lit(1e-9))

        low, high = F.ceil(F.col("n") * percent / 100), F.floor(F.col("n") * 100 / percent)
        classes = F.sequence(size_class(low), size_class(high))
        least = F.greatest(low, F.ceil(F.exp(F.col("other") * F.lit(step)) * F.lit(1 - 1e-9) - F.lit(1e-6)))
        needed = F.ceil(F.lit(percent) * (F.col("n") + least) / F.lit(100 + percent))
        paired = (first.withColumn("own", size_class(F.col("n"))).withColumn("other", F.explode(classes))
                  .where(F.col("nth") <= F.col("n") - needed + 1))
        return paired.select(F.xxhash64("shingle", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
                             "node", "n", F.col("nth").alias("place")).distinct()

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose whole sets are similar enough, compared as words."""
        k, percent = self.k, self.percent
        fit = pairs.where(F.lit(100) * F.least("n", "pn") >= F.lit(percent) * F.greatest("n", "pn"))
        pairs = fit.select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")).distinct()
        texts = self.texts
        both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
                .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
                .select("a", "b", "ta", "tb"))

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            let_go()
            last, own = None, set()
            for record in batches:
                for lot in range(0, record.num_rows, 256):
                    part = record.slice(lot, 256)
                    keep = []
                    left, mine, other = (part.column(i).to_pylist() for i in (0, 2, 3))
                    for i, a in enumerate(left):
                        if a != last:
                            last, own = a, shingle_set(words_of(mine[i]), k)
                        theirs = shingle_set(words_of(other[i]), k)
                        met = len(own & theirs)
                        keep.append(100 * met >= percent * (len(own) + len(theirs) - met))
                    yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return stored(both.mapInArrow(verify, "a long, b long"), "near-links")

    def labelled(self, id_col: str) -> DataFrame:
        """Every row as (id, uid, n, root): the node that stands for its component, null without words."""
        roots = self.classes.withColumn("root", F.col("node"))
        if self.roots is not None:
            roots = (self.classes.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        named = roots.select(F.col(self.fa).alias("fa"), F.col(self.fb).alias("fb"), "root")
        rows = self.rows.select(F.col(f"`{id_col}`").alias("id"), F.col(self.uid).alias("uid"), F.col(self.n).alias("n"),
                                F.col(self.fa).alias("fa"), F.col(self.fb).alias("fb"))
        return rows.join(named, ["fa", "fb"], "left").select("id", "uid", "n", "root")


def near_groups(df: DataFrame, id_col: str, text_col: str, k: int = 5, percent: int = 80) -> DataFrame:
    """Every row's group: ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable), ``kept``.

    A row's set holds its distinct ``k``-word shingles (fewer words are one shingle). Rows with
    equal sets, and rows whose sets reach ``percent``, are linked; groups are the components.
    Null and empty texts have empty sets and are linked with nothing: they are groups of one and
    kept. Rows with null ids belong to groups but do not name them. Repeated ids of the group's
    smallest id are all marked kept here; :func:`drop_near_copies` keeps one. An empty table
    gives no rows. Other columns are not read.
    """
    found = NearDuplicates(df, text_col, [id_col], k, percent)
    rows = found.labelled(id_col)
    low = rows.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("low"))
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("low"))
    return rows.join(low, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"))


def drop_near_copies(df: DataFrame, id_col: str, text_col: str, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group with all its columns: the smallest id, of equal ids the first; null ids last."""
    found = NearDuplicates(df, text_col, df.columns, k, percent)
    rows = found.labelled(id_col)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("uid").alias("uid"))
    group = F.coalesce(F.col("root"), -F.col("uid") - F.lit(1))  # rows without words stand alone
    best = rows.groupBy(group.alias("group")).agg(F.min(order).alias("best")).select(F.col("best.uid").alias(found.uid))
    return found.rows.join(best, found.uid, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
