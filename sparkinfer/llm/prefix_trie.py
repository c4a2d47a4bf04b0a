"""Trie of conversation prefixes: sketch screening, local tails, exact grouping of what may be shared.

A prefix is known by 120 bits: the exclusive or over its turns of hashes of (place, digest of role and
text). Digests of turns are MD5, so texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkinfer.llm.common import stored, text_of
from sparkinfer.operators.joins import attach

#: Turns of one conversation that a task numbers or sums up at once.
BLOCK = 4096
#: Bits of a part of the sketch, cells for each prefix, and the most cells of one of its two rows (16 MB).
PART_BITS, CELLS_EACH, MOST_BITS = 17, 8, 27
#: Prefixes of one lot of a task's sketch, and conversation ids of one piece of text.
LOT, IDS = 1 << 20, 4096


def turn_digests(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row a turn: ``conv``, ``turn``, 120 bits ``a``, ``b`` of role and text, code points ``cp`` of the text."""
    said = F.md5(F.concat(F.length(text_of(role)).cast("string"), F.lit(":"), text_of(role), text_of(text)).cast("binary"))
    bits = [F.conv(F.substring(said, at, 15), 16, 10).cast("long") for at in (1, 17)]
    return df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), bits[0].alias("a"), bits[1].alias("b"),
        F.length(text_of(text)).cast("long").alias("cp"))


def placed_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows in the order of their conversation, with ``at`` (place among all rows), and ``conv, first, count``.

    Rows are dealt into ranges of (conversation, turn, digest, place in the input), so that a conversation
    with a third of all rows spans many tasks. Counts of ranges make the places gapless.
    """
    spark = turns.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "turn", "a", "b", "input"]
    ranged = (turns.withColumn("input", F.monotonically_increasing_id()).repartitionByRange(width, *order)
              .sortWithinPartitions(*order).withColumn("g", F.monotonically_increasing_id()))
    ranged = stored(ranged.select("conv", "a", "b", "cp", F.shiftright("g", 33).alias("task"),
                                  F.col("g").bitwiseAND(F.lit((1 << 33) - 1)).alias("place")), "trie-turns")
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = (ranged.groupBy("task").agg(F.count("*").alias("n"))  # at most `width` rows
             .select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    rows = ranged.join(F.broadcast(tasks), "task").select("conv", "a", "b", "cp", (F.col("offset") + F.col("place")).alias("at"))
    convs = rows.groupBy("conv").agg(F.min("at").alias("first"), F.count("*").alias("count"))
    return rows, stored(convs, "trie-conversations")


def by_blocks(convs: DataFrame) -> DataFrame:
    """One row for each conversation and block of places it reaches: the other side of a join on (conv, block)."""
    last = F.col("first") + F.col("count") - 1
    return convs.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor(last / BLOCK))))


def with_openings(rows: DataFrame, convs: DataFrame, span: int, turns_of: Callable[[Column], Column],
                  most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of the first conversation of their ``span``.

    ``turns_of(conv)`` (0 to ``most``) turns come from conversation conv - conv % span, fewer if it has
    fewer, none if it is absent; the own turns after as many follow. Returns (conv, depth, a, b, cp)
    from depth 1, and (conv, length).
    """
    base = F.col("conv") - F.col("conv") % span
    leaders = convs.where(F.col("conv") == base)
    located = rows.withColumn("block", F.floor(F.col("at") / BLOCK))
    early = (located.where(F.col("conv") == base).join(by_blocks(leaders), ["conv", "block"])
             .where(F.col("at") - F.col("first") < most))
    heads = early.groupBy(F.col("conv").alias("base")).agg(  # at most `most` turns each
        F.array_sort(F.collect_list(F.struct((F.col("at") - F.col("first")).alias("i"), "a", "b", "cp"))).alias("head"))
    drop = turns_of(F.col("conv")).cast("long")
    joined = convs.withColumn("base", base).withColumn("dropped", drop).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<struct<i:bigint,a:bigint,b:bigint,cp:bigint>>")), F.lit(1),
                   F.col("dropped").cast("int"))
    known = stored(joined.select("conv", "first", "count", "dropped", head.alias("head")).withColumn(
        "taken", F.size("head").cast("long")), "trie-openings")
    own = (located.join(by_blocks(known.drop("head")), ["conv", "block"])
           .withColumn("i", F.col("at") - F.col("first")).where("i >= dropped")
           .select("conv", (F.col("i") - F.col("dropped") + F.col("taken") + 1).alias("depth"), "a", "b", "cp"))
    opening = known.select("conv", F.explode("head").alias("t")).select(
        "conv", (F.col("t.i") + 1).alias("depth"), "t.a", "t.b", "t.cp")
    lengths = known.select("conv", (F.col("taken") + F.greatest(F.lit(0), F.col("count") - F.col("dropped"))).alias("length"))
    return own.unionByName(opening), lengths


def running(rows: DataFrame, key: str, at: str, folds: dict[str, Callable[[Column], Column]],
            join: Callable[[Column, Column], Column]) -> DataFrame:
    """Fold the named columns along ``at`` within ``key``, rows of equal ``at`` together.

    Within blocks of ``BLOCK`` places first, then over the blocks of a key, so a key with a third of
    all rows is folded by many tasks; a task gets one row a block of it.
    """
    blocked = rows.withColumn("block", F.floor(F.col(at) / BLOCK))
    wholes = blocked.groupBy(key, "block").agg(*[f(F.col(c)).alias(c) for c, f in folds.items()])
    over = Window.partitionBy(key).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = wholes.select(key, "block", *[f(F.col(c)).over(over).alias(f"_{c}") for c, f in folds.items()])
    within = Window.partitionBy(key, "block").orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    folded = blocked.select(*[c for c in blocked.columns if c not in folds], *[f(F.col(c)).over(within).alias(c) for c, f in folds.items()])
    met = folded.join(before, [key, "block"], "left")
    return met.select(*[join(F.col(c), F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) if c in folds else F.col(c)
                        for c in rows.columns])


def prefix_digests(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each prefix: (conv, depth, cp, fa, fb) with its parent's digest (pa, pb)."""
    tagged = turns.select("conv", "depth", "cp", F.xxhash64("depth", "a", "b").alias("ta"), F.xxhash64("b", "depth", "a").alias("tb"))
    both = tagged.withColumns({"fa": F.col("ta"), "fb": F.col("tb")})
    folded = running(both, "conv", "depth", {"fa": F.bit_xor, "fb": F.bit_xor}, lambda x, y: x.bitwiseXOR(y))
    return folded.select("conv", "depth", "cp", "fa", "fb", F.col("fa").bitwiseXOR(F.col("ta")).alias("pa"),
                         F.col("fb").bitwiseXOR(F.col("tb")).alias("pb"))


class Sketch:
    """Count-min sketch of prefix digests with two rows of counters that stop at two.

    A prefix whose smaller counter is one is the only one of its kind. The sketch has ``CELLS_EACH``
    cells a prefix up to 2^``MOST_BITS`` cells a row, so what is broadcast is at most 32 MB; with more
    prefixes more of them look shared and go the exact way, which changes no result.
    """

    def __init__(self, prefixes: DataFrame, n: int):
        self.bits = bits = int(min(MOST_BITS, max(PART_BITS, int(n * CELLS_EACH - 1).bit_length())))
        mask, size = np.uint64((1 << bits) - 1), 1 << PART_BITS

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Cells of a lot by part: those seen once, and those seen again."""
            def out(lot: list) -> Iterator[pa.RecordBatch]:
                for row in (0, 1):
                    cell, seen = np.unique(np.concatenate([p[row] for p in lot]) & mask, return_counts=True)
                    part = (cell >> np.uint64(PART_BITS)).astype(np.int64)
                    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
                    held = []
                    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                        place = (cell[lo:hi] & np.uint64(size - 1)).astype(np.uint32)
                        coded = np.diff((place << np.uint32(1)) | (seen[lo:hi] > 1), prepend=np.uint32(0)).astype(np.uint32)
                        held.append((row, int(part[lo]), zlib.compress(coded.tobytes(), 1)))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*held, strict=True)], names=["row", "part", "cells"])

            lot, many = [], 0
            for record in batches:
                lot.append([record.column(i).to_numpy().view(np.uint64) for i in (0, 1)])
                many += record.num_rows
                if many >= LOT:
                    yield from out(lot)
                    lot, many = [], 0
            if many:
                yield from out(lot)

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Rows sorted by part; one bit a cell says that its counter is two or more."""
            key, counts = None, np.zeros(size, np.uint8)
            for record in batches:
                for row, part, coded in zip(*(record.column(i).to_pylist() for i in range(3)), strict=True):
                    if key != (row, part):
                        if key is not None:
                            yield pa.RecordBatch.from_pydict({"row": [key[0]], "part": [key[1]], "bits": [np.packbits(counts > 1).tobytes()]})
                        key, counts = (row, part), np.zeros(size, np.uint8)
                    both = np.cumsum(np.frombuffer(zlib.decompress(coded), np.uint32), dtype=np.uint32)
                    place = both >> np.uint32(1)
                    counts[place] = np.minimum(2, counts[place] + 1 + (both & np.uint32(1)).astype(np.uint8))
            if key is not None:
                yield pa.RecordBatch.from_pydict({"row": [key[0]], "part": [key[1]], "bits": [np.packbits(counts > 1).tobytes()]})

        parts = (prefixes.select("fa", "fb").mapInArrow(cells, "row long, part long, cells binary")
                 .repartition("row", "part").sortWithinPartitions("row", "part").mapInArrow(merge, "row long, part long, bits binary"))
        several = np.zeros((2, 1 << max(0, bits - 3)), np.uint8)
        for r in parts.toLocalIterator():
            at = r["part"] << (PART_BITS - 3)
            several[r["row"], at:at + (size >> 3)] = np.frombuffer(r["bits"], np.uint8)
        self.shared = prefixes.sparkSession.sparkContext.broadcast(several)

    def screen(self, prefixes: DataFrame) -> DataFrame:
        """Adds ``alone`` and ``parent_alone``: the sketch proves that no other conversation has it."""
        shared, mask = self.shared, np.uint64((1 << self.bits) - 1)
        at = [prefixes.columns.index(c) for c in ("fa", "fb", "pa", "pb")]

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            several = shared.value

            def alone(record: pa.RecordBatch, columns: list[int]) -> pa.Array:
                proof = np.zeros(record.num_rows, bool)
                for row, c in enumerate(columns):
                    cell = record.column(c).to_numpy().view(np.uint64) & mask
                    bit = np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8)
                    proof |= ((several[row][(cell >> np.uint64(3)).astype(np.int64)] >> bit) & 1) == 0
                return pa.array(proof)

            for record in batches:
                yield pa.RecordBatch.from_arrays([*record.columns, alone(record, at[:2]), alone(record, at[2:])],
                                                 names=[*record.schema.names, "alone", "parent_alone"])

        fields = ", ".join(f"{c} {t}" for c, t in prefixes.dtypes)
        return prefixes.mapInArrow(judge, f"{fields}, alone boolean, parent_alone boolean")


def _ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined, ascending ``conv`` of each (fa, fb), fed piece by piece.

    Ranges of (fa, fb, conv) make pieces of at most ``IDS`` ids in many tasks; the digest of a key
    reads its pieces in order and holds one at a time.
    """
    width = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for record in batches:
            fa, fb, conv = (record.column(i).to_numpy() for i in range(3))
            new = np.ones(len(fa), bool)
            new[1:] = (fa[1:] != fa[:-1]) | (fb[1:] != fb[:-1])
            starts = np.flatnonzero(new)
            cuts = np.unique(np.concatenate([np.arange(s, e, IDS) for s, e in zip(starts, [*starts[1:], len(fa)], strict=True)]
                                            or [np.zeros(0, np.int64)])).astype(np.int64)
            texts = [",".join(map(str, conv[s:e].tolist())) for s, e in zip(cuts, [*cuts[1:], len(fa)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(fa[cuts]), pa.array(fb[cuts]), pa.array(conv[cuts]), pa.array(texts)],
                                             names=["fa", "fb", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for record in batches:
            out = []
            for fa, fb, ids in zip(*(record.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if key != (fa, fb):
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (fa, fb), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["fa", "fb", "sha"])
        if key is not None:
            yield pa.RecordBatch.from_pydict({"fa": [key[0]], "fb": [key[1]], "sha": [sha.hexdigest()]})

    pieces = (ends.select("fa", "fb", "conv").repartitionByRange(width, "fa", "fb", "conv").sortWithinPartitions("fa", "fb", "conv")
              .mapInArrow(join, "fa long, fb long, first long, ids string"))
    return (pieces.repartition("fa", "fb").sortWithinPartitions("fa", "fb", "first")
            .mapInArrow(digest, "fa long, fb long, sha string"))


def trie_nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Nodes of the trie of conversations; see :func:`prefix_trie` for the columns.

    ``turns`` has (conv, depth from 1, a, b, cp), ``lengths`` every (conv, length), turnless ones too.
    Sums over subtrees are sums over members: what hangs at a node is credited to its smallest
    member, suffix sums run along each conversation, and the members of a node add theirs. So depth
    costs no rounds and hot nodes are met by partial aggregation only.
    """
    lengths = stored(lengths, "trie-lengths")
    prefixes = stored(prefix_digests(turns, lengths), "trie-prefixes")
    top = lengths.agg(F.count("*").alias("n"), F.min("conv").alias("low"), F.sum("length").alias("prefixes")).first()
    sketch = Sketch(prefixes, top["prefixes"] or 1)
    last = prefixes.groupBy("conv").agg(F.max("depth").alias("end"))
    screened = sketch.screen(prefixes)
    local, shared = screened.where("alone"), stored(screened.where("not alone").drop("alone", "parent_alone"), "trie-shared")
    # the deepest prefix of a conversation carries its length
    ends = last.select("conv", F.col("end").alias("depth"), F.lit(True).alias("ends"))
    local = stored(local.join(ends, ["conv", "depth"], "left").withColumn("ends", F.coalesce("ends", F.lit(False))), "trie-tails")

    nodes = shared.groupBy("fa", "fb").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("depth").alias("depth"), F.min("cp").alias("cp"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"))
    nodes = stored(nodes, "trie-nodes")
    tops = local.where("not parent_alone and depth > 1")
    children = (nodes.where("depth > 1").select("pa", "pb").unionByName(tops.select("pa", "pb"))
                .groupBy("pa", "pb").agg(F.count("*").alias("n_children")))
    nodes = nodes.join(children.withColumnsRenamed({"pa": "fa", "pb": "fb"}), ["fa", "fb"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stored(nodes, "trie-nodes")

    hung = nodes.select(F.col("conv_id").alias("conv"), "depth", ((F.col("n_convs") - 1) * F.col("cp")).alias("saved"),
                        (F.col("n_children") == 0).cast("long").alias("leaves"))
    leaves = local.where("ends").select("conv", "depth", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("leaves"))
    hung = hung.where("saved > 0 or leaves > 0").unionByName(leaves)
    none = F.lit(None).cast("long")
    stepped = (shared.select("conv", "depth", "fa", "fb", F.lit(0).cast("long").alias("saved"), F.lit(0).cast("long").alias("leaves"))
               .unionByName(hung.withColumns({"fa": none, "fb": none})).withColumn("up", -F.col("depth")))
    summed = running(stepped, "conv", "up", {"saved": F.sum, "leaves": F.sum}, lambda x, y: x + y)
    under = summed.where("fa is not null").groupBy("fa", "fb").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ended = shared.join(ends, ["conv", "depth"], "left_semi").select("fa", "fb", "conv")
    shas = _ends_digest(ended)
    whole = nodes.join(under, ["fa", "fb"]).join(shas, ["fa", "fb"], "left")

    parents = nodes.where("n_children > 0").select(
        F.col("fa").alias("pa"), F.col("fb").alias("pb"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    figures = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "pa", "pb"]
    grouped = whole.withColumn("ends_sha256", F.coalesce("sha", empty)).select(*figures)
    one = F.lit(1).cast("long")
    tails = local.select(
        F.col("conv").alias("conv_id"), "depth", one.alias("n_convs"), F.when(F.col("ends"), 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("ends"), F.sha2(F.col("conv").cast("string").cast("binary"), 256)).otherwise(empty).alias("ends_sha256"),
        "pa", "pb", "parent_alone")
    deep = grouped.where("depth > 1").unionByName(tails.where("not parent_alone and depth > 1").drop("parent_alone"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    low = F.lit(top["low"]).cast("long").alias("parent_conv_id")
    # a parent that is no shared node was proved to have one member, and so has its child
    looked = _with_parents(deep, parents).withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv_id")).select(*out)
    first = grouped.where("depth = 1").unionByName(tails.where("depth = 1").drop("parent_alone")).withColumn("parent_conv_id", low).select(*out)
    inner = tails.where("parent_alone and depth > 1").withColumn("parent_conv_id", F.col("conv_id")).select(*out)

    # the root: every conversation is a member
    below = hung.agg(F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"), F.coalesce(F.sum("leaves"), F.lit(0)).alias("leaves")).first()
    n_first = nodes.where("depth = 1").count() + local.where("depth = 1").count()
    zero = F.lit(0).cast("long")
    turnless = lengths.where("length = 0").select(zero.alias("fa"), zero.alias("fb"), "conv")
    root = turnless.sparkSession.range(1 if top["n"] else 0).select(
        zero.alias("fa"), zero.alias("fb"), low.alias("conv_id"), zero.alias("depth"), none.alias("parent_conv_id"),
        F.lit(top["n"]).cast("long").alias("n_convs"), F.lit(n_first).cast("long").alias("n_children"),
        F.lit(below["leaves"] or 1).cast("long").alias("n_leaves"), F.lit(below["saved"]).cast("long").alias("saved_tokens"))
    root = root.join(_ends_digest(turnless), ["fa", "fb"], "left").withColumn("ends_sha256", F.coalesce("sha", empty)).select(*out)
    return root.unionByName(first).unionByName(inner).unionByName(looked)


def _with_parents(rows: DataFrame, parents: DataFrame) -> DataFrame:
    """``parent_conv_id`` by digest; parents with very many children come from a broadcast (see ``attach``)."""
    return attach(rows.withColumnRenamed("n_children", "own_children"), parents, ["pa", "pb"], "n_children").drop("n_children").withColumnRenamed(
        "own_children", "n_children")


def prefix_trie(df: DataFrame, conv: str, turn: str, role: str, text: str,
                openings: tuple[int, Callable[[Column], Column], int] | None = None) -> DataFrame:
    """One row for each distinct sequence of first turns (role, text) of conversations.

    Columns: ``conv_id`` (smallest member), ``depth`` (0: the root of all), ``parent_conv_id`` (null for
    the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the subtree, itself included),
    ``saved_tokens`` (over the subtree: members less one, times the code points of the node's last
    text) and ``ends_sha256`` (of the ids that end here, ascending, comma-joined).

    Turns are ordered by ``turn``, null first; turns that tie, by their digest. Repeated rows are
    turns like others. Null roles and texts count as empty. Rows without a conversation id belong
    to none and are left out. ``openings`` = (span, turns_of, most) first replaces openings as in
    :func:`with_openings`; a conversation may lose all turns and then ends at the root. An empty
    table gives no rows. Other columns are not read.
    """
    turns = stored(turn_digests(df, conv, turn, role, text), "trie-digests")
    rows, convs = placed_turns(turns)
    span, turns_of, most = openings or (1, lambda c: F.lit(0), 0)
    return trie_nodes(*with_openings(rows, convs, span, turns_of, most))
