"""Benchmark decontamination by SimHash of item-sized windows and a multi-index over Hamming blocks."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sparkinfer.llm.common import fresh, per_worker
from sparkinfer.llm.shingles import GOLDEN, mix

#: Fingerprint bits, as blocks of 16.
BITS, BLOCK = 128, 16
#: Sets at 0.8 have a cosine of 8/9, so 0.15 of the bits differ: 19.4 of 128, deviation 4.1.
#: Within 40 bits lies all but one pair in three million. Pairs that may have a smaller cosine,
#: because a shingle repeats or ``percent`` is lower, are not left to the fingerprints.
RADIUS, LEAST_COSINE = 40, (8, 9)
#: Item texts sent to the executors at once; more items are searched in several passes.
PASS_BYTES = 16 << 20
WORD = re.compile(r"\w+")
CACHE_WORDS = 300_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, in small letters."""
    return WORD.findall((text or "").lower())


def weighted_shingles(words: list[str], k: int) -> Counter:
    """Shingles with the number of times they occur."""
    return Counter(zip(*(words[i:] for i in range(k)), strict=False))


def similar(a: Counter, b: Counter) -> tuple[int, int]:
    """Sum of the smaller and of the larger weights; their ratio is the weighted similarity."""
    low = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return low, sum(a.values()) + sum(b.values()) - low


def feature_bits(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for every fingerprint bit of every shingle."""
    two = np.stack([mix(hashes + GOLDEN), mix(hashes ^ GOLDEN)], axis=1)
    bits = np.unpackbits(two.view(np.uint8).reshape(len(hashes), BITS // 8), axis=1)
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def pack_signs(sums: np.ndarray) -> np.ndarray:
    """Fingerprints (rows x blocks of 16 bits) from signed sums."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


def _in_sorted(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class MultiIndex:
    """Fingerprints by the values of their blocks; finds all within RADIUS of a fingerprint.

    Of BITS / BLOCK blocks at least one differs in at most RADIUS * BLOCK / BITS bits, so the items
    near in no block are out; the others' whole distance decides.
    """

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.near = RADIUS * BLOCK // BITS
        self.values, self.members = [], []
        for b in range(prints.shape[1]):
            values, inverse = np.unique(prints[:, b], return_inverse=True)
            self.values.append(values)
            self.members.append([np.flatnonzero(inverse == i) for i in range(len(values))])

    def search(self, prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Row of ``prints`` with the items within RADIUS."""
        found: dict[int, set[int]] = defaultdict(set)
        for b, (values, members) in enumerate(zip(self.values, self.members, strict=True)):
            for lot in range(0, len(prints), 256):
                part = prints[lot:lot + 256, b]
                close = np.bitwise_count(part[:, None] ^ values[None, :]) <= self.near
                for w, v in zip(*np.nonzero(close), strict=True):
                    found[lot + int(w)].update(members[v].tolist())
        for w, items in found.items():
            at = np.fromiter(items, np.int64, len(items))
            distance = np.bitwise_count(self.prints[at] ^ prints[w]).sum(axis=1, dtype=np.int64)
            if (distance <= RADIUS).any():
                yield w, at[distance <= RADIUS]


class Holders:
    """Items of one length by shingle, and the similarity of all windows of a text to one of them."""

    def __init__(self, runs: list[np.ndarray]):
        self.span = len(runs[0])
        self.shingles, each = np.unique(np.concatenate(runs), return_inverse=True)
        who = np.repeat(np.arange(len(runs)), self.span)
        pairs, self.weight = np.unique(each * len(runs) + who, return_counts=True)
        self.item = pairs % len(runs)
        self.first = np.searchsorted(pairs // len(runs), np.arange(len(self.shingles) + 1))
        by_item = np.argsort(self.item, kind="stable")
        self.of_item = np.split(by_item, np.searchsorted(self.item[by_item], np.arange(1, len(runs))))
        self.squares = np.bincount(self.item, self.weight.astype(float) ** 2, len(runs)).astype(np.int64)

    def sharing(self, found: np.ndarray, least: int) -> np.ndarray:
        """Items that hold at least so many of the places ``found``, given as numbers of shingles."""
        numbers, times = np.unique(found, return_counts=True)
        n = self.first[numbers + 1] - self.first[numbers]
        at = np.repeat(self.first[numbers] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.flatnonzero(np.bincount(self.item[at], np.repeat(times, n)) >= least)

    def shared(self, item: int, hits: np.ndarray, found: np.ndarray, last: int) -> np.ndarray:
        """Sum of the smaller weights for every window from 0 to ``last``.

        A place counts where it lies in the window with fewer than the item's weight of earlier
        places of its shingle, which holds for one interval of windows.
        """
        pairs = self.of_item[item]
        numbers = np.searchsorted(self.first, pairs, "right") - 1
        own = np.minimum(np.searchsorted(numbers, found), len(numbers) - 1)
        mine = numbers[own] == found
        own, place = own[mine], hits[mine]
        order = np.argsort(own, kind="stable")
        own, place = own[order], place[order]
        before = np.arange(len(own)) - self.weight[pairs][own]
        inside = before >= np.searchsorted(own, own)
        start = np.maximum(np.where(inside, place[np.maximum(before, 0)], -1), place - self.span) + 1
        end = np.minimum(place, last)
        held = start <= end
        change = np.zeros(last + 2, np.int64)
        np.add.at(change, start[held], 1)
        np.add.at(change, end[held] + 1, -1)
        return np.cumsum(change[:-1])


def window_squares(run: np.ndarray, span: int) -> np.ndarray:
    """Sum of squared weights of every window of ``span`` shingles."""
    n = len(run)
    place = np.arange(n)
    number = np.unique(run, return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    keys = number[order] * (n + 1) + order
    rank = np.empty(n, np.int64)
    rank[order] = place
    # weight of a place's shingle in the window that ends, and in the one that begins with it
    ending = rank + 1 - np.searchsorted(keys, number * (n + 1) + np.maximum(place - span + 1, 0))
    beginning = np.searchsorted(keys, number * (n + 1) + np.minimum(place + span, n)) - rank
    come = np.cumsum(2 * ending - 1)
    gone = np.concatenate([[0], np.cumsum(2 * beginning - 1)])
    return come[span - 1:] - gone[:n - span + 1]


class Searcher:
    """Windows of texts against one pass of items."""

    def __init__(self, items: list[str], k: int, percent: int):
        self.k, self.percent = k, percent
        self.known: dict[str, int] = {}
        self.words = [words_of(t) for t in items]
        self.shapes = sorted({(min(k, len(w)), len(w)) for w in self.words if w})
        self.weights = [weighted_shingles(w, min(k, len(w))) if w else Counter() for w in self.words]
        self.by_shape, self.any = {}, {}
        for kk, size in self.shapes:
            own = [i for i, w in enumerate(self.words) if len(w) == size]
            runs = [self.run(self.words[i], kk) for i in own]
            prints = pack_signs(np.stack([feature_bits(r).sum(axis=0, dtype=np.int64) for r in runs]))
            self.by_shape[size] = (own, MultiIndex(prints), Holders(runs))
        for kk in {kk for kk, _ in self.shapes}:
            every = np.unique(np.concatenate([self.by_shape[s][2].shingles for k2, s in self.shapes if k2 == kk]))
            bloom = np.zeros(1 << 20, bool)
            bloom[every >> np.uint64(44)] = True
            self.any[kk] = (bloom, every)

    def run(self, words: list[str], kk: int) -> np.ndarray:
        import xxhash

        known = self.known
        new = set(words).difference(known)
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set(words)
        known.update((w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))) for w in new)
        each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(0, len(each) - kk + 1)
        out = np.zeros(n, np.uint64)
        for i in range(kk):
            out = (out ^ each[i:i + n]) * GOLDEN
            out ^= out >> np.uint64(29)
        return out

    def search(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """Items found in a text, with similarity, first word and number of words of the best window."""
        words = words_of(text)
        best: dict[int, tuple[float, int, int]] = {}
        for kk, (bloom, every) in self.any.items():
            run = self.run(words, kk)
            maybe = np.flatnonzero(bloom[run >> np.uint64(44)])
            hits = maybe[_in_sorted(run[maybe], every)]
            if not len(hits):
                continue
            for k2, size in self.shapes:
                if k2 == kk:
                    own, index, holders = self.by_shape[size]
                    inside = hits[_in_sorted(run[hits], holders.shingles)]
                    self._windows(words, run, inside, kk, size, own, index, best)
                    self._repeats(words, run, inside, kk, size, own, holders, best)
        return best

    def _compare(self, words, start, kk, size, found, best) -> None:
        """Keep a window for those of the items that it is similar to, if it is the best so far."""
        window = words[start:start + size]
        weights = weighted_shingles(window, min(kk, len(window)))
        for i in found:
            low, high = similar(weights, self.weights[i])
            if 100 * low >= self.percent * high and low / high > best.get(i, (0.0,))[0]:
                best[i] = (low / high, start, len(window))

    def _repeats(self, words, run, hits, kk, size, own, holders, best) -> None:
        """Pairs that RADIUS does not cover, by the weights themselves.

        A similar pair shares ``need`` of its weights, whose products are at least as many, so its
        cosine is at least need / (norm x norm). Where that is below LEAST_COSINE, the window is
        compared without fingerprints.
        """
        length = min(holders.span, len(run))
        both, p = holders.span + length, self.percent
        need = max(1, -(-p * both // (100 + p)))
        if len(hits) < need:
            return
        found = np.searchsorted(holders.shingles, run[hits])
        squares = None
        for i in holders.sharing(found, need).tolist():
            if squares is None:
                squares = window_squares(run, length)
            covered = (LEAST_COSINE[1] * p * both) ** 2 // ((LEAST_COSINE[0] * (100 + p)) ** 2 * int(holders.squares[i]))
            if int(squares.max()) <= covered:
                continue
            low = holders.shared(i, hits, found, len(run) - length)
            starts = np.flatnonzero((100 * low >= p * (both - low)) & (squares > covered))
            # equal hashes of unequal shingles could only raise a sum: the first whose words agree is the best
            for start in starts[np.argsort(-low[starts], kind="stable")].tolist():
                ratio = int(low[start]) / (both - int(low[start]))
                if ratio <= best.get(own[i], (0.0,))[0]:
                    break
                self._compare(words, start, kk, size, [own[i]], best)

    def _windows(self, words, run, hits, kk, size, own, index, best) -> None:
        """All windows of ``size`` words that hold a shingle of an item; no other can be similar."""
        if not len(hits):
            return
        span = size - kk + 1  # shingles of a window
        last = max(0, len(run) - span)
        mark = np.zeros(last + 2, np.int32)
        np.add.at(mark, np.clip(hits - span + 1, 0, last), 1)
        np.add.at(mark, np.minimum(hits, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        for group in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for at in range(0, len(group), 4096):
                part = group[at:at + 4096]
                lo, hi = int(part[0]), min(int(part[-1]) + span, len(run))
                sums = np.concatenate([np.zeros((1, BITS), np.int32),
                                       np.cumsum(feature_bits(run[lo:hi]), axis=0, dtype=np.int32)])
                ends = np.minimum(part - lo + span, hi - lo)
                prints = pack_signs(sums[ends] - sums[part - lo])
                for w, found in index.search(prints):
                    self._compare(words, int(part[w]), kk, size, [own[i] for i in found.tolist()], best)


def find_items(df: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text: str,
               k: int = 5, percent: int = 80) -> DataFrame:
    """Pairs of a row and a benchmark item that a window of the row's text repeats.

    Returns ``id_col``, ``item`` (the item's id), ``similarity``, ``start`` and ``n_words`` of the
    best window. A window has as many words as the item, or is the whole text where that is
    shorter; a text shorter than ``k`` words and not as long as the item has no shingle and no
    match. Shingles of ``k`` words (of items with fewer words, the item) are weighted by how often
    they occur; pairs at ``percent`` or more are kept. Null and empty texts and items match nothing;
    repeated rows and repeated items each give their own pairs; without rows or items there are
    none. Other columns are not read.

    Windows without a shingle of any item of their length have similarity 0 and get no
    fingerprint; all others, of whole texts, do. Where repeated shingles or a low ``percent``
    allow a cosine that fingerprints do not cover, windows are compared by their weights. Nothing is shuffled. Items go to the executors
    in passes of at most PASS_BYTES.
    """
    return _search(df.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias(
        fresh([id_col], "text"))), 1, items, item_col, item_text, k, percent, None)


def drop_contaminated(df: DataFrame, text_col: str, items: DataFrame, item_text: str, k: int = 5,
                      percent: int = 80) -> DataFrame:
    """The rows, with all their columns, in which :func:`find_items` finds nothing."""
    text = fresh(df.columns, "searched")
    out = df.withColumn(text, F.col(f"`{text_col}`").cast("string"))
    return _search(out, len(df.columns), items, None, item_text, k, percent, df.schema)


def _passes(items: DataFrame, item_col: str | None, item_text: str) -> Iterator[list]:
    """Items in lists of at most PASS_BYTES, each collected for itself."""
    chosen = items.select((F.col(f"`{item_col}`") if item_col else F.lit(0)).alias("item"),
                          F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("text"))
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = total // PASS_BYTES + 1
    for i in range(passes):
        yield chosen.where(F.pmod(F.xxhash64("text", "item"), F.lit(passes)) == i).collect()


def _search(df, width, items, item_col, item_text, k, percent, keep_schema) -> DataFrame:
    spark = df.sparkSession
    pair_schema = None if keep_schema else T.StructType([
        df.schema.fields[0], T.StructField("item", items.schema[item_col].dataType),
        T.StructField("similarity", T.DoubleType()), T.StructField("start", T.LongType()),
        T.StructField("n_words", T.LongType())])

    def one_pass(rows: DataFrame, chosen: list) -> DataFrame:
        item_type = None if keep_schema else to_arrow_type(pair_schema["item"].dataType)
        shared = spark.sparkContext.broadcast([(r["item"], r["text"]) for r in chosen])
        key = f"benchmark_{shared._jbroadcast.id()}"

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = [x[0] for x in shared.value]
            searcher = per_worker(key, lambda: Searcher([x[1] for x in shared.value], k, percent))
            for record in batches:
                found = [searcher.search(t) for t in record.column(width).to_pylist()]
                if keep_schema:
                    clean = record.filter(pa.array([not f for f in found], pa.bool_()))
                    yield clean
                    continue
                flat = [(i, item, *best) for i, f in enumerate(found) for item, best in sorted(f.items())]
                yield pa.RecordBatch.from_arrays(
                    [record.column(0).take(pa.array([f[0] for f in flat], pa.int64())),
                     pa.array([names[f[1]] for f in flat], item_type),
                     *(pa.array([f[c] for f in flat], t) for c, t in ((2, pa.float64()), (3, pa.int64()), (4, pa.int64())))],
                    names=pair_schema.names)

        return rows.mapInArrow(find, df.schema if keep_schema else pair_schema)

    if keep_schema:
        for chosen in _passes(items, item_col, item_text):
            df = one_pass(df, chosen)
        return df.select(*[F.col(f"`{c}`") for c in keep_schema.names])
    found = None
    for chosen in _passes(items, item_col, item_text):
        part = one_pass(df, chosen)
        found = part if found is None else found.unionByName(part)
    return found
