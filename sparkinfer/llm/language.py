"""Language identification by unigram pieces, summed over all segmentations of a text's words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkinfer.llm.common import fresh, let_go, per_worker

UNDETERMINED = "und"
#: Distinct labelled texts that are learned from, about so many of each language; the rest is not needed.
SAMPLE_TEXTS = 1500
#: Languages that may be told apart; the model is a table of pieces by languages on the driver.
MAX_LANGUAGES = 1000
#: Rounds of expectation and maximisation.
ROUNDS = 3
#: Runs of letters are scored in parts of at most so many, so that products stay in range.
PART = 32
#: Words whose scores a worker remembers.
CACHE_WORDS = 300_000
#: Every position's factor, so that sums stay near 1; the same for all languages.
SCALE = 16.0
UNKNOWN = 1e-7
#: Letters, and numerals that are no decimal digits.
ALPHABETIC = re.compile(r"[^\W\d_]+")
WORD_START = "▁"


def words_of(text: str | None) -> list[str]:
    """Runs of letters in small letters, cut in parts."""
    runs = ALPHABETIC.findall((text or "").lower())
    if not all(map(str.isalpha, runs)):
        runs = [w for r in runs for w in "".join(c if c.isalpha() else " " for c in r).split()]
    if any(len(r) > PART for r in runs):
        return [r[i:i + PART] for r in runs for i in range(0, len(r), PART)]
    return runs


def vocabulary(path: str) -> list[str]:
    """Pieces of a public sentencepiece file that can stand in a word, without its control pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in pieces if (p.removeprefix(WORD_START) or "a").isalpha()})


#: Fixed value: odd multiplier of the rolling hash of code points.
ROLL = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 18


class Pieces:
    """Numbered pieces by size, found by hash for many substrings at once; every hit is compared in full."""

    def __init__(self, number: dict[str, int]):
        self.unknown = len(number)
        by_size: dict[int, list[str]] = {}
        for piece in number:
            by_size.setdefault(len(piece), []).append(piece)
        self.longest = max(by_size, default=1)
        self.sizes = {}
        for size, pieces in by_size.items():
            codes = _codes(pieces)
            hashes = np.zeros(len(pieces), np.uint64)
            for i in range(size):
                hashes = (hashes + codes[:, i] + np.uint64(1)) * ROLL
            order = np.argsort(hashes)
            maybe = np.zeros(1 << FILTER_BITS, bool)  # rules most substrings out before the search
            maybe[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.sizes[size] = (hashes[order], codes[order], np.array([number[p] for p in pieces])[order], maybe)

    def find(self, size: int, hashes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, start, piece) of every piece of this size; ``hashes`` has one column a start."""
        none = np.zeros(0, np.int64)
        if size not in self.sizes:
            return none, none, none
        known, spelled, number, maybe = self.sizes[size]
        word, start = np.nonzero(maybe[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        wanted = hashes[word, start]
        word_hits, start_hits, piece_hits = [], [], []
        at = np.searchsorted(known, wanted)
        while len(word):  # pieces of one hash stand side by side
            fits = at < len(known)
            fits[fits] = known[at[fits]] == wanted[fits]
            word, start, at, wanted = word[fits], start[fits], at[fits], wanted[fits]
            same = np.ones(len(word), bool)
            for i in range(size):
                same &= codes[word, start + i] == spelled[at, i]
            word_hits.append(word[same])
            start_hits.append(start[same])
            piece_hits.append(number[at[same]])
            word, start, at, wanted = word[~same], start[~same], at[~same] + 1, wanted[~same]
        if not word_hits:
            return none, none, none
        return np.concatenate(word_hits), np.concatenate(start_hits), np.concatenate(piece_hits)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)


class Lattice:
    """All pieces at all places of words of one length: for each end and size the words that have one, and which.

    A place that no single-character piece covers still has to be crossed, by the unknown piece.
    """

    def __init__(self, words: list[str], pieces: Pieces):
        self.length, self.n = len(words[0]), len(words)
        codes = _codes(words)
        bare = np.ones(codes.shape, bool)
        words_at, ends, sizes, numbers = [], [], [], []
        hashes = np.zeros(codes.shape, np.uint64)
        for size in range(1, min(pieces.longest, self.length) + 1):
            hashes = (hashes[:, :self.length - size + 1] + codes[:, size - 1:] + np.uint64(1)) * ROLL
            word, start, number = pieces.find(size, hashes, codes)
            if size == 1:
                bare[word, start] = False
                lone, place = np.nonzero(bare)
                word, start = np.concatenate([word, lone]), np.concatenate([start, place])
                number = np.concatenate([number, np.full(len(lone), pieces.unknown)])
            words_at.append(word)
            ends.append(start + size)
            sizes.append(np.full(len(word), size))
            numbers.append(number)
        end, size = np.concatenate(ends), np.concatenate(sizes)
        cell = end * (pieces.longest + 1) + size
        order = np.argsort(cell, kind="stable")
        cell, word, number = cell[order], np.concatenate(words_at)[order], np.concatenate(numbers)[order]
        edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
        #: (end, size, words, pieces) by rising end; a word stands once in each
        self.cells = [(int(cell[a]) // (pieces.longest + 1), int(cell[a]) % (pieces.longest + 1), word[a:b], number[a:b])
                      for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over segmentations up to each place: (places + 1, words, languages). ``p`` has one row a piece."""
        a = np.zeros((self.length + 1, self.n, p.shape[1]))
        a[0] = 1.0
        for end, size, word, piece in self.cells:
            a[end][word] += a[end - size][word] * p[piece] * SCALE ** size
        return a

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece, by forward and backward sums; for one language."""
        a = self.forward(p)[:, :, 0]
        b = np.zeros((self.length + 1, self.n))
        b[self.length] = 1.0
        uses = np.zeros(len(p))
        for end, size, word, piece in reversed(self.cells):
            step = p[piece, 0] * SCALE ** size * b[end][word]
            b[end - size][word] += step
            np.add.at(uses, piece, a[end - size][word] * step / a[self.length][word] * counts[word])
        return uses


def _lattices(words: list[str], pieces: Pieces) -> Iterator[tuple[list[str], Lattice]]:
    """Marked words by length, in lots."""
    for _, same in groupby(sorted(words, key=len), key=len):
        same = list(same)
        for at in range(0, len(same), 2000):
            lot = same[at:at + 2000]
            yield lot, Lattice([WORD_START + w for w in lot], pieces)


def fit_pieces(words: dict[str, int], pieces: list[str]) -> np.ndarray:
    """Piece probabilities of one language by expectation-maximisation over its word counts.

    The last two rows are the unknown character and, for absent places, zero.
    """
    table = Pieces({p: i for i, p in enumerate(pieces)})
    lots = [(np.array([words[w] for w in lot], float), lattice) for lot, lattice in _lattices(list(words), table)]
    p = np.full((len(pieces) + 2, 1), 1.0 / len(pieces))
    p[-2], p[-1] = UNKNOWN, 0.0
    for _ in range(ROUNDS):
        uses = sum((lattice.expected(p, counts) for counts, lattice in lots), np.zeros(len(p)))[:-2]
        # an unseen piece keeps a share, so that no word is impossible in a language
        p[:-2, 0] = (uses + 0.01) / (uses.sum() + 0.01 * len(pieces))
    return p[:, 0]


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray
    pieces: list[str]
    probability: np.ndarray  # pieces + 2 rows, one column a language


class WordScores:
    """Log probabilities of words by language, each computed once."""

    def __init__(self, pieces: list[str], probability: np.ndarray):
        self.pieces = Pieces({p: i for i, p in enumerate(pieces)})
        self.p = probability
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((1024, self.p.shape[1]))

    def add(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.at]
        if len(self.at) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(words)
        start = len(self.at)
        if start + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((len(self.rows) + len(new), self.p.shape[1]))])
        for lot, lattice in _lattices(new, self.pieces):
            total = np.log(lattice.forward(self.p)[-1]) - lattice.length * np.log(SCALE)
            self.rows[start:start + len(lot)] = total
            self.at.update(zip(lot, range(start, start + len(lot)), strict=True))
            start += len(lot)

    def score(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        self.add({w for t in texts for w in t})
        at = self.at.__getitem__
        return [self.rows[np.fromiter(map(at, t), np.int64, len(t))].sum(axis=0) if t else None for t in texts]


def learn_languages(labelled: DataFrame, text_col: str, lang_col: str, pieces_file: str,
                    sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    """Piece probabilities of every language from labelled rows; rows without text or language are left out.

    Label counts, for the prior, cover all rows. Of each language about ``sample_texts`` distinct
    texts with a letter (all, if there are fewer), chosen by a hash of the text and the one with
    the smallest hash always among them, are cut into counted words, each text once however many
    copies it has; one task a language fits on those counts, whose number the sample bounds. Only
    a language without any letter is left out. Raises ValueError beyond MAX_LANGUAGES.
    """
    pieces = vocabulary(pieces_file)
    rows = labelled.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                           F.col(f"`{lang_col}`").cast("string").alias("lang")).dropna()
    hashed = F.xxhash64("text")
    lettered = F.when(F.col("text").rlike(r"\p{L}"), hashed)
    tally = (rows.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct(lettered, 0.02).alias("texts"),
                                      F.min(lettered).alias("first"))
             .orderBy("lang").limit(MAX_LANGUAGES + 1).collect())
    if len(tally) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not tally:
        return LanguageModel([], np.zeros(0), pieces, np.zeros((len(pieces) + 2, 0)))
    spark = labelled.sparkSession
    share = spark.createDataFrame([(r["lang"], min(1.0, sample_texts / max(1, r["texts"])), r["first"]) for r in tally],
                                  "lang string, share double, first long")
    drawn = (rows.join(F.broadcast(share), "lang")
             .where((F.pmod(hashed, F.lit(1_000_000)) < F.col("share") * 1_000_000) | (hashed == F.col("first")))
             .where(F.col("text").rlike(r"\p{L}")).select("lang", "text").distinct())

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for record in batches:
            tally: Counter = Counter()
            for lang, text in zip(record.column(0).to_pylist(), record.column(1).to_pylist(), strict=True):
                tally.update((lang, w) for w in words_of(text))
            if tally:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in tally]), pa.array([k[1] for k in tally]),
                     pa.array(list(tally.values()), pa.int64())], names=["lang", "word", "n"])

    counts = (drawn.mapInArrow(count_words, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    given = spark.sparkContext.broadcast(pieces)

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        words = dict(zip(part["word"], part["n"], strict=True))
        return pd.DataFrame({"lang": [part["lang"].iloc[0]], "p": [fit_pieces(words, given.value).tolist()]})

    fitted = {r["lang"]: r["p"] for r in counts.groupBy("lang").applyInPandas(fit, "lang string, p array<double>").collect()}
    languages = [r["lang"] for r in tally if r["lang"] in fitted]
    prior = np.array([r["count"] for r in tally if r["lang"] in fitted], float)
    table = np.array([fitted[x] for x in languages]).T if languages else np.zeros((len(pieces) + 2, 0))
    return LanguageModel(languages, np.log(prior / prior.sum()), pieces, table)


def predict_language(df: DataFrame, text_col: str, model: LanguageModel, lang: str = "lang_pred",
                     score: str = "score") -> DataFrame:
    """Add ``lang`` and ``score`` (posterior probability, 0 to 1) by the whole text alone.

    A null or empty text, or one without a letter, is ``und`` with score 0, as is every text
    under a model that has learned no language. Very long texts are scored whole, word by word;
    texts that fit two languages equally get the one that comes first by name. Columns named
    ``lang`` or ``score`` are replaced; all others come back as they are.
    """
    spark = df.sparkSession
    df = df.drop(lang, score)
    shared = spark.sparkContext.broadcast((model.pieces, model.probability, model.prior, model.languages))
    key = f"language_scores_{shared._jbroadcast.id()}"
    text = fresh(df.columns, "scored_text")
    schema = T.StructType([*df.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    width = len(df.columns)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, probability, prior, languages = shared.value
        scores = per_worker(key, lambda: WordScores(pieces, probability))
        for record in batches:
            for lot in range(0, record.num_rows, 256):
                part = record.slice(lot, 256)
                names, values = [], []
                for total in scores.score([words_of(t) for t in part.column(width).to_pylist()]):
                    if total is None or not languages:
                        names.append(UNDETERMINED)
                        values.append(0.0)
                        continue
                    total = total + prior
                    best = int(np.argmax(total))
                    names.append(languages[best])
                    values.append(float(1.0 / np.exp(total - total[best]).sum()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(width)), pa.array(names, pa.string()),
                                                  pa.array(values, pa.float64())], names=schema.names)

    return df.withColumn(text, F.col(f"`{text_col}`").cast("string")).mapInArrow(predict, schema)
