"""Token ids of texts, by a public tokenizer file, as little-endian unsigned 32-bit bytes."""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable
from itertools import islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa

#: Words a worker remembers, how many of them when there is no more room, and the longest it remembers.
CACHE_WORDS = 600_000
KEPT_WORDS = 250_000
CACHE_BYTES = 64
#: Texts are handled in lots of about so many bytes.
LOT_BYTES = 2_000_000
#: Fixed value: the pattern by which the file splits letters, digits and marks.
LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: What a byte is by that pattern. 0: not judged by itself (beyond ASCII, controls, ' and <); blanks and line feeds end words.
LETTER, DIGIT, MARK = 1, 2, 3
KINDS = np.array([0 if b < 33 and b not in (10, 32) or b > 126 or chr(b) in "'<" else
                  LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else MARK for b in range(256)], np.uint8)
#: Capitals as small letters.
SMALL = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

#: The letters that stand for bytes in the pieces: printable ones for themselves, the others from 256 on, in order.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLED = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


def tokenizer_json(path: str) -> str:
    """The tokenizer file's text, read by the driver; a fixed few megabytes, sent to executors as a broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def coder_name(source: str) -> str:
    """What a worker keeps a file's coder under; another file has another name."""
    return f"word_coder_{hashlib.sha256(source.encode()).hexdigest()}"


class WordCoder:
    """Encodes texts by their distinct parts with a cache; exact for tokenizers that break at blanks and line feeds.

    The files used here drop white space before they look for pieces and none of their added
    tokens holds a blank, so a text's ids are those of its blank-separated parts, in order.
    Where the file splits letters, digits and marks, printable ASCII words are cut there as well,
    so that a word is coded once whatever its capitals and the marks around it. The parts
    are found and numbered for a whole lot at once; only those not met before reach the tokenizer.
    """

    def __init__(self, source: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        #: The pieces alone, for parts that the steps before them leave as they are; None for other files.
        self.plain = self.tokenizer.model.tokenize if self._splits_letters(source) else None
        #: Parts by number, in the order they were met; the ids of number i are ids[first[i]:first[i + 1]].
        self.known: dict[bytes, int] = {}
        self.first = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    @staticmethod
    def _splits_letters(source: str) -> bool:
        """Whether the file composes, lower-cases and splits runs of letters from the rest, and does nothing else.

        Then its steps before the pieces leave runs of small letters in composed form and runs of
        ASCII marks as they are, but for the spelling of bytes as letters.
        """
        file = json.loads(source)
        before = [n["type"] for n in (file["normalizer"] or {}).get("normalizers", [])]
        split = (file["pre_tokenizer"] or {}).get("pretokenizers", [])
        return before == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in split] == ["Split", "ByteLevel"] and \
            split[0]["pattern"] == {"Regex": LETTER_RUNS} and not split[1]["add_prefix_space"]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        lot: list[bytes] = []
        size = 0
        for text in texts:
            lot.append(text.encode())
            size += len(lot[-1])
            if size >= LOT_BYTES:
                out += self._encode(lot)
                lot, size = [], 0
        return out + (self._encode(lot) if lot else [])

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        parts, starts = self._parts(np.frombuffer(b"\n".join([*texts, b""]), np.uint8))
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [p for p in distinct if p not in self.known]
        if len(self.known) + len(new) > CACHE_WORDS:
            # frequent words were met early, so the oldest entries are the ones to keep
            self._forget(KEPT_WORDS)
            new = [p for p in distinct if p not in self.known]
        kept = [p for p in new if len(p) <= CACHE_BYTES]
        self._learn(kept)
        held = len(self.known)
        if len(kept) < len(new):
            self._learn([p for p in new if len(p) > CACHE_BYTES])
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        ids = self._gather(number).astype("<u4", copy=False)
        ends = np.concatenate([[0], np.cumsum(np.diff(self.first)[number])])
        if held < len(self.known):
            self._forget(held)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = ends[np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]

    def _parts(self, raw: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The parts of a lot of bytes, and the place of each part's first byte."""
        inside = (raw != 32) & (raw != 10)
        head = inside.copy()
        head[1:] &= ~inside[:-1]
        if self.plain:
            kind = KINDS[raw]
            words = np.flatnonzero(head)
            # words of printable ASCII alone, without what contractions and added tokens begin with
            simple = np.logical_and.reduceat(kind != 0, words) if len(words) else np.zeros(0, bool)
            mine = np.repeat(simple, np.diff(words, append=len(raw)))
            mine = np.concatenate([np.zeros(len(raw) - len(mine), bool), mine])  # blanks before the first word
            raw = np.where(mine, SMALL[raw], raw)
            head[1:] |= inside[1:] & mine[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
        starts = np.flatnonzero(head)
        offsets = np.concatenate([[0], np.cumsum(inside)])[np.append(starts, len(raw))]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[inside].tobytes())]), starts

    def _forget(self, keep: int) -> None:
        """Drop all but the first ``keep`` parts."""
        self.known = dict(islice(self.known.items(), keep))
        self.first = self.first[:keep + 1].copy()
        self.ids = self.ids[:self.first[-1]].copy()

    def _learn(self, new: list[bytes]) -> None:
        """Number new parts, those that need no step before the pieces first."""
        hard = []
        if self.plain and new:
            kinds = KINDS[np.frombuffer(b"".join(new), np.uint8)]
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            easy = np.logical_and.reduceat(kinds != 0, np.cumsum(sizes) - sizes).tolist()
            hard = [p for p, e in zip(new, easy, strict=True) if not e]
            new = [p for p, e in zip(new, easy, strict=True) if e]
            self._enter(new, map(bytes.decode, new))
            self._learn_hard(hard)
        elif new:
            self._enter(new, None)

    def _learn_hard(self, new: list[bytes]) -> None:
        """Words beyond printable ASCII; one with a final stop is its stem and the stop."""
        marked, runs, rest = [], {}, []
        for part in new:
            word = part.decode()
            mark = word[-1] if word[-1] in ".," and word[:-1].lower().isalnum() else ""
            stem = word.removesuffix(mark)
            if mark:
                marked.append((part, part[:-1], part[-1:]))
            if stem.isalpha() and stem == stem.lower() and is_normalized("NFC", stem):
                runs[part[:-1] if mark else part] = None
            elif mark:
                rest.append(part[:-1])
            else:
                rest.append(part)
        runs = [r for r in runs if r not in self.known]
        self._enter(runs, (r.decode("latin-1").translate(SPELLED) for r in runs))
        self._enter([r for r in dict.fromkeys(rest) if r not in self.known], None)
        marks = [m for m in {m for _, _, m in marked} if m not in self.known]
        self._enter(marks, map(bytes.decode, marks))
        if marked:
            pairs = np.array([(self.known[s], self.known[m]) for _, s, m in marked]).ravel()
            sizes = np.diff(self.first)[pairs]
            self._append([p for p, _, _ in marked], self._gather(pairs), sizes[::2] + sizes[1::2])

    def _enter(self, parts: list[bytes], spelled: Iterable[str] | None) -> None:
        """Code parts by the pieces alone, as they are spelled there, or by all steps of the file."""
        if not parts:
            return
        if spelled is None:
            coded = self.tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
            found = (e.ids for e in coded)
        else:
            found = ([piece.id for piece in pieces] for pieces in map(self.plain, spelled))
        ids, sizes = array("I"), []
        for one in found:
            ids.extend(one)
            sizes.append(len(one))
        self._append(parts, np.frombuffer(ids, np.uint32), np.array(sizes, np.int64))

    def _append(self, parts: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        start = len(self.known)
        self.known.update(zip(parts, range(start, start + len(parts)), strict=True))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])

    def _gather(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of known parts, one part after another."""
        first = self.first[numbers]
        sizes = self.first[numbers + 1] - first
        ends = np.cumsum(sizes)
        return self.ids[np.repeat(first - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
