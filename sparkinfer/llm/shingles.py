"""Word shingles of texts, exact and as 64-bit numbers."""

from __future__ import annotations

import hashlib

import numpy as np

# Odd constants of published 64-bit mixers.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words_of(text: str | None) -> list[bytes]:
    """Runs without blank, tab, line feed, vertical tab, form feed or return; A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], k: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of k words; fewer words are one run; no words give the empty set."""
    if not words:
        return set()
    return set(zip(*(words[i:] for i in range(k)), strict=False)) if len(words) >= k else {tuple(words)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingle set."""
    return np.unique(shingle_run(words, k))


def shingle_run(words: list[bytes], k: int) -> np.ndarray:
    """64-bit hashes of the shingles, in the order of the text."""
    import xxhash

    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(each))
    n = len(each) - k + 1
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out = mix((out + GOLDEN) ^ each[i:i + n])
    return out


def fingerprint(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits over a sorted set of hashes, as two signed numbers."""
    digest = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
