"""Word shingles of whole texts as sets of 64-bit hashes, and b-bit MinHash signatures of the sets."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker keeps at most.
CACHED_WORDS = 150_000
WORDS = 5
_ODD = np.random.default_rng(20240501).integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = np.random.default_rng(20240502).integers(0, 2**63, 64, dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


class Shingler:
    """Words are runs of anything but ASCII white space, with A-Z in lower case."""

    def __init__(self, n: int = WORDS) -> None:
        self.n, self.hashes = n, WordHashes()

    def sequence(self, text: str | None) -> np.ndarray:
        """The hashes of all shingles, in order; with fewer words than n one for the whole sequence; without words none."""
        words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.hashes) > CACHED_WORDS:
            self.hashes.clear()
        w = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(w))
        h = np.full(len(w) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ w[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return mix(h)

    def set(self, text: str | None) -> np.ndarray:
        """The distinct shingles, sorted."""
        return np.unique(self.sequence(text))


def signatures(sets: list[np.ndarray], positions: int) -> np.ndarray:
    """The lowest 16 bits of `positions` minima for each set; sets must not be empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), positions), np.uint16)
    for k in range(positions):
        out[:, k] = mix(np.minimum.reduceat((flat ^ _XOR[k]) * _ODD[k], starts)) & np.uint64(0xFFFF)
    return out
