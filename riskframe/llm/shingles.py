"""Word and shingle hashes with numpy, for use inside tasks.

A word's hash is a polynomial over its bytes modulo 2^64 with a random value per byte, finished
by a 64-bit mixer; a shingle's hash combines the hashes of its words in order.
"""

from __future__ import annotations

import hashlib

import numpy as np

SHINGLE_WORDS = 5
#: Bytes hashed at a time; longer words are replaced by their digest first.
BLOCK_BYTES, LONG_WORD = 1 << 19, 1 << 16


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values (public splitmix64 constants)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """Hash tables of one task (built in the task, never shipped)."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20240229)
        self.byte = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = 0x9E3779B97F4A7C15
        n = BLOCK_BYTES + LONG_WORD + 1
        self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base, np.uint64)]))
        self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, pow(base, -1, 2**64), np.uint64)]))
        self.place = rng.integers(1, 2**63, SHINGLE_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    @staticmethod
    def words(text: str | None) -> list[bytes]:
        """Words between ASCII white space, with A-Z in lower case."""
        return text.encode("utf-8", "surrogatepass").lower().split() if text else []

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        if n and lens.max() > LONG_WORD:
            words = [w if len(w) <= LONG_WORD else hashlib.blake2b(w).digest() + b" " for w in words]
            lens = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lens)
        out = np.empty(n, np.uint64)
        at = 0
        while at < n:
            base = ends[at] - lens[at]
            to = max(at + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
            raw = np.frombuffer(b"".join(words[at:to]), np.uint8)
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(self.byte[raw] * self.up[: len(raw)], out=sums[1:])
            e = ends[at:to] - base
            s = e - lens[at:to]
            out[at:to] = (sums[e] - sums[s]) * self.down[s] + lens[at:to].astype(np.uint64)
            at = to
        return mix(out)

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the 5-word shingles; a shorter text is one shingle; no words: empty."""
        h = self.word_hashes(self.words(text))
        if not len(h):
            return h
        k = min(SHINGLE_WORDS, len(h))
        n = len(h) - k + 1
        total = np.full(n, k, np.uint64)
        for j in range(k):
            total += h[j : j + n] * self.place[j]
        return np.unique(mix(total))
