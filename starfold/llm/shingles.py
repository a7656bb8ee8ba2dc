"""Word shingle sets of texts and their MinHash values, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
# Distinct words whose hashes a process keeps.
KEPT_WORDS = 500_000


class WordHashes(dict):
    """Keyed 64-bit hash of each word's bytes, computed once: no known family of words collides."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=b"shingles").digest(), "little")
        return value


WORD_HASHES = WordHashes()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits over each other."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode().lower().split()


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, in order."""
    return np.array([WORD_HASHES[w] for w in words_of(text)], dtype=np.uint64)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the `size`-word shingles; a shorter text is one shingle."""
    words = word_hashes(text or "")
    n = min(size, len(words))
    if not n:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(len(words) - n + 1, n, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + words[k : k + len(out)]
    return np.unique(mix(out))


def shingle_set(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The exact shingle set."""
    words = words_of(text or "")
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[k:] for k in range(size)), strict=False))


class MinHash:
    """`n` minima of a hash set."""

    def __init__(self, n: int, seed: int = 20240229) -> None:
        rng = np.random.default_rng(seed)
        self.xor = rng.integers(0, 1 << 32, n, dtype=np.uint32)[:, None]
        self.mul = (rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1))[:, None]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        h = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.xor), 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(h), 2048):
            block = h[None, at : at + 2048] ^ self.xor
            block *= self.mul
            np.minimum(least, block.min(axis=1), out=least)
        return least
