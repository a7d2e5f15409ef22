"""Word shingles as 64-bit numbers, and one-permutation signatures of their sets."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

from freshet.llm.common import LOWER_BYTES

WORDS = 5
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingles of five words; of fewer words the whole sequence; none without words."""
    words = (text or "").encode().translate(LOWER_BYTES).split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < WORDS:
        return mix((h * _MULTIPLIERS[: len(h)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(h))) if len(h) else h
    n = len(h) - WORDS + 1
    total = h[:n] * _MULTIPLIERS[0]
    for k in range(1, WORDS):
        total += h[k : n + k] * _MULTIPLIERS[k]
    return np.unique(mix(total))


def set_id(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class OnePermutation:
    """One-permutation hashing: the numbers' range is cut into bins and each bin's least number is kept.

    Optimal densification fills an empty bin from the first non-empty one in a fixed random sequence of its own, so that two sets
    agree in any bin with the probability of their resemblance, and independently enough between bins.
    """

    def __init__(self, bands: int, rows: int, seed: int = 11, probes: int = 512):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        step = (1 << 64) // self.bins
        self.bounds = np.array([i * step for i in range(self.bins)], np.uint64)
        rng = np.random.default_rng(seed)
        self.probe = rng.integers(0, self.bins, (self.bins, probes))
        self.factors = rng.integers(0, 1 << 63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.salt = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        start = np.searchsorted(shingles, self.bounds)
        full = start < np.append(start[1:], len(shingles))
        source = np.arange(self.bins)
        if not full.all():
            empty, at = np.flatnonzero(~full), 0
            while len(empty) and at < self.probe.shape[1]:  # a few probes fill most bins
                tried = self.probe[empty, at : at + 8]
                hits = full[tried]
                found = hits.any(axis=1)
                source[empty[found]] = tried[found, hits[found].argmax(axis=1)]
                empty, at = empty[~found], at + 8
            for i in empty:  # no probe hit: the next non-empty bin
                source[i] = np.flatnonzero(full)[np.searchsorted(np.flatnonzero(full), i) % full.sum()]
        return shingles[start[source]]

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band."""
        rows = mix(self.signature(shingles)).reshape(self.bands, self.rows)
        return mix((rows * self.factors).sum(axis=1, dtype=np.uint64) + self.salt)
