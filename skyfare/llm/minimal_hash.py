"""Minimal perfect hashing of 64-bit keys in numpy, level by level.

On each level the keys left are hashed to a bit array of ``GAMMA`` bits a key; a
key that is alone on its bit stays there, the others go to the next level.  The
index of a key is the number of set bits before its own, so n keys get the
numbers 0 .. n-1 with some 3 bits a key and no key stored.  An unknown key gets
any number: whoever stores the keys in index order can verify it."""

from __future__ import annotations

import numpy as np

GAMMA = 2.0
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + _A * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class MinimalHash:
    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.cumsum(sizes) - sizes
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.n = int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> MinimalHash:
        """``keys``: distinct, as unsigned 64-bit numbers."""
        left, sizes, bits = keys, [], []
        while len(left):
            size = -(-int(GAMMA * len(left)) // 64) * 64 + 64
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(np.array(sizes, dtype=np.int64),
                   np.concatenate(bits) if bits else np.zeros(0, dtype=np.uint64))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Number of every key; for a key outside the set any number below n, or 0."""
        out = np.zeros(len(keys), dtype=np.int64)
        left = np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts.tolist(), self.sizes.tolist())):
            if not len(left):
                break
            at = start + _place(keys[left], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below).astype(np.int64)
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        return np.concatenate([[len(self.sizes)], self.sizes]).astype(np.int64).tobytes() + self.words.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> MinimalHash:
        levels = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
        sizes = np.frombuffer(raw, dtype=np.int64, offset=8, count=levels)
        return cls(sizes, np.frombuffer(raw, dtype=np.uint64, offset=8 + 8 * levels))
