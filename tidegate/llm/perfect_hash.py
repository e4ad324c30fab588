"""Minimal perfect hashing of distinct 64-bit keys.

Every key is hashed into a table of two places a key; keys that have a place for themselves
keep it, the others go on to the next, smaller table. The number of a key is the rank of its
place among all places kept. A key that isn't of the set may get any number, or -1, so
whoever looks up keys compares them with the stored ones.
"""

from __future__ import annotations

import numpy as np

from .words import mix

_LEVEL = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys.view(np.uint64) ^ (_LEVEL * np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """``of`` numbers the keys it was built from 0, 1, .. without gaps."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self._bits = sizes, bits
        self._ranks = np.cumsum(bits, dtype=np.int64) - 1

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct int64 values."""
        sizes, bits, left = [], [], keys
        while len(left):
            size = 2 * len(left) + 1
            at = _places(left, len(sizes), size)
            taken = np.bincount(at, minlength=size)
            sizes.append(size)
            bits.append(taken == 1)
            left = left[taken[at] > 1]
        return cls(np.array(sizes, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def of(self, keys: np.ndarray) -> np.ndarray:
        out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _places(keys[left], level, size) + base
            kept = self._bits[at]
            out[left[kept]] = self._ranks[at[kept]]
            left, base = left[~kept], base + size
        return out

    def to_bytes(self) -> tuple[bytes, bytes]:
        return self.sizes.tobytes(), np.packbits(self._bits).tobytes()

    @classmethod
    def from_bytes(cls, sizes: bytes, bits: bytes) -> PerfectHash:
        lengths = np.frombuffer(sizes, np.int64)
        return cls(lengths, np.unpackbits(np.frombuffer(bits, np.uint8), count=int(lengths.sum())).astype(bool))
