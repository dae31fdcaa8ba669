"""Minimal perfect hashing of distinct 64-bit keys: levels of bits, a key in the first level where it is alone in its place.

The number of a key is the rank of its bit, so n keys have the numbers 0 to n - 1 and the structure some three bits a key. A
key that was not among them gets any number or -1; callers verify against the key stored under the number.
"""

from __future__ import annotations

import struct

import numpy as np

from tidemark.llm.common import mix

_STEP = 0x9E3779B97F4A7C15


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * _STEP % (1 << 64))
    return (mix(keys.astype(np.uint64) ^ seed) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, self.count = [], 0
        for bits in levels:
            before = np.cumsum(bits) - bits + self.count
            self.ranks.append(before)
            self.count += int(bits.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        """Of distinct keys."""
        levels: list[np.ndarray] = []
        while len(keys):
            at = _place(keys, len(levels), max(2, int(1.5 * len(keys))))
            alone = np.bincount(at, minlength=max(2, int(1.5 * len(keys)))) == 1
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            at = _place(keys[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> bytes:
        sizes = struct.pack(f"<q{len(self.levels)}q", len(self.levels), *map(len, self.levels))
        return sizes + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, raw: bytes) -> "PerfectHash":
        (n,) = struct.unpack_from("<q", raw)
        sizes, at, levels = struct.unpack_from(f"<{n}q", raw, 8), 8 + 8 * n, []
        for size in sizes:
            width = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)
