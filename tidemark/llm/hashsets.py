"""Sets of 64-bit hashes sent between chunks of documents and ranges of hashes.

A chunk sorts its distinct hashes and sends each range of them as one binary row, so a hash that is very common costs
one entry a chunk. The receiver of a range answers by the rank of an entry in what the chunk sent: the chunk
computes the same sorted array again and needs no hash back. Hashes in a row are differences of sorted values, split
into planes of equal bytes, which compress well.
"""

from __future__ import annotations

import numpy as np


def pack(values: np.ndarray) -> bytes:
    """Sorted non-negative integers as differences in byte planes."""
    values = values.astype(np.uint64)
    steps = np.diff(values, prepend=np.uint64(0))
    planes = steps.view(np.uint8).reshape(-1, 8)
    width = 8 if not len(steps) else max(1, (int(steps[1:].max(initial=0)).bit_length() + 7) // 8)
    head = (steps[0] if len(steps) else np.uint64(0)).tobytes()
    return bytes([width]) + head + np.ascontiguousarray(planes[1:, :width].T).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    n = (len(raw) - 9) // width
    steps = np.zeros((n + 1, 8), np.uint8)
    steps[0] = np.frombuffer(raw, np.uint8, 8, 1)
    steps[1:, :width] = np.frombuffer(raw, np.uint8, n * width, 9).reshape(width, n).T
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def ranges(values: np.ndarray, count: int) -> list[tuple[int, int, int]]:
    """(range, first, end) of sorted hashes for ``count`` equal ranges of all hashes; without empty ones."""
    if not len(values):
        return []
    width = (1 << 64) // count + 1
    inner = np.array([k * width for k in range(1, count)], np.uint64)
    edges = [0, *np.searchsorted(values, inner).tolist(), len(values)]
    return [(k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]


def runs(order: np.ndarray) -> np.ndarray:
    """Number of the run of equal values that each entry of a sorted array is in."""
    return np.cumsum(np.concatenate(([False], order[1:] != order[:-1]))) if len(order) else np.zeros(0, np.int64)
