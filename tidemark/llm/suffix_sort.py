"""Suffix sorting by external induction, with the common prefixes of neighbours.

The suffixes of a text are sorted by their first symbols from those of its leftmost S-type positions (LMS): scanning the
sorted suffixes in order, each gives the place of the suffix one to its left. The queue between is a priority queue:
its priority is the first symbol, and in a symbol it is first in, first out. It carries tuples (position, common
prefix with the entry before) in arrays, and writes arrays to disk when it holds more than its limit, so memory is needed for
the text and one bucket only. The common prefix of two induced suffixes is one more than the least among those that were
scanned between their sources; that minimum is carried along per symbol.

The LMS suffixes are sorted by recursion: their substrings are sorted by the same induction and named by rank; names of
equal substrings are told apart by the names that follow, doubling the distance. Prefixes matter up to ``cap`` symbols only.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow.fs as pafs


class DiskQueue:
    """Arrays of (position, common prefix) by symbol. Over ``limit`` bytes, the fullest symbols go to files of ``folder``."""

    def __init__(self, limit: int = 256 << 20, folder: str | None = None) -> None:
        self.limit, self.folder, self.held = limit, folder, 0
        self.parts: dict[int, list] = defaultdict(list)
        self.sizes: dict[int, int] = defaultdict(int)
        self.files = 0

    def _fs(self) -> tuple[pafs.FileSystem, str]:
        where = self.folder
        return pafs.FileSystem.from_uri(where) if ":" in where else (pafs.LocalFileSystem(), where)

    def push(self, symbol: int, positions: np.ndarray, common: np.ndarray) -> None:
        self.parts[symbol].append((positions, common))
        size = positions.nbytes + common.nbytes
        self.sizes[symbol] += size
        self.held += size
        while self.held > self.limit and self.folder is not None and any(self.sizes.values()):
            self._spill(max(self.sizes, key=self.sizes.__getitem__))

    def _spill(self, symbol: int) -> None:
        """One more file with all arrays of a symbol that are in memory; those come after its earlier files."""
        fs, root = self._fs()
        fs.create_dir(root)
        files = [p for p in self.parts[symbol] if isinstance(p[0], str)]
        arrays = [p for p in self.parts[symbol] if not isinstance(p[0], str)]
        name = f"{root}/{uuid.uuid4().hex}.part"
        with fs.open_output_stream(name) as f:
            f.write(np.concatenate([p for p, _ in arrays]).astype("<i8").tobytes())
            f.write(np.concatenate([c for _, c in arrays]).astype("<u2").tobytes())
        self.files += 1
        self.parts[symbol] = [*files, (name, sum(len(p) for p, _ in arrays))]
        self.held -= self.sizes[symbol]
        self.sizes[symbol] = 0

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a symbol, in the order they came."""
        out = []
        for part in self.parts.pop(symbol, []):
            if isinstance(part[0], str):
                fs, _ = self._fs()
                name, n = part
                with fs.open_input_file(name) as f:
                    raw = f.read()
                fs.delete_file(name)
                part = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u2", n, 8 * n)
            out.append(part)
        self.held -= self.sizes.pop(symbol, 0)
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint16)
        if len(out) == 1:
            return out[0]
        return np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out])


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first:last + 1]) for many ranges."""
    level = np.zeros(len(first), np.int64)
    width = last - first + 1
    level = np.frexp(width.astype(float))[1] - 1
    out = np.empty(len(first), values.dtype)
    table, k = values, 0
    top = int(level.max(initial=0))
    while True:
        own = np.flatnonzero(level == k)
        if len(own):
            out[own] = np.minimum(table[first[own]], table[last[own] - (1 << k) + 1])
        if k == top:
            return out
        table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
        k += 1


class Induction:
    """One scan over the sorted suffixes, from the smallest (L types) or the largest (S types)."""

    def __init__(self, text: np.ndarray, rising: bool, cap: int, queue: DiskQueue, common: bool) -> None:
        self.text, self.rising, self.cap, self.queue, self.common = text, rising, cap, queue, common
        self.carry = np.full(int(text.max(initial=0)) + 1, cap, np.uint16)

    def step(self, symbol: int, at: np.ndarray, common: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Scans suffixes that start with ``symbol``: queues the suffixes left of them that are of the wanted type, and
        returns those among them that start with the same symbol (if ``same``), which come next."""
        left = at - 1
        before = self.text.take(np.maximum(left, 0))
        ok = left >= 0
        if self.rising:
            ok &= before >= symbol if same else before > symbol
        else:
            ok &= before <= symbol if same else before < symbol
        picked = np.flatnonzero(ok)
        symbols = before.take(picked)
        order = np.argsort(symbols, kind="stable")
        picked, symbols = picked.take(order), symbols.take(order)
        edges = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1]))) if len(picked) else np.zeros(0, np.int64)
        heads = symbols[edges].astype(np.int64)
        if self.common and len(common):
            start = np.empty(len(picked), np.int64)
            start[1:] = picked[:-1] + 1
            start[edges] = 0
            least = range_minima(common, start, picked)
            least[edges] = np.minimum(least[edges], self.carry[heads])
            value = np.minimum(least + 1, self.cap).astype(np.uint16)
            # what is scanned after the last pick of a symbol counts for its next one
            tail = np.minimum.accumulate(common[::-1])[::-1]
            self.carry = np.minimum(self.carry, tail[0])
            lasts = picked[np.append(edges[1:], len(picked)) - 1] if len(edges) else edges
            self.carry[heads] = np.where(lasts + 1 < len(common), tail[np.minimum(lasts + 1, len(common) - 1)], self.cap)
        else:
            value = np.zeros(len(picked), np.uint16)
        own = left.take(picked), value
        here = np.zeros(0, np.int64), np.zeros(0, np.uint16)
        for head, a, b in zip(heads.tolist(), edges.tolist(), [*edges[1:].tolist(), len(picked)]):
            if head == symbol:
                here = own[0][a:b], own[1][a:b]
            else:
                self.queue.push(head, own[0][a:b], own[1][a:b])
        return here


def words_at(text: np.ndarray) -> tuple[np.ndarray, int]:
    """For every place the next symbols packed into 64 bits, the first one lowest, and how many they are."""
    bits = 8 * text.itemsize
    out = text.astype(np.uint64)
    for k in range(6 - bits.bit_length() + 1):  # 1, 2, 4 symbols become twice as many
        ahead = 1 << k
        out[:-ahead] |= out[ahead:] << np.uint64(bits * ahead)
    return out, 64 // bits


def common_prefix(words: tuple[np.ndarray, int], a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Length of the common prefix of suffixes, up to ``cap``. ``words`` are those of a text with ``cap`` more symbols."""
    packed, each = words
    out = np.full(len(a), cap, np.uint16)
    active, x, y, depth = np.arange(len(a)), a, b, 0
    while depth < cap and len(active):
        differ = packed.take(x + depth) ^ packed.take(y + depth)
        ends = np.flatnonzero(differ)
        if len(ends):
            own = differ.take(ends)
            lowest = np.bitwise_count((own & (~own + np.uint64(1))) - np.uint64(1)).astype(np.int64)
            out[active.take(ends)] = np.minimum(depth + lowest * each // 64, cap)
            more = np.flatnonzero(differ == 0)
            active, x, y = active.take(more), x.take(more), y.take(more)
        depth += each
    return out


class SuffixSorter:
    """Sorts the suffixes of a text over small integers whose last symbol is 0, the smallest."""

    def __init__(self, text: np.ndarray, cap: int, limit: int = 256 << 20, folder: str | None = None) -> None:
        self.n, self.cap, self.limit, self.folder = len(text), cap, limit, folder
        self.text = np.concatenate((text, np.zeros(cap + 8, text.dtype)))
        self.words = words_at(self.text)
        body = text.astype(np.int16) if text.dtype == np.uint8 else text.astype(np.int32)
        step = np.sign(np.diff(body, append=-1))  # after the end there is less than any symbol
        # equal neighbours have the type of the next change
        at = np.where(step != 0, np.arange(self.n), self.n - 1)
        self.small = step[np.minimum.accumulate(at[::-1])[::-1]] > 0
        self.lms = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1
        self.symbols = int(text.max(initial=0)) + 1
        self.spilled = 0

    def induce(self, lms: np.ndarray, lms_common: np.ndarray | None):
        """Yields (positions, common prefixes) of sorted suffixes by falling buckets, largest first, from sorted LMS ones."""
        carried = lms_common is not None
        common = lms_common if carried else np.zeros(len(lms), np.uint16)
        first = self.text[lms]
        edges = np.searchsorted(first, np.arange(self.symbols + 1))
        queue, kept = DiskQueue(self.limit, self.folder), DiskQueue(self.limit, self.folder)
        scan = Induction(self.text[: self.n], True, self.cap, queue, carried)
        if self.n:
            queue.push(int(self.text[self.n - 1]), np.array([self.n - 1]), np.zeros(1, np.uint16))
        for symbol in range(self.symbols):
            at, own = queue.pop(symbol)
            if len(own):
                own = own.copy()
                own[0] = 0
            last = None
            while len(at):
                kept.push(symbol, at, own)
                last = at[-1]
                at, own = scan.step(symbol, at, own, True)
            a, b = edges[symbol], edges[symbol + 1]
            if a < b:
                own = common[a:b].copy()
                own[0] = 0 if last is None or not carried else common_prefix(self.words, np.array([last]), lms[a : a + 1], self.cap)[0]
                scan.step(symbol, lms[a:b], own, False)
        self.spilled += queue.files
        queue = DiskQueue(self.limit, self.folder)
        scan = Induction(self.text[: self.n], False, self.cap, queue, carried)
        for symbol in range(self.symbols - 1, -1, -1):
            at, own = queue.pop(symbol)
            if len(own):
                own = own.copy()
                own[0] = 0
            last = None
            while len(at):
                yield at, own
                last = at[-1]
                at, own = scan.step(symbol, at, own, True)
            at, own = kept.pop(symbol)
            if len(at):
                down = np.empty(len(at), np.uint16)
                down[1:] = own[:0:-1]
                at = at[::-1]
                down[0] = 0 if last is None or not carried else common_prefix(self.words, np.array([last]), at[:1], self.cap)[0]
                yield at, down
                scan.step(symbol, at, down, False)
        self.spilled += queue.files + kept.files

    def sorted_lms(self) -> tuple[np.ndarray, np.ndarray]:
        """The LMS positions in order of their suffixes (up to ``cap`` symbols), and common prefixes."""
        lms = self.lms
        if len(lms) < 2:
            return lms, np.zeros(len(lms), np.uint16)
        is_lms = np.zeros(self.n + 1, bool)
        is_lms[lms] = True
        rough = lms[np.argsort(self.text[lms], kind="stable")]
        found = [at[is_lms[at]] for at, _ in self.induce(rough, None)]
        order = np.concatenate(found)[::-1]  # by substring
        end = np.empty(self.n + 1, np.int64)
        end[lms] = np.append(lms[1:], self.n)
        a, b = order[:-1], order[1:]
        length = end[order] - order + 1
        # Substrings of over ``cap`` symbols are told apart by that many.
        same = np.minimum(length[:-1], self.cap) == np.minimum(length[1:], self.cap)
        same[same] = common_prefix(self.words, a[same], b[same], self.cap) >= np.minimum(length[:-1], self.cap)[same]
        name = np.empty(self.n + 1, np.int64)
        name[order] = np.cumsum(np.concatenate(([0], ~same)))
        rank = name[lms]
        rank = self.double(rank)
        out = lms[np.argsort(rank)]
        common = np.zeros(len(out), np.uint16)
        common[1:] = common_prefix(self.words, out[:-1], out[1:], self.cap)
        return out, common

    def double(self, rank: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes of a string of names, told apart by twice as many names each time. A name stands for two
        symbols at least. Ranks are places in the order, so equal ones are re-ranked among themselves only."""
        n, ahead = len(rank), 1
        order = np.argsort(rank, kind="stable")
        own = rank.take(order)
        new = np.concatenate(([True], own[1:] != own[:-1]))
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int64)
        rank[order] = first
        alone = new & np.append(new[1:], True)
        active = order.take(np.flatnonzero(~alone))
        while len(active) and 2 * ahead < self.cap:
            at = rank.take(active)
            then = active + ahead
            following = np.where(then < n, rank.take(np.minimum(then, n - 1)) + 1, 0)
            key = at.astype(np.uint64) << np.uint64(32) | following.astype(np.uint64)
            order = np.argsort(key)
            key, active = key.take(order), active.take(order)
            new = np.concatenate(([True], key[1:] != key[:-1]))
            group = key >> np.uint64(32)
            begin = np.concatenate(([True], group[1:] != group[:-1]))
            k = np.arange(len(key))
            inside = np.maximum.accumulate(np.where(new, k, 0)) - np.maximum.accumulate(np.where(begin, k, 0))
            rank[active] = group.astype(np.int64) + inside
            alone = new & np.append(new[1:], True)
            active = active.take(np.flatnonzero(~alone))
            ahead *= 2
        return rank

    def neighbours(self):
        """Yields (positions, common prefixes with the entry before) of all suffixes, from the largest down."""
        yield from self.induce(*self.sorted_lms())


def repeated_prefixes(text: np.ndarray, cap: int, limit: int = 256 << 20, folder: str | None = None) -> np.ndarray:
    """At which positions ``cap`` symbols start that start elsewhere too."""
    out = np.zeros(len(text), bool)
    last = -1
    for at, common in SuffixSorter(text, cap, limit, folder).neighbours():
        long = common >= cap
        out[at[long]] = True
        before = np.flatnonzero(long) - 1
        out[at[before[before >= 0]]] = True
        if len(long) and long[0]:
            out[last] = True
        if len(at):
            last = at[-1]
    return out
