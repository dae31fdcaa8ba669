"""Pre-tokens of byte-level tokenizers, cut in numpy over whole Arrow batches of texts.

The pattern of these tokenizers (``PATTERN``) has words of letters, of numbers and of other visible characters, each with a
space before it if there is one, English contractions, and white space; the last blank before a word stands alone or goes
with the word. Every character of a text is in exactly one match, so the matches of a batch are an Arrow binary array
over the bytes of the texts, with no copy, and equal matches are found by comparing bytes (``dictionary_encode``), never by a hash.

Which characters are letters, numbers or white space is asked of the tokenizer library itself, once per process, so the
cuts follow its character tables and not Python's.

Defined cases: a null or empty text has no match; a text of any length is cut in parts that end before a space between
two ASCII letters or digits, where a match always starts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken

from tidemark.llm.common import gathered, listed, numbered, slices, utf8

#: Fixed value: the pattern whose matches these are.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
__all__ = ["PATTERN", "gathered", "kinds", "listed", "matches", "numbered", "slices"]
BLANK, LETTER, NUMBER, OTHER = range(4)
SAFE = re.compile(rb"(?<=[0-9A-Za-z]) (?=[0-9A-Za-z])")
PART = 1 << 20


@cache
def kinds() -> np.ndarray:
    """The kind of every code point, as the library's patterns have it."""
    codes = np.array([*range(0xD800), *range(0xE000, 0x110000)], np.uint32)  # without surrogates, which UTF-8 has not
    every = codes.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((BLANK, r"\s"), (LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        one = tiktoken.Encoding("kind", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        found = bytes(one.encode_ordinary(every)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


def _starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """First byte of every match in texts that lie one after another; offsets and result count from the first byte."""
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(code)
    edge = np.zeros(n + 4, bool)
    edge[np.searchsorted(at, offsets)] = True
    edge[n:] = True
    kind = kinds()[code]
    first = np.ones(n + 4, bool)
    first[1:n] = kind[1:] != kind[:-1]
    first |= edge
    # a blank before a word: a space goes with it, any other stands alone
    after = np.flatnonzero(first[1:n] & ~edge[1:n] & (kind[:-1] == BLANK)) + 1
    first[after - 1] = True
    first[after] = code[after - 1] != 32
    # contractions: an apostrophe that starts a match, alone before letters
    mark = np.flatnonzero((code == 39) & first[:n])
    mark = mark[~edge[mark + 1]]
    mark = mark[kind[mark + 1] == LETTER]
    if len(mark):
        far = np.append(code, [0] * 4)
        one, two = far[mark + 1], np.where(edge[mark + 2], 0, far[mark + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(mark), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        hit = mark[short | long]
        first[hit + 1] = False
        first[mark[short] + 2] = True
        first[mark[long] + 3] = True
    return at[first[:n]]


def _parts(offsets: np.ndarray, data: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``limit`` bytes that end between texts or where it is safe to cut a long one."""
    lo, end = int(offsets[0]), int(offsets[-1])
    while lo < end:
        k = int(np.searchsorted(offsets, lo + limit, "right")) - 1
        hi = int(offsets[k])
        if hi <= lo:  # within one text
            stop = int(offsets[k + 1])
            found = SAFE.search(memoryview(data)[:stop], lo + limit) if lo + limit < stop else None
            hi = found.start() if found else stop
        yield lo, hi
        lo = hi


def matches(texts: pa.Array | pa.ChunkedArray, limit: int = PART) -> tuple[pa.Array, np.ndarray]:
    """(all matches of all texts, one after another; where those of each text end)."""
    offsets, data = utf8(texts)
    first, last = int(offsets[0]), int(offsets[-1])
    found = [
        _starts(np.clip(offsets[(offsets >= lo) & (offsets < hi)], lo, hi) - lo, data[lo:hi]) + (lo - first)
        for lo, hi in _parts(offsets, data, limit)
    ]
    starts = np.concatenate([*found, [last - first]]).astype(np.int64)
    return slices(starts, data[first:last]), np.searchsorted(starts[:-1], offsets[1:] - first)
