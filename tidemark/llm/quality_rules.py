"""Quality rules: how much of a text lies in repeated word n-grams and repeated lines.

Rolling hashes of word windows of several lengths, computed in numpy over whole Arrow batches of texts;
a window is repeated if its hash occurs twice in the same text (64-bit hashes of hashes of words, so two
different windows of one text meet with a chance of 2^-64 per pair). The characters of words in repeated
windows, and of lines that equal an earlier line, are measured against all characters of words. A first occurrence
is no repetition; only the base rule on words counts it.

Defined cases: a null or empty text has no words and fails the base rules; every row of the table gives
one row, repeated rows too; other columns are ignored; an empty table gives none. No shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import WORDS, Words, covered, mix, pieces, texts, utf8

#: Characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Largest share of the characters of a text in n-grams of each length that occurred before (as published for web texts).
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of characters in lines that repeat an earlier one.
LINE_COVERAGE = 0.20
#: Base rules: fewest words, and largest percentage of words in repeated windows of WINDOW words.
FEWEST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_chars long, "
    + ", ".join(f"dup_{n}gram_chars long" for n in COVERAGE)
)


def repeated(words: Words, n: int, first: bool) -> np.ndarray:
    """Which words lie in a window of n words that occurs twice or more in its text; with ``first`` also in the first of
    its places, else in later ones only."""
    ok = np.flatnonzero(words.inside(n))
    if not len(ok):
        return np.zeros(len(words), bool)
    of = words.text[ok].astype(np.uint64)
    key = mix(WORDS.windows(words.hash, n)[ok] ^ mix(of + np.uint64(1)))
    order = np.sort(key)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(twice):
        return np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    found = np.flatnonzero(twice[at] == key)
    if not first:
        order = np.argsort(key[found], kind="stable")  # by place within a key
        own = key[found[order]]
        found = found[order[1:][own[1:] == own[:-1]]]
    return covered(ok[found], n, len(words))


def repeated_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the characters of their words."""
    seen, lines, chars = set(), 0, 0
    for line in text.split("\n"):
        if line in seen:
            found = len("".join(ascii_words(line)))
            lines, chars = lines + (found > 0), chars + found
        else:
            seen.add(line)
    return lines, chars


def ascii_words(text: str) -> list[str]:
    return [w.decode() for w in text.encode().split()]


def measure(ids: pa.Array, text: pa.Array) -> pa.RecordBatch:
    offsets, data = utf8(text)
    words = Words(offsets, data)
    n = len(ids)
    first, last = offsets[0], offsets[-1]
    points = np.concatenate(([0], np.cumsum((data[first:last] & 0xC0) != 0x80)))
    chars = points[words.end - first] - points[words.start - first]
    symbols = np.concatenate(([0], np.cumsum(SYMBOLS[data[first:last]])))
    lines = np.array([repeated_lines(t) if t and "\n" in t else (0, 0) for t in text.to_pylist()], np.int64).reshape(n, 2)

    def per_text(weight: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(weight)))
        return total[words.bounds[1:]] - total[words.bounds[:-1]]

    word_chars, in_windows = per_text(chars), per_text(repeated(words, WINDOW, True))
    grams = {k: per_text(chars * repeated(words, k, False)) for k in COVERAGE}
    failed = (words.counts < FEWEST_WORDS) | (100 * in_windows > MOST_REPEATED * words.counts)
    over = lines[:, 1] > LINE_COVERAGE * word_chars
    for k, share in COVERAGE.items():
        over |= grams[k] > share * word_chars
    columns = [
        ids, words.counts, word_chars, symbols[offsets[1:] - first] - symbols[offsets[:-1] - first],
        lines[:, 0], in_windows, failed, ~failed & ~over, lines[:, 1], *grams.values(),
    ]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, _ = utf8(batch["text"])
            for lo, hi in pieces(offsets):
                yield measure(batch["doc_id"].slice(lo, hi - lo), batch["text"].slice(lo, hi - lo))

    return texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def op9_quality_rules(spark, sf: str) -> DataFrame:
    """Repetition counts and verdict of every document."""
    return repetition(spark.read.parquet(f"{sf}/documents.parquet"))
