"""Substring dedup: word windows that occur earlier in the corpus are removed, found by fixed-block anchors.

1. Index and probes. In every document the blocks of ``block`` words that start at multiples of ``block`` are the index, and
   the windows of ``block`` words at every place are the probes. Their hashes go to ranges of hashes; a probe hits if an
   index block elsewhere has its hash. A repeat of ``window`` >= 2 * block - 1 words holds a whole index block of
   its earlier copy, so no repeat is missed.
2. Extension. In a document the hits are extended to either side to all windows of ``window`` words that hold one, and each
   such window is compared by a 128-bit hash of its words over all documents: its first occurrence is the smallest
   (doc_id, place). Windows with an earlier occurrence are exact repeats; their union gives the maximal ones.
3. The words they cover are removed.

Documents are dealt into chunks by a hash of doc_id; the chunks' exchange is shared by the three steps. Between the
steps only hashes and ranks travel, each distinct hash once a chunk, so a passage in a third of all documents costs no task
more than one entry a chunk. Nothing is expanded into pairs.

Words are maximal runs of bytes other than ASCII white space. Defined cases: a null or empty text has no words;
rows of one doc_id follow each other in order of text, so of repeated rows the later ones repeat the first; a null doc_id comes
before all others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import CHUNK_BYTES, WORDS, WORDS2, Words, by_chunk, covered, pieces, sorted_rows, spans, tasks, text_bytes, texts, utf8
from tidemark.llm.hashsets import pack, ranges, runs, unpack

SENT = "range int, chunk int, kind int, data binary, more binary"
OUT = "doc_id long, n_words long, n_removed long, text string, removed array<struct<first:int,end:int>>"
#: Bytes of text for each range of hashes.
RANGE_BYTES = 8 << 20


class Chunk:
    """The sorted rows of a chunk, and the hashes of their words."""

    def __init__(self, table: pa.Table) -> None:
        self.rows = sorted_rows(table)
        self.doc_id, self.text = self.rows["doc_id"].combine_chunks(), self.rows["text"].combine_chunks()
        offsets, _ = utf8(self.text)
        hashes, seconds, counts = [], [], []
        for lo, hi in pieces(offsets):
            words = Words(*utf8(self.text.slice(lo, hi - lo)))
            hashes.append(words.hash)
            seconds.append(words.second)
            counts.append(words.counts)
        self.hash = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.second = np.concatenate([np.zeros(0, np.uint64), *seconds])
        self.counts = np.concatenate([np.zeros(0, np.int64), *counts])
        self.bounds = np.concatenate(([0], np.cumsum(self.counts)))
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, n: int) -> np.ndarray:
        """Places where a window of n words of one document starts."""
        m = max(0, len(self.hash) - n + 1)
        return np.flatnonzero(self.doc[:m] == self.doc[len(self.hash) - m :]) if m else np.zeros(0, np.int64)

    def probes(self, block: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all probes, their hashes cut to ``bits``, and which of them are in the index."""
        at = self.windows(block)
        h = WORDS.windows(self.hash, block)[at] >> np.uint64(64 - bits) << np.uint64(64 - bits)
        return at, h, (at - self.bounds[self.doc[at]]) % block == 0

    def candidates(self, hit: np.ndarray, at: np.ndarray, block: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the windows that hold a probe that hit, and two hashes of each."""
        mark = np.zeros(len(self.hash) + 1, np.int64)
        mark[at[hit] + 1] = 1
        total = np.concatenate((np.cumsum(mark), np.full(window, mark.sum())))
        own = self.windows(window)
        own = own[total[own + window - block + 1] > total[own]]
        return own, WORDS.windows(self.hash, window)[own], WORDS2.windows(self.second, window)[own]


def first_of(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First entry of each distinct pair of hashes, in order of the hashes; and the distinct pair of each entry."""
    order = np.lexsort((g, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["range", "chunk", "kind", "data", "more"])


def ranks_of(notes: pa.Table, sent: list[tuple[int, int, int]], n: int, kind: int) -> np.ndarray:
    """Which of a chunk's sorted hashes an answer names."""
    first = {k: a for k, a, _ in sent}
    out = np.zeros(n, bool)
    for k, got, data in zip(notes["range"].to_pylist(), notes["kind"].to_pylist(), notes["data"].to_pylist()):
        if got == kind:
            out[first[k] + unpack(data).astype(np.int64)] = True
    return out


def dedup(
    docs: DataFrame, window: int = 20, block: int = 10, chunk_bytes: int = CHUNK_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words joined by one space), removed (spans of words) of every row."""
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block wherever it starts")
    rows = texts(docs, id_col, text_col)
    total = text_bytes(rows)
    n = tasks(docs.sparkSession)
    count = max(n, math.ceil(total / RANGE_BYTES))
    # So many bits that few different probes meet: these would only add windows to compare.
    bits = min(64, max(24, 2 * max(1, total // 4).bit_length() - 6))
    chunks = by_chunk(rows, total, chunk_bytes)

    def send(table: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        _, h, index = chunk.probes(block, bits)
        own, counts = np.unique(h, return_counts=True)
        indexed = np.isin(own, h[index])
        out = []
        for k, a, b in ranges(own, count):
            flags = np.packbits(indexed[a:b]).tobytes() + np.packbits(counts[a:b] > 1).tobytes()
            out.append((k, table["chunk"][0].as_py(), 0, pack(own[a:b] >> np.uint64(64 - bits)), flags))
        return _rows(out)

    def meet(table: pa.Table) -> pa.Table:
        """Of the hashes of a range, those that hit, as ranks for each chunk."""
        parts = [unpack(x) for x in table["data"].to_pylist()]
        flags = [np.frombuffer(x, np.uint8) for x in table["more"].to_pylist()]
        sizes = np.array([len(p) for p in parts])
        own = np.concatenate(parts)
        indexed = np.concatenate([np.unpackbits(f[: len(f) // 2], count=k) for f, k in zip(flags, sizes)])
        many = np.concatenate([np.unpackbits(f[len(f) // 2 :], count=k) for f, k in zip(flags, sizes)])
        order = np.argsort(own, kind="stable")
        run = runs(own[order])
        total = np.bincount(run, 1 + many[order])
        hit = np.zeros(len(own), bool)
        hit[order] = ((total > 1) & (np.bincount(run, indexed[order]) > 0))[run]
        return answers(table, sizes, hit)

    def answers(table: pa.Table, sizes: np.ndarray, hit: np.ndarray) -> pa.Table:
        ends = np.cumsum(sizes)
        out = []
        for k, c, kind, a, b in zip(table["range"].to_pylist(), table["chunk"].to_pylist(), table["kind"].to_pylist(), ends - sizes, ends):
            ranks = np.flatnonzero(hit[a:b])
            if len(ranks):
                out.append((k, c, kind, pack(ranks), b""))
        return _rows(out)

    def extend(table: pa.Table, notes: pa.Table) -> pa.Table:
        """The windows of a chunk that hold a hit, each distinct one with its first document; and which these are."""
        if not len(table) or not len(notes):
            return _rows([])
        chunk, name = Chunk(table), table["chunk"][0].as_py()
        at, h, _ = chunk.probes(block, bits)
        own = np.unique(h)
        hits = own[ranks_of(notes, ranges(own, count), len(own), 0)]
        starts, a, b = chunk.candidates(np.isin(h, hits), at, block, window)
        first, _ = first_of(a, b)
        doc = chunk.doc_id.take(pa.array(chunk.doc[starts[first]]))
        null = doc.is_null().to_numpy(zero_copy_only=False)
        doc = np.frombuffer(doc.fill_null(0).to_numpy().astype("<i8"), "<i8")
        out = [(k, name, 1, pack(a[first][x:y]), b[first][x:y].tobytes() + doc[x:y].tobytes() + null[x:y].tobytes()) for k, x, y in ranges(a[first], count)]
        mask = np.zeros(len(chunk.hash), bool)
        mask[starts] = True
        # the windows themselves go along to the next step, in a row that the receiver passes on
        return _rows([*out, (name % count, name, 2, np.packbits(mask).tobytes(), b"")])

    def earliest(table: pa.Table) -> pa.Table:
        """Of the windows of a range, those that occur first in another chunk, as ranks for each chunk."""
        passed = table.filter(pc.equal(table["kind"], 2))
        table = table.filter(pc.equal(table["kind"], 1))
        if not len(table):
            return passed
        parts = [unpack(x) for x in table["data"].to_pylist()]
        sizes = np.array([len(p) for p in parts])
        more = table["more"].to_pylist()
        a = np.concatenate(parts)
        b = np.concatenate([np.frombuffer(m, np.uint64, k) for m, k in zip(more, sizes)])
        doc = np.concatenate([np.frombuffer(m, "<i8", k, 8 * k) for m, k in zip(more, sizes)])
        known = 1 - np.concatenate([np.frombuffer(m, np.uint8, k, 16 * k) for m, k in zip(more, sizes)])
        order = np.lexsort((doc, known, b, a))
        x, y = a[order], b[order]
        new = np.ones(len(order), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        # documents of one doc_id are in one chunk, so all entries but the first have an earlier occurrence elsewhere
        later = np.zeros(len(order), bool)
        later[order] = ~new
        return pa.concat_tables([answers(table, sizes, later), passed])

    def remove(table: pa.Table, notes: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        gone = np.zeros(len(chunk.hash), bool)
        masks = notes.filter(pc.equal(notes["kind"], 2)) if len(notes) else notes
        if len(masks):
            raw = np.frombuffer(masks["data"][0].as_py(), np.uint8)
            starts = np.flatnonzero(np.unpackbits(raw, count=len(chunk.hash)))
            a, b = WORDS.windows(chunk.hash, window)[starts], WORDS2.windows(chunk.second, window)[starts]
            first, which = first_of(a, b)
            elsewhere = ranks_of(notes, ranges(a[first], count), len(first), 1)
            again = np.ones(len(starts), bool)
            again[first] = elsewhere
            again |= elsewhere[which]
            gone = covered(starts[again], window, len(chunk.hash))
        kept, removed, numbers = [], [], []
        for text, lo, hi in zip(chunk.text.to_pylist(), chunk.bounds, chunk.bounds[1:]):
            words, own = text.encode().split(), gone[lo:hi]
            s, e = spans(own) if own.any() else ((), ())
            removed.append([{"first": int(i), "end": int(j)} for i, j in zip(s, e)])
            if len(s):
                words = [w for w, g in zip(words, own.tolist()) if not g]
            numbers.append(int(own.sum()))
            kept.append(b" ".join(words).decode())
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        columns = [chunk.doc_id, pa.array(chunk.counts, pa.int64()), pa.array(numbers, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, span)]
        return pa.table(columns, ["doc_id", "n_words", "n_removed", "text", "removed"])

    sent = chunks.groupBy("chunk").applyInArrow(send, SENT)
    hits = sent.groupBy("range").applyInArrow(meet, SENT)
    both = chunks.groupBy("chunk").cogroup(hits.groupBy("chunk"))
    found = both.applyInArrow(extend, SENT)
    firsts = found.groupBy("range").applyInArrow(earliest, SENT)
    final = chunks.groupBy("chunk").cogroup(firsts.groupBy("chunk"))
    return final.applyInArrow(remove, OUT)


def op1_substring_dedup(spark, sf: str) -> DataFrame:
    """Words of every document that lie in a window of 20 words seen earlier are removed."""
    out = dedup(spark.read.parquet(f"{sf}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
