"""Packing: documents into sequences of near-equal length, by multiway differencing.

A document's ids, with its end id, are cut where a sequence is full: whole sequences stand alone, and what is left
is cut into pieces of at most ``piece`` ids. The pieces are dealt by a hash of the document into groups of about
``group_tokens`` ids. In a group, Karmarkar-Karp differencing with k ways starts from one partial partition a
piece and keeps merging the two partitions with the widest spread, the fullest window of one with the emptiest of the
other, until one is left. k starts at the least number of windows that can hold the group, and rises by
one whenever a window exceeds its capacity. Groups are independent and bounded, so the
work is spread over tasks however the documents are distributed; only lengths are shuffled, not ids.

Defined cases: a null or empty text is its end id alone; repeated rows of a doc_id are documents of their own; a null doc_id
is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, saved, texts, utf8
from tidemark.llm.tokens import default_tokenizer, encoder, with_end

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, salt long"
SHAPE = PIECES.replace("salt long", "sequence_id long, offset long")


def differencing(sizes: list[int], ways: int) -> list[int]:
    """The window of each size, by Karmarkar-Karp differencing into ``ways`` windows."""
    n = len(sizes)
    # A partition: rising sums; and for each slot the parts that made it: [left node, its slots, right node, its slots].
    made: list[tuple | int] = list(range(n))
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(ways, np.int64)
        sums[-1] = size
        heap.append((-size, i, sums))
    heapq.heapify(heap)
    natural = np.arange(ways)
    while len(heap) > 1:
        _, a, first = heapq.heappop(heap)
        _, b, second = heapq.heappop(heap)
        sums = first + second[::-1]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        made.append((a, natural[order], b, natural[::-1][order]))
        sums -= sums[0]
        heapq.heappush(heap, (-int(sums[-1]), len(made) - 1, sums))
    out = [0] * n
    stack = [(heap[0][1], natural)] if heap else []
    while stack:
        node, to = stack.pop()  # to: the final window of each slot of the node
        entry = made[node]
        if isinstance(entry, int):
            out[entry] = int(to[-1])
            continue
        a, slots_a, b, slots_b = entry
        for child, slots in ((a, slots_a), (b, slots_b)):
            below = np.empty(ways, np.int64)
            below[slots] = to
            stack.append((child, below))
    return out


def windows(sizes: list[int], capacity: int) -> list[int]:
    """The window of each size; as few windows as differencing manages."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        to = differencing(sizes, ways)
        if np.bincount(to, weights=sizes, minlength=ways).max(initial=0) <= capacity:
            return to
        ways += 1


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024, piece: int = 128,
    group_tokens: int = 192 * 1024, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per piece: its place in the document, its checksum, its sequence, and its place there."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            doc_ids, salts, offsets = batch["doc_id"].to_pylist(), batch["salt"].to_pylist(), utf8(batch["text"])[0]
            for lo, hi in pieces(offsets):
                got, ends = with_end(*encode.encode_all(batch["text"].slice(lo, hi - lo)), end_id)
                rows = []
                for doc_id, salt, ids in zip(doc_ids[lo:hi], salts[lo:hi], np.split(got.astype("<u4"), ends[:-1])):
                    full = len(ids) // capacity * capacity
                    edges = [*range(0, full, capacity), *range(full, len(ids), piece), len(ids)]
                    own = memoryview(ids)
                    rows += [(doc_id, a, b - a, zlib.crc32(own[a:b]), len(ids), salt) for a, b in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(6)], NAMES)

    spark = docs.sparkSession
    salted = texts(docs, id_col, text_col).withColumn("salt", F.xxhash64("doc_id", "text", F.monotonically_increasing_id()))
    cuts = saved(salted.mapInArrow(cut, PIECES), "pack-pieces")
    whole = F.col("length") == capacity
    total = cuts.filter(~whole).agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(total / group_tokens))

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        sizes = table["length"].to_numpy()
        to = np.array(windows(sizes.tolist(), capacity), np.int64)
        order = np.lexsort((-sizes, to))
        ends = np.cumsum(sizes[order])
        before = ends - sizes[order]
        first = np.concatenate(([True], to[order][1:] != to[order][:-1]))
        offset = np.empty(len(to), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        group = table["group"][0].as_py()
        # windows have odd sequence ids, whole sequences even ones
        columns = [table[c] for c in NAMES[:5]] + [pa.array((group << 24 | to) * 2 + 1), pa.array(offset)]
        return pa.table(columns, [*NAMES[:5], "sequence_id", "offset"])

    parts = cuts.filter(~whole).withColumn("group", F.pmod("salt", F.lit(groups)).cast("long"))
    shared = parts.groupBy("group").applyInArrow(place, SHAPE)
    alone = cuts.filter(whole).select(
        *NAMES[:5], (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return shared.unionByName(alone)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"]


def op6_packing(spark, sf: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids."""
    return pack(spark.read.parquet(f"{sf}/documents.parquet"), default_tokenizer())
