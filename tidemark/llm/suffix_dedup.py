"""Suffix-array dedup: byte strings of ``width`` that occur twice anywhere are removed, every occurrence of them.

1. Every string of ``width`` bytes has an anchor, the substring of ``gram`` bytes in it with the least hash; equal strings
   have equal anchors at equal places. Hashes of anchors are counted over all documents; strings whose anchor occurs once
   do not repeat, and are left out of the sort without loss.
2. Neighbouring strings with one anchor are a passage. The distinct passages of each chunk of documents go to shards by the
   hash of their anchor, so strings that are equal meet in one shard.
3. A shard sorts all suffixes of its distinct passages by external induction, which carries suffix tuples and
   common-prefix values through recursive induction, in queues that go to the shared folder beyond
   ``memory`` bytes (module ``suffix_sort``). A string repeats if the common prefix with a neighbour is ``width`` or
   longer, or if its passage came twice.
4. The answers, one bit for each string, return to the chunks, where the covered bytes are removed.

Chunks are dealt by a hash of doc_id and their exchange is shared by the steps. A hash or passage travels once a chunk,
however often it occurs there, and no pairs are made. So a passage in very many documents costs its shard one entry a
chunk; larger chunks (``chunk_bytes``) make fewer of them.

Texts are UTF-8 bytes; strings never cross documents, and may overlap. Defined cases: a null text is empty; texts shorter than
``width`` stay as they are; repeated rows are documents of their own, so both are removed; a null doc_id is kept; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import BYTES, CHUNK_BYTES, by_chunk, covered, sorted_rows, spans, tasks, text_bytes, texts, utf8
from tidemark.llm.hashsets import pack, ranges, runs, unpack
from tidemark.llm.simhash import signed
from tidemark.llm.suffix_sort import repeated_prefixes
from tidemark.session import work_dir

SENT = "part int, chunk int, data binary, more binary"
OUT = "doc_id long, text_hash long, n_bytes long, n_removed long, n_spans long, kept binary, removed array<struct<first:int,end:int>>"
WIDTH, GRAM = 200, 64
BLOCK = 1 << 20


def sliding_least(values: np.ndarray, w: int) -> np.ndarray:
    """min(values[i:i + w]) for every i."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    most = np.iinfo(values.dtype).max
    padded = np.full(-(-len(values) // w) * w, most, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchors(offsets: np.ndarray, data: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts of strings in one document with the same anchor: first start, last start, hash of the anchor."""
    lo, end = int(offsets[0]), int(offsets[-1])
    out = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)]
    kept = [out]
    inside = np.zeros(end - lo + 1, np.int8)
    has = np.diff(offsets) >= width
    np.add.at(inside, offsets[:-1][has] - lo, 1)
    np.add.at(inside, offsets[1:][has] - lo - width + 1, -1)
    valid = np.cumsum(inside[:-1], dtype=np.int8) > 0
    for b in range(lo, end, BLOCK):
        part = data[b : min(end, b + BLOCK + width - 1)]
        if len(part) < width:
            break
        h = BYTES.windows(part.astype(np.uint64), gram)
        at = np.arange(len(h), dtype=np.uint64)
        # the high bits order the anchors, the low ones are the place: of equal ones the first counts
        low = np.uint64((1 << 21) - 1)
        least = sliding_least((h & ~low) | at, width - gram + 1)[:BLOCK]
        starts = np.flatnonzero(valid[b - lo : b - lo + len(least)])
        if not len(starts):
            continue
        place = (least[starts] & low).astype(np.int64)
        new = np.concatenate(([True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        kept.append((starts[first] + b, starts[last] + b, h[place[first]]))
    return tuple(np.concatenate([k[i] for k in kept]) for i in range(3))


class Chunk:
    """The sorted rows of a chunk and the runs of strings with one anchor."""

    def __init__(self, table: pa.Table, width: int, gram: int) -> None:
        rows = sorted_rows(table)
        self.doc_id = rows["doc_id"].combine_chunks()
        self.offsets, self.data = utf8(rows["text"])
        self.first, self.last, self.hash = anchors(self.offsets, self.data, width, gram)
        self.known, counts = np.unique(self.hash, return_counts=True)
        self.many = counts > 1

    def passages(self, hit: np.ndarray, width: int, shards: int):
        """Runs whose anchor is in ``hit`` (a mask of known hashes): their number, and the distinct passages by shard as
        (bytes, runs that have it)."""
        own = np.flatnonzero(hit[np.searchsorted(self.known, self.hash)]) if len(self.hash) else np.zeros(0, np.int64)
        raw = self.data.tobytes()
        shard = (self.hash[own] % np.uint64(shards)).astype(np.int64)
        found: dict[int, dict[bytes, list[int]]] = {}
        for run, s, a, b in zip(own.tolist(), shard.tolist(), self.first[own].tolist(), self.last[own].tolist()):
            found.setdefault(s, {}).setdefault(raw[a : b + width], []).append(run)
        return found


def _rows(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["part", "chunk", "data", "more"])


def repeated(passages: list[bytes], many: list[bool], width: int, memory: int, folder: str | None) -> list[np.ndarray]:
    """For each distinct passage, at which of its starts a string begins that occurs elsewhere too."""
    sizes = np.array([len(p) for p in passages])
    # a separator, 0, ends each passage; bytes follow in order
    raw = np.frombuffer(b"\0".join(passages) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    code = np.cumsum(np.bincount(raw, minlength=256) > 0)
    text = code[raw].astype(np.uint8 if code[-1] < 256 else np.uint16)
    text[ends] = 0
    found = repeated_prefixes(text, width, memory, folder)
    out = []
    for end, size, more in zip(ends.tolist(), sizes.tolist(), many):
        n = size - width + 1
        out.append(np.ones(n, bool) if more else found[end - size : end - size + n])
    return out


def suffix_dedup(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, memory: int = 64 << 20,
    whole_characters: bool = False, chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), n_bytes, n_removed, n_spans, kept (bytes), removed (byte spans) of every row.

    ``whole_characters`` also removes the rest of a character of which a byte is removed, so what is kept is UTF-8."""
    rows = texts(docs, id_col, text_col)
    total = text_bytes(rows)
    n = tasks(docs.sparkSession)
    shards, count = max(n, math.ceil(total / (4 << 20))), max(n, math.ceil(total / (64 << 20)))
    chunks = by_chunk(rows, total, chunk_bytes)
    scratch = work_dir(docs.sparkSession, "suffix-queues")

    def send(table: pa.Table) -> pa.Table:
        chunk, name = Chunk(table, width, gram), table["chunk"][0].as_py()
        own = chunk.known
        return _rows([(k, name, pack(own[a:b]), np.packbits(chunk.many[a:b]).tobytes()) for k, a, b in ranges(own, count)])

    def meet(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table["data"].to_pylist()]
        sizes = np.array([len(p) for p in parts])
        own = np.concatenate(parts)
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=k) for x, k in zip(table["more"].to_pylist(), sizes)])
        order = np.argsort(own, kind="stable")
        run = runs(own[order])
        hit = np.zeros(len(own), bool)
        hit[order] = (np.bincount(run, 1 + many[order]) > 1)[run]
        ends, out = np.cumsum(sizes), []
        for k, c, a, b in zip(table["part"].to_pylist(), table["chunk"].to_pylist(), ends - sizes, ends):
            ranks = np.flatnonzero(hit[a:b])
            if len(ranks):
                out.append((k, c, pack(ranks), b""))
        return _rows(out)

    def hits(chunk: Chunk, notes: pa.Table) -> np.ndarray:
        first = {k: a for k, a, _ in ranges(chunk.known, count)}
        out = np.zeros(len(chunk.known), bool)
        for k, data in zip(notes["part"].to_pylist(), notes["data"].to_pylist()):
            out[first[k] + unpack(data).astype(np.int64)] = True
        return out

    def gather(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not len(table) or not len(notes):
            return _rows([])
        chunk, name = Chunk(table, width, gram), table["chunk"][0].as_py()
        hit = hits(chunk, notes)
        out = []
        for s, passages in chunk.passages(hit, width, shards).items():
            sizes = np.array([len(p) for p in passages], "<u4").tobytes()
            out.append((s, name, b"".join(passages), sizes + bytes(len(r) > 1 for r in passages.values())))
        # which anchors hit goes along to the last step, in a row that the shard passes on
        return _rows([*out, (name % shards, name, np.packbits(hit).tobytes(), None)])

    def sort(table: pa.Table) -> pa.Table:
        passed = table.filter(pc.is_null(table["more"]))
        table = table.filter(pc.is_valid(table["more"]))
        distinct: dict[bytes, int] = {}
        many: list[bool] = []
        held = []
        for data, more in zip(table["data"].to_pylist(), table["more"].to_pylist()):
            k = len(more) // 5
            ends = np.cumsum(np.frombuffer(more, "<u4", k)).tolist()
            own = []
            for a, b, twice in zip([0, *ends], ends, more[4 * k :]):
                at = distinct.setdefault(data[a:b], len(many))
                if at == len(many):
                    many.append(bool(twice))
                else:
                    many[at] = True
                own.append(at)
            held.append(own)
        if not many:
            return passed
        found = repeated(list(distinct), many, width, memory, scratch)
        out = [
            (s, c, np.packbits(np.concatenate([found[i] for i in own])).tobytes(), b"")
            for s, c, own in zip(table["part"].to_pylist(), table["chunk"].to_pylist(), held)
        ]
        return pa.concat_tables([_rows(out), passed])

    def remove(table: pa.Table, notes: pa.Table) -> pa.Table:
        chunk = Chunk(table, width, gram)
        lo, end = int(chunk.offsets[0]), int(chunk.offsets[-1])
        starts = []
        own = notes.filter(pc.is_null(notes["more"])) if len(notes) else notes
        if len(own):
            hit = np.unpackbits(np.frombuffer(own["data"][0].as_py(), np.uint8), count=len(chunk.known)).astype(bool)
            found = chunk.passages(hit, width, shards)
            answers = {s: x for s, x, m in zip(notes["part"].to_pylist(), notes["data"].to_pylist(), notes["more"].to_pylist()) if m is not None}
            for s, passages in found.items():
                counts = [len(p) - width + 1 for p in passages]
                bits = np.flatnonzero(np.unpackbits(np.frombuffer(answers[s], np.uint8), count=sum(counts)))
                if not len(bits):
                    continue
                edges = np.cumsum([0, *counts])
                which = np.searchsorted(edges, bits, "right") - 1
                cuts = np.flatnonzero(np.diff(which)) + 1
                owners = list(passages.values())
                for piece, p in zip(np.split(bits - edges[which], cuts), which[np.concatenate(([0], cuts))].tolist()):
                    starts += [chunk.first[r] - lo + piece for r in owners[p]]
        gone = covered(np.concatenate(starts), width, end - lo) if starts else np.zeros(end - lo, bool)
        if whole_characters and gone.any():
            lead = (chunk.data[lo:end] & 0xC0) != 0x80
            first = np.maximum.accumulate(np.where(lead, np.arange(end - lo), 0))
            cut = np.zeros(end - lo, bool)
            cut[first[gone]] = True
            gone = cut[first]
        raw = chunk.data.tobytes()
        hashes, sizes, numbers, counts, kept, removed = [], [], [], [], [], []
        for a, b in zip(chunk.offsets.tolist(), chunk.offsets[1:].tolist()):
            own = gone[a - lo : b - lo]
            s, e = spans(own) if own.any() else (np.zeros(0, np.int64),) * 2
            hashes.append(signed(xxh64_intdigest(raw[a:b], 42)))
            sizes.append(b - a)
            numbers.append(int((e - s).sum()))
            counts.append(len(s))
            edges = [0, *np.stack([s, e], 1).ravel().tolist(), b - a]
            kept.append(b"".join(raw[a + x : a + y] for x, y in zip(edges[::2], edges[1::2])))
            removed.append([{"first": int(x), "end": int(y)} for x, y in zip(s, e)])
        span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        columns = [chunk.doc_id, *(pa.array(x, pa.int64()) for x in (hashes, sizes, numbers, counts)), pa.array(kept, pa.binary()), pa.array(removed, span)]
        return pa.table(columns, ["doc_id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept", "removed"])

    sent = chunks.groupBy("chunk").applyInArrow(send, SENT)
    met = sent.groupBy("part").applyInArrow(meet, SENT)
    passages = chunks.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(gather, SENT)
    answers = passages.groupBy("part").applyInArrow(sort, SENT)
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(remove, OUT)


def op5_suffix_dedup(spark, sf: str) -> DataFrame:
    """Bytes of every document that lie in a string of 200 bytes that starts anywhere else are removed."""
    out = suffix_dedup(spark.read.parquet(f"{sf}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
