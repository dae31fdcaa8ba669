"""Token files: each shard of ids is one file that holds a wavelet matrix.

Documents are put in order of doc_id by a range shuffle, cut into shards of about ``shard_tokens`` ids, and
each shard is written as planes of bits, highest bit first. In every plane the ids whose bit is 0 come first in the
next one, in order, so rank on the planes finds an id at a place, counts an id in a range and lists the
places of an id, all from the file's mapped bytes without unpacking it. Sampled ranks are stored beside the bits.

File: magic, version, bits per id, number of ids, number of documents; lengths of the parts; then zeros per plane,
document ends (uint32), planes (packed bits), rank samples (uint32 per 512 bits), doc_ids with a null mask.
Bit planes and samples are raw, so they can be read by ranges; the small tables of documents are
compressed by zlib.

Files go to the session's shared folder under a name of their own for each attempt; only the names that finished
tasks return are read, and their list is a written table, so a lost executor leaves at most an unused file.

Defined cases: a null or empty text has the end id only; equal doc_ids follow each other in order of text;
a null doc_id comes first; an empty table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import pieces, saved, tasks, text_bytes, texts, utf8
from tidemark.llm.tokens import default_tokenizer, encoder, with_end
from tidemark.session import work_dir

MAGIC, HEAD = b"TWM1", struct.Struct("<4sIIQQQQ")
SAMPLE = 512


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """A file system for a URI or an absolute path."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class WaveletMatrix:
    """Bit planes of a sequence with rank support."""

    def __init__(self, length: int, planes: list[np.ndarray], samples: list[np.ndarray], zeros: list[int]) -> None:
        self.length, self.planes, self.samples, self.zeros = length, planes, samples, zeros

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        kind = np.uint16 if bits <= 16 else np.uint32
        level, planes, samples, zeros = ids.astype(kind), [], [], []
        for b in range(bits - 1, -1, -1):
            one = (level >> kind(b)) & kind(1) != 0
            packed = np.packbits(one, bitorder="little")
            padded = np.zeros(-(-len(packed) // 64) * 64, np.uint8)
            padded[: len(packed)] = packed
            planes.append(padded)
            counts = np.bitwise_count(padded.view(np.uint64)).reshape(-1, 8).sum(1)
            samples.append(np.concatenate(([0], np.cumsum(counts))).astype(np.uint32))
            zeros.append(int(len(one) - samples[-1][-1]))
            level = np.concatenate((level.take(np.flatnonzero(~one)), level.take(np.flatnonzero(one))))
        return cls(len(ids), planes, samples, zeros)

    def rank(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones in the first ``at`` bits of a plane."""
        at = np.asarray(at, np.int64)
        words = self.planes[plane].view(np.uint64)
        out = self.samples[plane][at // SAMPLE].astype(np.int64)
        word, last = at // SAMPLE * (SAMPLE // 64), at // 64
        for step in range(SAMPLE // 64):
            whole = word + step < last
            if whole.any():
                out[whole] += np.bitwise_count(words[(word + step)[whole]])
        part = at % 64
        some = part > 0
        low = words[last[some]] & ((np.uint64(1) << part[some].astype(np.uint64)) - np.uint64(1))
        out[some] += np.bitwise_count(low)
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at the given places."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.uint32)
        for k in range(len(self.planes)):
            one = (self.planes[k][at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            ones = self.rank(k, at)
            out = (out << np.uint32(1)) | one
            at = np.where(one, self.zeros[k] + ones, at - ones)
        return out

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        bits = len(self.planes)
        for k in range(bits):
            a, b = self.rank(k, np.array([lo, hi])).tolist()
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if token >> (bits - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often an id stands in [lo, hi)."""
        a, b = self._range(token, lo, self.length if hi is None else hi)
        return b - a

    def select(self, plane: int, bit: int, nth: np.ndarray) -> np.ndarray:
        """Place of the nth (from 0) bit of a kind in a plane."""
        lo, hi = np.zeros(len(nth), np.int64), np.full(len(nth), self.length, np.int64)
        while (lo < hi).any():
            middle = (lo + hi) // 2
            ones = self.rank(plane, middle + 1)
            enough = (ones if bit else middle + 1 - ones) > nth
            hi = np.where(enough & (lo < hi), middle, hi)
            lo = np.where(~enough & (lo < hi), middle + 1, lo)
        return lo

    def places(self, token: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """All places of an id in [lo, hi), in order."""
        a, b = self._range(token, lo, self.length if hi is None else hi)
        at, bits = np.arange(a, b), len(self.planes)
        for k in range(bits - 1, -1, -1):
            bit = token >> (bits - 1 - k) & 1
            at = self.select(k, bit, at - self.zeros[k] if bit else at)
        return np.sort(at)

    def decode(self) -> np.ndarray:
        """The whole sequence, from the lowest plane up."""
        bits, level = len(self.planes), np.zeros(self.length, np.uint32 if len(self.planes) > 16 else np.uint16)
        for k in range(bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.length, bitorder="little").view(bool)
            above = np.empty_like(level)
            above[np.flatnonzero(~one)] = level[: self.zeros[k]]
            above[np.flatnonzero(one)] = level[self.zeros[k] :] | level.dtype.type(1 << (bits - 1 - k))
            level = above
        return level.astype(np.uint32)


def pack_file(ids: np.ndarray, ends: np.ndarray, doc_ids: list[int | None], bits: int) -> bytes:
    matrix = WaveletMatrix.of(ids, bits)
    known = np.array([d is not None for d in doc_ids], bool)
    tables = zlib.compress(
        ends.astype("<u8").tobytes() + known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes(), 1
    )
    planes = b"".join(p.tobytes() for p in matrix.planes)
    samples = b"".join(s.tobytes() for s in matrix.samples)
    head = HEAD.pack(MAGIC, 1, bits, len(ids), len(ends), len(tables), len(planes))
    return head + np.array(matrix.zeros, "<u8").tobytes() + tables + planes + samples


class TokenFile:
    """A token file opened for reading; ``matrix`` answers access, count and places."""

    def __init__(self, raw: bytes) -> None:
        magic, version, bits, n, docs, tables, planes = HEAD.unpack_from(raw)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        at = HEAD.size
        zeros = np.frombuffer(raw, "<u8", bits, at).tolist()
        at += 8 * bits
        table = zlib.decompress(raw[at : at + tables])
        self.ends = np.frombuffer(table, "<u8", docs).astype(np.int64)
        known = np.frombuffer(table, bool, docs, 8 * docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(table, "<i8", docs, 9 * docs), known)]
        at += tables
        width = planes // bits
        own = [np.frombuffer(raw, np.uint8, width, at + k * width) for k in range(bits)]
        at += planes
        per = width // 64 + 1
        samples = [np.frombuffer(raw, "<u4", per, at + 4 * k * per) for k in range(bits)]
        # copies are aligned for 64-bit words
        self.matrix = WaveletMatrix(n, [p.copy() for p in own], samples, zeros)


def read_file(path: str) -> TokenFile:
    fs, name = file_system(path)
    with fs.open_input_file(name) as f:
        return TokenFile(f.read())


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str, shard_tokens: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Writes the files and returns (part, nth, path, docs, tokens), in order by part and nth."""
    rows = texts(docs, id_col, text_col)
    spark = docs.sparkSession
    # about 3 bytes of text an id: a range holds about one shard
    n = max(tasks(spark), math.ceil(text_bytes(rows) / (3 * shard_tokens)))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    fs, root = file_system(folder)
    fs.create_dir(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        bits = max(1, int(max(encode.library.get_vocab_size() - 1, end_id)).bit_length())
        held, ids, total, nth, made = [], [], 0, 0, []

        def flush() -> None:
            nonlocal total, nth
            if not ids:
                return
            path = f"{folder}/{uuid.uuid4().hex}.twm"
            ends = np.cumsum([len(x) for x in held])
            out, name = file_system(path)
            with out.open_output_stream(name) as f:
                f.write(pack_file(np.concatenate(held), ends, ids, bits))
            made.append((part, nth, path, len(ids), total))
            held.clear(), ids.clear()
            total, nth = 0, nth + 1

        part = None
        for batch in batches:
            if part is None and len(batch):
                part = batch["part"][0].as_py()
            doc_ids, offsets = batch["doc_id"].to_pylist(), utf8(batch["text"])[0]
            for lo, hi in pieces(offsets):
                got, ends = with_end(*encode.encode_all(batch["text"].slice(lo, hi - lo)), end_id)
                for doc_id, own in zip(doc_ids[lo:hi], np.split(got, ends[:-1])):
                    if ids and total + len(own) > shard_tokens:
                        flush()
                    held.append(own)
                    ids.append(doc_id)
                    total += len(own)
        flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[k] for m in made], t) for k, t in enumerate(FILE_TYPES)], FILE_NAMES
        )

    marked = ordered.withColumn("part", F.spark_partition_id())
    return saved(marked.mapInArrow(run, "part int, nth int, path string, docs long, tokens long"), "token-file-list")


FILE_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
FILE_NAMES = ["part", "nth", "path", "docs", "tokens"]


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    spark = files.sparkSession
    order = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file: a few bytes for some million ids
    placed = files.select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                file = read_file(path)
                ids = file.matrix.decode().astype("<u4")
                starts = np.concatenate(([0], file.ends[:-1]))
                sums = [zlib.crc32(memoryview(ids[a:b])) for a, b in zip(starts, file.ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(base + starts), pa.array(file.ends - starts), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.repartition(tasks(spark), "path").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op8_token_files(spark, sf: str) -> DataFrame:
    """Writes all documents as token files, and reads them back."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return read_token_files(write_token_files(docs, default_tokenizer(), 2, work_dir(spark, "token-files")))
