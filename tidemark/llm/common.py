"""What the operators share: input columns, sizes, written tables, and numpy views of Arrow text.

Every operator takes its id and text columns out of the given frame first, so further columns,
whatever their names, are neither read nor returned. A null text counts as an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import work_dir


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): the two columns an operator works on."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )


def saved(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(F.octet_length("text"))).first()[0] or 0


#: Text in a chunk of documents.
CHUNK_BYTES = 4 << 20


def by_chunk(df: DataFrame, total: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows dealt by a hash of doc_id into chunks of about chunk_bytes; one copy of each exchange is
    shared by all uses of the frame in a plan."""
    n = tasks(df.sparkSession)
    count = max(4 * n, math.ceil(total / chunk_bytes))
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int")
    return df.select(chunk.alias("chunk"), "doc_id", "text").repartition(n, "chunk")


def sorted_rows(table: pa.Table) -> pa.Table:
    """A chunk in order: by doc_id, null first, then by text, null as empty."""
    table = table.set_column(
        table.column_names.index("text"), "text", pc.fill_null(table["text"], "")
    )
    order = pc.sort_indices(
        table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"
    )
    return table.take(order)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without copying; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return at.astype(np.int64), np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def slices(bounds: np.ndarray, data: np.ndarray) -> pa.Array:
    """The bytes between neighbouring bounds as an Arrow array over the data."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])


def numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each value among the distinct ones, the distinct values in order of first appearance)."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def listed(values: pa.Array) -> list[bytes]:
    """The values of a binary array."""
    offsets, data = utf8(values)
    raw, at = data[offsets[0] : offsets[-1]].tobytes(), (offsets - offsets[0]).tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def gathered(index: np.ndarray, bounds: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat[bounds[i]:bounds[i + 1]] for every i of the index, one after another; where each ends)."""
    start = bounds.take(index)
    size = bounds.take(index + 1) - start
    stop = np.cumsum(size)
    total = int(stop[-1]) if len(stop) else 0
    return flat.take(np.arange(total) + np.repeat(start - stop + size, size)), stop


def pieces(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2^64 of all substrings, from one prefix sum."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = np.full(size, self.base, np.uint64)
            self.down = np.full(size, self.inverse, np.uint64)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        return self.up[:n], self.down[:n]

    def prefix(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * self.powers(len(values))[0], out=out[1:])
        return out

    def between(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.powers(len(prefix))[1][start])

    def windows(self, values: np.ndarray, n: int) -> np.ndarray:
        """Hash of values[i:i+n] for every i; nothing if there are fewer."""
        if len(values) < n:
            return np.zeros(0, np.uint64)
        p = self.prefix(values)
        m = len(values) - n + 1
        return mix((p[n:] - p[:m]) * self.powers(m)[1])


BYTES, WORDS, WORDS2 = Rolling(0x9E3779B97F4A7C15), Rolling(0xD1342543DE82EF95), Rolling(0xAF251AF3B0F025B5)
# ASCII white space, at which words end: \t \n \v \f \r and space (fixed values).
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """The words of several texts that lie one after another: where each starts and ends, its text, and two
    64-bit hashes of its bytes, the halves of XXH3's 128 bits. Works through long texts in blocks that end at white space."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, block: int = 1 << 20) -> None:
        first, last = int(offsets[0]), int(offsets[-1])
        starts, ends, hashes, seconds = [], [], [], []
        edge = np.zeros(last - first + 1, bool)
        edge[offsets - first] = True
        lo = first
        while lo < last:
            hi = min(lo + block, last)
            while hi < last:
                stop = np.flatnonzero(BLANK[data[hi : hi + block]] | edge[hi - first : min(hi + block, last) - first])
                hi = hi + int(stop[0]) if len(stop) else min(hi + block, last)
                if len(stop):
                    break
            part = data[lo:hi]
            word = ~BLANK[part]
            cut = edge[lo - first : hi - first]
            before = np.empty(len(word), bool)
            before[0] = True
            before[1:] = ~word[:-1]
            after = np.empty(len(word), bool)
            after[-1] = True
            after[:-1] = ~word[1:]
            s = np.flatnonzero(word & (before | cut))
            after[:-1] |= cut[1:]
            e = np.flatnonzero(word & after) + 1
            number, distinct = numbered(slices(np.append(0, np.cumsum(e - s)), part[word]))
            both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, listed(distinct))), ">u8").reshape(-1, 2).astype(np.uint64)
            hashes.append(both[:, 0].take(number))
            seconds.append(both[:, 1].take(number))
            starts.append(s + lo)
            ends.append(e + lo)
            lo = hi
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.start, self.end, self.hash = join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)
        self.second = join(seconds, np.uint64)
        #: first word of each text, and the number of all words
        self.bounds = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.bounds)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        #: place of each word in its text
        self.place = np.arange(len(self.start)) - np.repeat(self.bounds[:-1], self.counts)

    def __len__(self) -> int:
        return len(self.start)

    def inside(self, n: int) -> np.ndarray:
        """For each start of a window of n words: does the window end in the same text?"""
        m = max(0, len(self.start) - n + 1)
        return self.text[:m] == self.text[len(self.start) - m :] if m else np.zeros(0, bool)


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in [s, s + width) of any start."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:-1]) > 0


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True: their starts and ends."""
    step = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hot_first(count: Column, total: int, most: int = 1000) -> Column:
    """True for keys with over 1/most of all rows; fewer than ``most`` keys can be."""
    return count * F.lit(most) > F.lit(total)


def join_hot(left: DataFrame, right: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Left join with a table that has one row per key and, in ``count``, how many rows of the left have it. The
    fewer than 1000 keys with over a thousandth of all rows go by broadcast, so no task gets a hot key."""
    hot = F.broadcast(right.filter(hot_first(F.col(count), total)))
    cold = right.filter(~hot_first(F.col(count), total))
    rest = left.join(hot.select(key), key, "left_anti").join(cold, key, "left")
    return left.join(hot, key).unionByName(rest)
