"""Byte-level BPE by a global shuffle of distinct words, and decoding by a join with the token-byte table.

Texts are cut into pre-tokens (``pretokens``). A block of documents keeps where each of its distinct words stands, and
explodes the words themselves: every distinct word of a block goes once to the range of its hash. A range meets each word
from all blocks, encodes each distinct one once, and sends the ids back to the blocks that asked, in the order in which they
asked. A block then puts the ids together by position. So a word that is very common costs one entry a block, and a
range is as large as its share of the distinct words. Hashes only choose the range; words are told apart by their bytes.

To decode, the distinct ids of a block are joined with the token-byte table (one row an id), and the bytes that come
back are put together by the places of the ids. The table has one row for each id of a vocabulary, whatever the corpus.

Blocks are shuffled by their key once, and both the words and the assembly read that one exchange, as do the two users of the
answers. The key of a block is a digest of what is in it, so a block that were dealt otherwise when computed anew would find no
answers and raise an error. A block has about ``block_bytes`` of text; a longer text is a block of its own, cut and put
together in numpy in parts.

Defined cases: null texts count as empty, which have no ids and decode to nothing; every row gives one row, whatever its
doc_id (null and repeated ones too); strings that look like special tokens are ordinary text; decoding gives the bytes of
the text again; an id outside the vocabulary is an error; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import saved, text_bytes, texts, utf8
from tidemark.llm.pretokens import gathered, matches, numbered, slices

BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 200_000
#: Text whose distinct words one range meets, and matches that are put together at a time.
RANGE_BYTES, SLICE = 96 << 20, 1 << 20
BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("places", pa.binary()),
    ("packs", pa.list_(pa.struct([("part", pa.int32()), ("numbers", pa.binary()), ("words", pa.binary())]))),
])
SENT = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("numbers", pa.binary()), ("words", pa.binary())])
ANSWERS = pa.schema([("block", pa.int64()), ("numbers", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())])
USED = pa.schema([("block", pa.int64()), ("used", pa.list_(pa.int32()))])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
ID_BLOCKS = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("ids", pa.list_(pa.int32()))])
_ZSTD, _WIDE = pa.Codec("zstd", 3), 65535


def pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed: two bytes each, four more from 65,535 on."""
    low = np.minimum(values, _WIDE).astype(np.uint16)
    raw = low.tobytes() + values[low == _WIDE].astype(np.uint32).tobytes()
    return np.array([len(values), len(raw)], np.int64).tobytes() + (_ZSTD.compress(raw, asbytes=True) if raw else b"")


def unpack(packed: bytes) -> np.ndarray:
    n, size = np.frombuffer(packed, np.int64, 2).tolist()
    if not n:
        return np.zeros(0, np.int64)
    raw = _ZSTD.decompress(packed[16:], size, asbytes=True)
    out = np.frombuffer(raw, np.uint16, n).astype(np.int64)
    out[out == _WIDE] = np.frombuffer(raw, np.uint32, offset=2 * n)
    return out


def pack_words(words: pa.Array) -> bytes:
    offsets, data = utf8(words)
    lengths, raw = pack(np.diff(offsets)), data[offsets[0] : offsets[-1]].tobytes()
    return np.array([len(lengths), len(raw)], np.int64).tobytes() + lengths + (_ZSTD.compress(raw, asbytes=True) if raw else b"")


def unpack_words(packed: bytes) -> pa.Array:
    k, size = np.frombuffer(packed, np.int64, 2).tolist()
    raw = _ZSTD.decompress(packed[16 + k :], size, asbytes=True) if size else b""
    return slices(np.append(0, np.cumsum(unpack(packed[16 : 16 + k]))), np.frombuffer(raw, np.uint8))


@cache
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@cache
def _merges(path: str) -> tiktoken.Encoding:
    """Merges one pre-token, whatever is in it."""
    return tiktoken.Encoding("word", pat_str=r"(?s:.+)", mergeable_ranks=ranks_of(path), special_tokens={})


def token_bytes(spark: SparkSession, path: str) -> DataFrame:
    """The token-byte table (id, token) of a vocabulary."""
    ranks = ranks_of(path)
    table = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "token": pa.array(list(ranks), pa.binary())})
    return spark.createDataFrame(table)


def _block(task: int, ids: pa.Array, text: pa.Array, parts: int) -> dict:
    found, ends = matches(text)
    index, words = numbered(found)
    # common words get small numbers; rare ones lie next to similar ones
    order = np.lexsort((pc.rank(words, tiebreaker="first").to_numpy(), -np.bincount(index, minlength=len(words)))) if len(words) else index
    number_of = np.empty(len(words), np.int64)
    number_of[order] = np.arange(len(words))
    words = words.take(pa.array(order))
    part = np.array([xxhash.xxh64_intdigest(w) % parts for w in words.to_pylist()], np.int64)
    dealt = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.diff(part[dealt], prepend=-1)).tolist()
    packs = []
    for lo, hi in zip(edges, [*edges[1:], len(dealt)]):
        own = dealt[lo:hi]
        packs.append({"part": int(part[own[0]]), "numbers": pack(np.diff(own, prepend=0)), "words": pack_words(words.take(pa.array(own)))})
    counts = np.diff(ends, prepend=0)
    places, key = pack(number_of[index]), xxhash.xxh3_64(str((task, ids.to_pylist())))
    for part in (places, counts.tobytes(), *(p["words"] for p in packs)):
        key.update(part)
    return {"block": key.intdigest() - (1 << 63), "doc_ids": ids.to_pylist(), "counts": counts, "places": places, "packs": packs}


def blocks_of(docs: DataFrame, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(block, doc_ids, counts, places, packs): the documents of each block, how many matches each has, the numbers of the words at
    all places, and the distinct words by range with their numbers."""
    parts = max(1, math.ceil(text_bytes(docs) / range_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows, n = [], 0, 0, 0
        for batch in batches:
            offsets, _ = utf8(batch["text"])
            lo = 0
            while lo < len(batch):
                most = int(np.searchsorted(offsets, offsets[lo] + block_bytes - size, "right")) - 1
                hi = min(max(most, lo + (not held)), lo + BLOCK_ROWS - rows, len(batch))
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
                    size, rows = size + int(offsets[hi] - offsets[lo]), rows + hi - lo
                if hi < len(batch) or size >= block_bytes or rows >= BLOCK_ROWS:
                    yield _one(n, held)
                    held, size, rows, n = [], 0, 0, n + 1
                lo = hi
        if held:
            yield _one(n, held)

    def _one(n: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        task = TaskContext.get().partitionId() << 32 | n
        row = _block(task, table["doc_id"].combine_chunks(), table["text"].cast(pa.large_string()), parts)
        return pa.RecordBatch.from_pylist([row], BLOCKS)

    return docs.mapInArrow(run, from_arrow_schema(BLOCKS)).repartition("block")


def sent_by(blocks: DataFrame) -> DataFrame:
    """(part, block, numbers, words): what the blocks send to the ranges. Takes all columns, so that the exchange below is the one
    which the assembly reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                packs = pa.RecordBatch.from_struct_array(batch["packs"].slice(k, 1).flatten())
                own = pa.array([batch["block"][k].as_py()] * len(packs), pa.int64())
                yield pa.RecordBatch.from_arrays([packs["part"], own, packs["numbers"], packs["words"]], schema=SENT)

    return blocks.mapInArrow(run, from_arrow_schema(SENT))


def answers_of(blocks: DataFrame, path: str) -> DataFrame:
    """(block, numbers, sizes, ids): the ids of the words that a block sent to a range, one word after another. Each range encodes each
    of its distinct words once."""

    def run(table: pa.Table) -> pa.Table:
        sent = [unpack_words(w) for w in table["words"].to_pylist()]
        index, words = numbered(pa.concat_arrays(sent))
        merge = _merges(path).encode_ordinary
        coded = [merge(w.decode()) for w in words.to_pylist()]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((i for ids in coded for i in ids), np.int64, int(size.sum()))
        bounds, rows, at = np.append(0, np.cumsum(size)), [], 0
        for block, numbers, own in zip(table["block"].to_pylist(), table["numbers"].to_pylist(), sent):
            asked = index[at : at + len(own)]
            ids, _ = gathered(asked, bounds, flat)
            rows.append({"block": block, "numbers": numbers, "sizes": pack(size[asked]), "ids": pack(ids)})
            at += len(own)
        return pa.Table.from_pylist(rows, ANSWERS)

    return sent_by(blocks).groupBy("part").applyInArrow(run, from_arrow_schema(ANSWERS)).repartition("block")


def used_by(answers: DataFrame) -> DataFrame:
    """(block, id): the distinct ids in the answers to each block."""

    def run(table: pa.Table) -> pa.Table:
        used = np.unique(np.concatenate([unpack(ids) for ids in table["ids"].to_pylist()]))
        return pa.Table.from_pylist([{"block": table["block"][0].as_py(), "used": used}], USED)

    return answers.groupBy("block").applyInArrow(run, from_arrow_schema(USED)).select("block", F.explode("used").alias("id"))


def with_tokens(owners: DataFrame, used: DataFrame, table: DataFrame) -> DataFrame:
    """The owners, each with the rows of the token-byte table that it uses: no more than the vocabulary has."""
    found = used.join(table, "id").groupBy("block").agg(F.collect_list(F.struct("id", "token")).alias("tokens"))
    return owners.join(found, "block", "left")


def lookup(tokens: pa.Array | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each id or -1, bounds, bytes) of the rows of a token-byte table."""
    rows = (tokens.as_py() if tokens is not None else None) or []
    ids = np.array([r["id"] for r in rows], np.int64)
    row = np.full(int(ids.max()) + 1 if len(ids) else 1, -1, np.int64)
    row[ids] = np.arange(len(ids))
    parts = [r["token"] for r in rows]
    bounds = np.append(0, np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))).astype(np.int64)
    return row, bounds, np.frombuffer(b"".join(parts), np.uint8)


def to_bytes(ids: np.ndarray, tokens: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all ids, one after another; where those of each id end)."""
    row, bounds, data = tokens
    if len(ids) and (int(ids.max()) >= len(row) or int(row[ids].min()) < 0):
        raise ValueError("an id is not in the token-byte table")
    return gathered(row[ids], bounds, data)


def _ids_of(block: pa.Table, answers: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
    """(document's place in the block, ids) in order; a document longer than a slice comes in several parts, one without ids in one."""
    places = unpack(block["places"][0].as_py())
    counts = block["counts"].combine_chunks().flatten().to_numpy()
    words = int(places.max()) + 1 if len(places) else 0
    sizes, starts, flat, at = np.zeros(words, np.int64), np.zeros(words, np.int64), [], 0
    for row in range(len(answers)):
        number = np.cumsum(unpack(answers["numbers"][row].as_py()))
        size, ids = unpack(answers["sizes"][row].as_py()), unpack(answers["ids"][row].as_py())
        sizes[number], starts[number] = size, at + np.cumsum(size) - size
        flat.append(ids)
        at += len(ids)
    if (sizes == 0).any():
        raise ValueError("a word of a block has no ids")
    ids = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    doc = lo = 0
    while doc < len(counts):
        hi = min(lo + SLICE, len(places))
        last = int(np.searchsorted(ends, hi, "right"))  # documents that end by hi
        size = sizes[places[lo:hi]]
        stop = np.cumsum(size)
        got = ids.take(np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(starts[places[lo:hi]] - stop + size, size))
        cuts = np.append(0, stop)[np.clip(ends[doc : min(last + 1, len(ends))], lo, hi) - lo].tolist()
        at = 0
        for k, cut in enumerate(cuts):
            yield doc + k, (doc + k < last), got[at:cut]
            at = cut
        doc, lo = last, hi


def _documents(block: pa.Table, answers: pa.Table) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    names, parts = block["doc_ids"][0].as_py() if len(block) else [], []
    for doc, done, ids in _ids_of(block, answers) if len(block) else ():
        parts.append(ids)
        if done:
            yield names[doc], parts
            parts = []


def _digests(block: pa.Table, answers: pa.Table) -> pa.Table:
    out, tokens = [], lookup(block["tokens"][0] if len(block) else None)
    hashes, count, names = (hashlib.sha256(), hashlib.sha256()), 0, block["doc_ids"][0].as_py() if len(block) else []
    for doc, done, ids in _ids_of(block, answers) if len(block) else ():
        hashes[0].update(ids.astype("<u4").tobytes())
        hashes[1].update(to_bytes(ids, tokens)[0].tobytes())
        count += len(ids)
        if done:
            out.append((names[doc], count, hashes[0].hexdigest(), hashes[1].hexdigest()))
            hashes, count = (hashlib.sha256(), hashlib.sha256()), 0
    return pa.Table.from_pylist([dict(zip(DIGESTS.names, r)) for r in out], DIGESTS)


def _met(blocks: DataFrame, answers: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: StructType | str) -> DataFrame:
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    blocks = blocks_of(texts(docs, id_col, text_col), block_bytes, range_bytes)

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        found = [(name, np.concatenate(parts)) for name, parts in _documents(block, answers)]
        ids = pa.array([x.astype(np.int32) for _, x in found], pa.list_(pa.int32()))
        return pa.table({"doc_id": pa.array([name for name, _ in found], pa.int64()), "ids": ids})

    return _met(blocks, answers_of(blocks, path), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, table: DataFrame, ids_col: str = "ids", rows: int = 1000) -> DataFrame:
    """(doc_id, bytes) of every row of (doc_id, ids array<int>), null ids as none. ``table`` is (id, token); ids meet it by a join on the
    distinct ids of a block of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo in range(0, len(batch), rows):
                own = batch.slice(lo, rows)
                ids = pc.fill_null(own["ids"], pa.scalar([], own["ids"].type))
                counts = pc.list_value_length(ids)
                row = {"block": number, "doc_ids": own["doc_id"].to_pylist(), "counts": counts.to_pylist(), "ids": ids.flatten().to_pylist()}
                yield pa.RecordBatch.from_pylist([row], ID_BLOCKS)
                number += 1

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                ids = batch["ids"].slice(k, 1).flatten().to_numpy().astype(np.int64)
                data, ends = to_bytes(ids, lookup(batch["tokens"][k]))
                cuts = np.append(0, np.append(0, ends)[np.cumsum(batch["counts"][k].as_py()).astype(np.int64)]).tolist()
                raw = [data[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(batch["doc_ids"][k].as_py(), pa.int64()), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    given = encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), encoded[ids_col].cast("array<int>").alias("ids"))
    owners = saved(given.mapInArrow(run, from_arrow_schema(ID_BLOCKS)), "bpe-ids")
    return with_tokens(owners, owners.select("block", F.explode(F.array_distinct("ids")).alias("id")), table).mapInArrow(back, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: texts encoded, and the ids decoded again."""
    blocks = blocks_of(texts(docs, id_col, text_col), block_bytes, range_bytes)
    answers = answers_of(blocks, path)
    return _met(with_tokens(blocks, used_by(answers), token_bytes(docs.sparkSession, path)), answers, _digests, from_arrow_schema(DIGESTS))


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op11_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """The ids of every document, and its bytes decoded from them, by their digests."""
    return round_trip(spark.read.parquet(f"{sf}/documents.parquet"), default_ranks())
