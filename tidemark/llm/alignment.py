"""Tokens of two tokenizers lined up by their bytes, and how often their pairs are linked in a corpus.

A byte-level BPE encodes a space and the text, a piece model the text, to which it adds that space; both then spell the same
bytes. Where tokens of both end, the text is cut into groups, and in a group every token of the one is linked to every token of the
other. Texts are worked through in parts that end where both tokenizers start a new word, so a long text needs no more memory
than its tokens' distinct pairs.

Counts of pairs, by minimal perfect hashing: the first pass lines up each block of documents once and keeps, for each shard of the
first tokenizer's ids, the distinct pairs of the block and how many of its documents hold each. A shard's distinct pairs come
together over a tree of merges and get a minimal perfect hash. Dense vectors of counts, indexed by that hash, are summed over the same
tree; the key stored under a number is compared with each pair, so no pair counts as another. All pairs of an id lie in one
shard, which so knows the id's highest count. The second pass lines up the documents again, from the ids that the first one
left of each block, and looks the counts of their pairs up. A shard has at most (ids of the first tokenizer / shards) * (ids of the second) pairs, whatever the corpus.

Defined cases: a text that is null or empty, or whose tokens of either kind spell other bytes than a space and the text, has no
tokens, and all its counts are zero; strings of special tokens are plain text; rows are documents, so repeated rows and
null ids count each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.llm.byte_bpe import pack, pack_words, unpack, unpack_words
from tidemark.llm.common import saved, texts, utf8
from tidemark.llm.perfect_hash import PerfectHash
from tidemark.llm.pretokens import SAFE, gathered, listed, matches, slices
from tidemark.llm.tokens import SPELLING, Encoder, Known, default_tokenizer

BLOCK_BYTES, BLOCK_ROWS = 2 << 20, 100_000
#: Text that is encoded, ids that are lined up and links that are written out at a time.
PART, TOKENS, LINKS = 1 << 19, 1 << 18, 1 << 18
#: Shards of the first tokenizer's ids, and blocks that are merged at a time.
SHARDS, FAN = 64, 512
PACK = pa.struct([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
BLOCKS = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("tokens", pa.list_(pa.binary())), ("packs", pa.list_(PACK))])
KEYS = pa.schema([("shard", pa.int32()), ("node", pa.int64()), ("keys", pa.binary())])
HASHES = pa.schema([("shard", pa.int32()), ("hash", pa.binary()), ("keys", pa.binary())])
VECTORS = pa.schema([("shard", pa.int32()), ("node", pa.int64()), ("vector", pa.binary())])
TABLES = pa.schema([*HASHES, ("counts", pa.binary()), ("best", pa.binary())])
ANSWERS = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
COUNTED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
ALIGNED = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTED], ("groups_sha256", pa.string())])


class Spelt:
    """A tokenizer's ids of words, as bytes, and what each id spells. A word whose ids spell other bytes has the one id ``wrong``."""

    def __init__(self, ask: Callable[[list[bytes]], Iterator[list[int]]], spelling: list[bytes]) -> None:
        self.ask, self.spelling, self.wrong = ask, spelling, len(spelling)
        self.size = np.array([*map(len, spelling), 0], np.int64)
        self.known = Known(self._checked)

    def _checked(self, words: list[bytes]) -> Iterator[list[int]]:
        for word, ids in zip(words, self.ask(words)):
            yield list(ids) if b"".join([self.spelling[i] for i in ids]) == word else [self.wrong]


@cache
def byte_level(path: str) -> Spelt:
    own = Encoder(path, plain=True)
    if not own.cuts:
        raise ValueError("the first tokenizer must be a byte-level BPE")
    plain = {c: b for b, c in SPELLING.items()}
    size = own.library.get_vocab_size()
    return Spelt(own.merge, [bytes(plain[c] for c in own.library.id_to_token(i) or "") for i in range(size)])


@cache
def pieces_of(path: str) -> Spelt:
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    space = own.piece_to_id("\u2581")
    size = own.get_piece_size()
    bytes_of = lambda i: bytes([int(own.id_to_piece(i)[3:5], 16)]) if own.is_byte(i) else own.id_to_piece(i).replace("\u2581", " ").encode()

    def ask(words: list[bytes]) -> Iterator[list[int]]:
        # the model adds the first space; of nothing it makes nothing
        return (ids or [space] for ids in own.encode([w[1:].decode() for w in words], num_threads=1))

    return Spelt(ask, [bytes_of(i) for i in range(size)])


@dataclass
class Coded:
    """The ids of parts of texts: of which text each part is, ascending, and how many ids of both kinds it has."""

    doc: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    a: np.ndarray
    b: np.ndarray

    def to_bytes(self) -> list[bytes]:
        return [pack(np.diff(self.doc, prepend=0)), *map(pack, (self.n_a, self.n_b, self.a, self.b))]

    @classmethod
    def from_bytes(cls, raw: list[bytes]) -> "Coded":
        first, *rest = map(unpack, raw)
        return cls(np.cumsum(first), *rest)

    def slices(self) -> Iterator["Coded"]:
        """Some TOKENS ids at a time, but no less than a part."""
        a_ends, b_ends = np.cumsum(self.n_a), np.cumsum(self.n_b)
        lo = 0
        while lo < len(self.doc):
            a0, b0 = (int(e[lo - 1]) if lo else 0 for e in (a_ends, b_ends))
            hi = max(lo + 1, int(np.searchsorted(a_ends + b_ends, a0 + b0 + TOKENS, "right")))
            a1, b1 = int(a_ends[hi - 1]), int(b_ends[hi - 1])
            yield Coded(self.doc[lo:hi], self.n_a[lo:hi], self.n_b[lo:hi], self.a[a0:a1], self.b[b0:b1])
            lo = hi


@dataclass
class Lined:
    """Ids of both tokenizers, the ends of the groups among them, and the document of each group, ascending."""

    a: np.ndarray
    b: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray
    doc: np.ndarray


def parts_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(document, a space and its text or a part of it) of texts that have one, some PART bytes at a time."""
    docs, held, size = [], [], 0
    for doc, text in enumerate(texts):
        spaced, at = b" " + text, 0
        while text and at < len(spaced):
            cut = SAFE.search(spaced, at + PART) if len(spaced) - at > PART else None
            stop = cut.start() if cut else len(spaced)
            docs.append(doc)
            held.append(spaced[at:stop])
            size, at = size + stop - at, stop
            if size >= PART:
                yield np.array(docs), held
                docs, held, size = [], [], 0
    if held:
        yield np.array(docs), held


def _encoded(held: list[bytes], first: Spelt, second: Spelt) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of A, where those of each part end, ids of B, where those of each part end)."""
    offsets = np.append(0, np.cumsum([len(h) for h in held])).astype(np.int64)
    data = np.frombuffer(b"".join(held), np.uint8)
    found, ends = matches(slices(offsets, data))
    a, stop = first.known.of(found)
    a_ends = np.append(0, stop)[ends]
    starts = data == 32  # words of the second kind begin at the first of some spaces, and with each part
    starts[1:] &= data[:-1] != 32
    starts[offsets[:-1]] = True
    starts = np.flatnonzero(starts)
    b, stop = second.known.of(slices(np.append(starts, len(data)), data))
    return a, a_ends, b, np.append(0, stop)[np.searchsorted(starts, offsets[1:])]


def coded(texts: list[bytes], first: Spelt, second: Spelt) -> Coded:
    """The ids of all texts that both tokenizers spell as they are."""
    docs, sizes, ids, wrong = [], ([], []), ([], []), []
    for doc, held in parts_of(texts):
        a, a_ends, b, b_ends = _encoded(held, first, second)
        docs.append(doc)
        for k, (own, ends, kind) in enumerate(((a, a_ends, first), (b, b_ends, second))):
            sizes[k].append(np.diff(ends, prepend=0))
            ids[k].append(own)
            wrong.append(doc[np.searchsorted(ends, np.flatnonzero(own == kind.wrong), "right")])
    if not docs:
        return Coded(*[np.zeros(0, np.int64)] * 5)
    doc, (n_a, n_b), (a, b) = np.concatenate(docs), map(np.concatenate, sizes), map(np.concatenate, ids)
    wrong = np.concatenate(wrong)
    if len(wrong):
        good = ~np.isin(doc, wrong)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        doc, n_a, n_b = doc[good], n_a[good], n_b[good]
    return Coded(doc, n_a, n_b, a, b)


def line_up(own: Coded, sizes: tuple[np.ndarray, np.ndarray]) -> Lined:
    """``sizes`` are the bytes that each id of both tokenizers spells."""
    a_at, b_at = np.cumsum(sizes[0][own.a]), np.cumsum(sizes[1][own.b])
    ends = np.zeros(int(a_at[-1]) + 1 if len(a_at) else 1, bool)  # parts have both kinds of ids or none
    ends[b_at] = True
    a_cut = np.flatnonzero(ends[a_at]) + 1
    both = a_at[a_cut - 1]
    part = np.searchsorted(a_at[np.cumsum(own.n_a) - 1], both)
    return Lined(own.a.astype(np.int64), own.b.astype(np.int64), a_cut, np.searchsorted(b_at, both) + 1, own.doc[part])


def links_of(lined: Lined, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, pair) of all links, LINKS at a time; a pair is a * width + b."""
    a_from, b_from = (np.append(0, cut[:-1]) if len(cut) else cut for cut in (lined.a_cut, lined.b_cut))
    b_size = lined.b_cut - b_from
    ends = np.cumsum((lined.a_cut - a_from) * b_size)
    total = int(ends[-1]) if len(ends) else 0
    for lo in range(0, total, LINKS):
        hi = min(lo + LINKS, total)
        g0, g1 = np.searchsorted(ends, [lo, hi - 1], "right")
        own = np.minimum(ends[g0 : g1 + 1], hi)
        group = np.repeat(np.arange(g0, g1 + 1), np.diff(own, prepend=lo))
        at = np.arange(lo, hi) - np.append(0, ends)[group]
        a, b = a_from[group] + at // b_size[group], b_from[group] + at % b_size[group]
        yield lined.doc[group], lined.a[a] * width + lined.b[b]


def _wide(values: np.ndarray) -> bytes:
    return pack_words(slices(np.array([0, 8 * len(values)]), values.astype("<i8").view(np.uint8)))


def _narrow(raw: bytes) -> np.ndarray:
    return np.frombuffer(unpack_words(raw)[0].as_py(), "<i8")


def _steps(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=0))


def _keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def pairs_of(own: Coded, first: Spelt, second: Spelt) -> tuple[np.ndarray, np.ndarray]:
    """(distinct pairs, in how many of the documents each is linked)."""
    most, found = first.wrong * second.wrong, []
    for part in own.slices():
        lined = line_up(part, (first.size, second.size))
        found += [distinct(doc * most + key) for doc, key in links_of(lined, second.wrong)]
    every = distinct(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return np.unique(every % most, return_counts=True)


def blocks_of(docs: DataFrame, a: str, b: str, block_bytes: int, shards: int) -> DataFrame:
    """(block, doc_ids, tokens, packs): the first pass. A written table, so both passes see the same blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = byte_level(a), pieces_of(b)
        if first.wrong * second.wrong >= 1 << 32:
            raise ValueError("the vocabularies have 2^32 pairs or more")
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            offsets, _ = utf8(batch["text"])
            lo = 0
            while lo < len(batch):
                hi = int(np.searchsorted(offsets, offsets[lo] + block_bytes, "right")) - 1
                hi = min(max(hi, lo + 1), lo + BLOCK_ROWS, len(batch))
                text = batch["text"].slice(lo, hi - lo).cast(pa.large_string()).fill_null("")
                own = coded(listed(text), first, second)
                keys, counts = pairs_of(own, first, second)
                shard = keys // second.wrong % shards
                packs = [
                    {"shard": int(k), "keys": _steps(keys[shard == k]), "counts": pack(counts[shard == k])} for k in np.unique(shard)
                ]
                ids = batch["doc_id"].slice(lo, hi - lo).to_pylist()
                yield pa.RecordBatch.from_pylist([{"block": number, "doc_ids": ids, "tokens": own.to_bytes(), "packs": packs}], BLOCKS)
                number, lo = number + 1, hi

    return saved(docs.mapInArrow(run, from_arrow_schema(BLOCKS)), "aligned-blocks")


def over_tree(leaves: DataFrame, width: int, fan: int, merge: Callable[[pa.Table], pa.Table], schema: pa.Schema) -> DataFrame:
    """Rows of each (shard, node) merged, level by level, until there is one node."""
    while True:
        leaves = leaves.groupBy("shard", "node").applyInArrow(merge, from_arrow_schema(schema))
        if width == 1:
            return leaves
        width = math.ceil(width / fan)
        leaves = leaves.withColumn("node", F.col("node") % width)


def _merged_keys(table: pa.Table) -> pa.Table:
    own = np.unique(np.concatenate([_keys(k) for k in table["keys"].to_pylist()]))
    return pa.Table.from_pylist([{"shard": table["shard"][0], "node": table["node"][0], "keys": _steps(own)}], KEYS)


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros(1, np.int64)
    for vector in table["vector"].to_pylist():
        total = total + _narrow(vector)
    return pa.Table.from_pylist([{"shard": table["shard"][0], "node": table["node"][0], "vector": _wide(total)}], VECTORS)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            keys = _keys(row["keys"])
            own = PerfectHash.of(keys)
            stored = np.empty(len(keys), np.int64)
            stored[own.numbers(keys)] = keys
            yield pa.RecordBatch.from_pylist([{"shard": row["shard"], "hash": own.to_bytes(), "keys": pack(stored)}], HASHES)


def _numbers(own: PerfectHash, stored: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The numbers of keys that are all among the stored ones."""
    at = own.numbers(keys)
    if not (stored[at] == keys).all():
        raise ValueError("a pair is not among those of its shard")
    return at


def _vector(pairs: pa.Table, hashes: pa.Table) -> pa.Table:
    if not len(pairs):
        return VECTORS.empty_table()
    own, stored = PerfectHash.from_bytes(hashes["hash"][0].as_py()), unpack(hashes["keys"][0].as_py())
    vector = np.zeros(len(stored), np.int64)
    for keys, counts in zip(pairs["keys"].to_pylist(), pairs["counts"].to_pylist()):
        vector[_numbers(own, stored, _keys(keys))] += unpack(counts)
    return pa.Table.from_pylist([{"shard": pairs["shard"][0], "node": pairs["node"][0], "vector": _wide(vector)}], VECTORS)


def _answer(pairs: pa.Table, tables: pa.Table) -> pa.Table:
    if not len(pairs):
        return ANSWERS.empty_table()
    row = tables.slice(0, 1).to_pylist()[0]
    own, stored = PerfectHash.from_bytes(row["hash"]), unpack(row["keys"])
    counts, best = _narrow(row["counts"]), np.unpackbits(np.frombuffer(row["best"], np.uint8), count=len(stored))
    out = []
    for block, keys in zip(pairs["block"].to_pylist(), pairs["keys"].to_pylist()):
        at = _numbers(own, stored, _keys(keys))
        out.append({"block": block, "keys": keys, "counts": _wide(counts[at]), "best": np.packbits(best[at]).tobytes()})
    return pa.Table.from_pylist(out, ANSWERS)


def counted(pairs: DataFrame, n_blocks: int, width: int, fan: int) -> tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame]]:
    """(pairs dealt to nodes, the table of each shard's hash, keys, counts and highest counts, and what deals tables to nodes). Written
    tables keep Python steps in stages of their own, so a task never holds two workers."""
    nodes = max(1, math.ceil(n_blocks / fan))
    dealt = pairs.withColumn("node", F.pmod(F.xxhash64("block"), F.lit(nodes)))
    every = lambda tables: tables.withColumn("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nodes - 1).cast("long"))))
    keys = saved(over_tree(dealt.select("shard", "node", "keys"), nodes, fan, _merged_keys, KEYS), "pair-keys")
    hashes = saved(keys.mapInArrow(_hashed, from_arrow_schema(HASHES)), "pair-hashes")
    vectors = dealt.groupBy("shard", "node").cogroup(every(hashes).groupBy("shard", "node")).applyInArrow(_vector, from_arrow_schema(VECTORS))
    sums = saved(over_tree(vectors, nodes, fan, _summed, VECTORS), "pair-vectors").select("shard", "vector")

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts, first = _narrow(row["vector"]), unpack(row["keys"]) // width
                most = np.zeros(int(first.max()) + 1, np.int64)
                np.maximum.at(most, first, counts)
                own = {"counts": _wide(counts), "best": np.packbits(counts == most[first]).tobytes()}
                yield pa.RecordBatch.from_pylist([{k: row[k] for k in HASHES.names} | own], TABLES)

    tables = saved(hashes.join(sums, "shard").mapInArrow(highest, from_arrow_schema(TABLES)), "pair-counts")
    return dealt, tables, every


@cache
def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    own = [b"%d," % i for i in range(size)]
    return np.append(0, np.cumsum([len(x) for x in own])), np.frombuffer(b"".join(own), np.uint8)


def spelt_groups(lined: Lined, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(the ids of all groups as text, each group with a mark at its end; where each group ends)."""
    a_from, b_from = np.append(0, lined.a_cut[:-1]), np.append(0, lined.b_cut[:-1])
    ids = np.empty(len(lined.a) + len(lined.b), np.int64)
    ids[np.arange(len(lined.a)) + np.repeat(b_from, lined.a_cut - a_from)] = lined.a
    ids[np.arange(len(lined.b)) + np.repeat(lined.a_cut, lined.b_cut - b_from)] = lined.b
    text, ends = gathered(ids, *digits)
    text[ends[lined.a_cut + b_from - 1] - 1] = ord("|")
    ends = ends[lined.a_cut + lined.b_cut - 1]
    text[ends - 1] = ord(";")
    return text, ends


def _second_pass(names: list, own: Coded, answers: pa.Table, sizes: tuple[np.ndarray, np.ndarray], groups: bool) -> pa.Table:
    digits, width = _digits(max(map(len, sizes))), len(sizes[1]) - 1
    keys = [_keys(k) for k in answers["keys"].to_pylist()]
    counts = [_narrow(c) for c in answers["counts"].to_pylist()]
    best = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(answers["best"].to_pylist(), keys)]
    keys, counts, best = (np.concatenate([*x, [-1]]).astype(np.int64) for x in (keys, counts, best))  # -1 stands for no pair
    order = np.argsort(keys)
    keys, counts, best = keys[order], counts[order], best[order]
    out, hashes, written = {c: np.zeros(len(names), np.int64) for c in COUNTED}, {}, {}

    def add(column: str, doc: np.ndarray, values: np.ndarray) -> None:
        at = np.flatnonzero(np.diff(doc, prepend=-1))
        out[column][doc[at]] += np.add.reduceat(values, at)

    for part in own.slices():
        lined = line_up(part, sizes)
        for column, cut in (("n_a", lined.a_cut), ("n_b", lined.b_cut)):
            add(column, lined.doc, np.diff(cut, prepend=0))
        add("n_groups", lined.doc, np.ones(len(lined.doc), np.int64))
        for doc, key in links_of(lined, width):
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            if not (keys[at] == key).all():
                raise ValueError("a pair of a document was not counted")
            add("n_links", doc, np.ones(len(doc), np.int64))
            add("n_best", doc, best[at])
            add("count_sum", doc, counts[at])
        text, ends = spelt_groups(lined, digits)
        last = np.flatnonzero(np.diff(lined.doc, append=-1))
        lo = 0
        for doc, hi in zip(lined.doc[last].tolist(), ends[last].tolist()):
            said = text[lo : hi - 1].tobytes()
            if doc in hashes:
                said = b";" + said
            hashes.setdefault(doc, hashlib.sha256()).update(said)
            if groups:
                written[doc] = written.get(doc, b"") + said
            lo = hi
    columns = [pa.array(names, pa.int64()), *[pa.array(out[c]) for c in COUNTED]]
    columns.append(pa.array([hashes[d].hexdigest() if d in hashes else "" for d in range(len(names))], pa.string()))
    if groups:
        columns.append(pa.array([written.get(d, b"").decode() for d in range(len(names))], pa.string()))
    return pa.Table.from_arrays(columns, names=[*ALIGNED.names, *(["groups"] if groups else [])])


def align(
    docs: DataFrame, a: str, b: str, groups: bool = False, block_bytes: int = BLOCK_BYTES, shards: int = SHARDS, fan: int = FAN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row, with ``groups`` also the ids of all groups as text."""
    blocks = blocks_of(texts(docs, id_col, text_col), a, b, block_bytes, shards)
    pairs = blocks.select("block", F.inline("packs"))
    # The second pass needs no tokenizer; workers that had them for the first one let them go.
    sizes = byte_level(a).size, pieces_of(b).size
    dealt, tables, every = counted(pairs, blocks.count(), len(sizes[1]) - 1, fan)
    answers = dealt.groupBy("shard", "node").cogroup(every(tables).groupBy("shard", "node")).applyInArrow(_answer, from_arrow_schema(ANSWERS))

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        byte_level.cache_clear()
        pieces_of.cache_clear()
        own = Coded.from_bytes(block["tokens"][0].as_py())
        return _second_pass(block["doc_ids"][0].as_py(), own, answers, sizes, groups)

    schema = from_arrow_schema(pa.schema([*ALIGNED, *([("groups", pa.string())] if groups else [])]))
    return blocks.select("block", "doc_ids", "tokens").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def pair_counts(docs: DataFrame, a: str, b: str, block_bytes: int = BLOCK_BYTES, shards: int = SHARDS, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, n_docs, best): every linked pair of ids, in how many rows, and whether no other pair of the id a is in more."""
    blocks = blocks_of(texts(docs, id_col, text_col), a, b, block_bytes, shards)
    width = pieces_of(b).wrong
    _, tables, _ = counted(blocks.select("block", F.inline("packs")), blocks.count(), width, fan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = unpack(row["keys"])
                best = np.unpackbits(np.frombuffer(row["best"], np.uint8), count=len(keys)).astype(bool)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys // width, keys % width, _narrow(row["counts"]), best)], ["a", "b", "n_docs", "best"])

    return tables.mapInArrow(run, "a long, b long, n_docs long, best boolean")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """How the tokens of two tokenizers line up in every document, and how common its links are in all documents."""
    return align(spark.read.parquet(f"{sf}/documents.parquet"), default_tokenizer(), default_pieces())
