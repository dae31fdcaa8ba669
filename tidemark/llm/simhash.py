"""SimHash near-duplicates: fingerprints of shingles, linked by BK-tree search, joined into components.

Distinct fingerprints are dealt into shards by keys: of ``blocks`` equal blocks of bits at least ``blocks`` - radius
are equal in two linked fingerprints, so two such meet in a shard for some choice of that many blocks. Each
shard has a BK-tree: children are keyed by their Hamming distance to the parent, and a search follows only edges within
the radius of its own distance. Trees are never broadcast: all of them together grow with the data and have no size
bound, so each tree is built in the one task to which its queries come. Keys with over a thousandth of all
rows are split by further bits, after which a shard holds at most 2^22 distinct fingerprints; within a task large shards
are split the same way. A shard returns a spanning forest of its links, not all pairs.

Defined cases: a null, empty or blank text has fingerprint zero, which links like any other; texts of fewer words than
a shingle are one shingle; repeated rows each get a row; a null doc_id is never the smallest of a component (null if
there is no other); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.common import hot_first, join_hot, saved, tasks, texts
from tidemark.llm.components import components
from tidemark.llm.tokens import strings

SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """The majority of each bit over the XXH64 of all word shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    cut = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in cut], "<u8")
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


class BKTree:
    """Codes in a tree whose children are keyed by their Hamming distance to the parent."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, code: int) -> None:
        at, new = 0, len(self.codes)
        self.codes.append(code)
        self.children.append({})
        while new:
            d = (self.codes[at] ^ code).bit_count()
            to = self.children[at].setdefault(d, new)
            if to == new:
                return
            at = to

    def search(self, code: int, radius: int) -> list[int]:
        """Places of all codes within the radius."""
        found, todo = [], [0] if self.codes else []
        codes, children = self.codes, self.children
        while todo:
            at = todo.pop()
            d = (codes[at] ^ code).bit_count()
            if d <= radius:
                found.append(at)
            own = children[at]
            if own:
                for k in range(max(0, d - radius), d + radius + 1):
                    if k in own:
                        todo.append(own[k])
        return found


def parts(free: list[int], count: int) -> list[list[int]]:
    """Bit places in ``count`` blocks of about the same size."""
    return [list(map(int, p)) for p in np.array_split(np.array(free), count)]


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def links_in(codes: list[int], free: list[int], radius: int, largest: int = 1024) -> Iterator[tuple[int, int]]:
    """Links between distinct codes that differ in ``free`` bits only; enough of them to join what is joined."""
    root = list(range(len(codes)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def walk(own: list[int], bits: list[int]) -> Iterator[tuple[int, int]]:
        if len(own) < 2:
            return
        if len(own) <= largest or len(bits) <= 2 * (radius + 1):
            tree = BKTree()
            for i in own:
                for j in tree.search(codes[i], radius):
                    a, b = top(i), top(own[j])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        yield i, own[j]
                tree.add(codes[i])
            return
        for block in parts(bits, radius + 1):
            m, rest = mask_of(block), [b for b in bits if b not in block]
            own = sorted(own, key=lambda i: codes[i] & m)
            for _, same in groupby(own, key=lambda i: codes[i] & m):
                yield from walk(list(same), rest)

    yield from walk(list(range(len(codes))), free)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shard_links(fingerprints: DataFrame, radius: int = 2, blocks: int = 4) -> DataFrame:
    """(a, b): enough links between representatives of distinct fingerprints (fp, rep) to join all that are linked."""
    cut = parts(list(range(64)), blocks)
    choices = [sorted(sum(c, [])) for c in combinations(cut, blocks - radius)]
    frees = [[b for b in range(64) if b not in c] for c in choices]
    keyed = fingerprints.select(
        "fp", "rep",
        F.explode(F.array(*[F.struct(F.lit(k).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(mask_of(c)))).alias("key")) for k, c in enumerate(choices)])).alias("c"),
    ).select("fp", "rep", "c.*")
    total = fingerprints.count()
    counts = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter("n > 1")
    counts = saved(counts, "simhash-keys")
    hot = counts.filter(hot_first(F.col("n"), total) & (F.col("n") > 4096)).select("choice", "key")  # under 1000 a choice
    # A hot key is split by each block of what it leaves free.
    finer = [[parts(free, radius + 1)[j] for j in range(radius + 1)] for free in frees]
    sub = F.array(*[
        F.struct(
            F.lit(j).alias("sub"),
            F.col("fp").bitwiseAND(F.element_at(F.array(*[F.lit(signed(mask_of(f[j]))) for f in finer]), F.col("choice") + 1)).alias("subkey"),
        )
        for j in range(radius + 1)
    ])
    plain = keyed.join(F.broadcast(hot), ["choice", "key"], "left_anti").join(counts.select("choice", "key"), ["choice", "key"], "left_semi")
    split = keyed.join(F.broadcast(hot), ["choice", "key"]).withColumn("s", F.explode(sub)).select("choice", "key", "fp", "rep", "s.*")
    dealt = plain.select("choice", "key", "fp", "rep", F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("subkey")).unionByName(split)
    shard = ["choice", "key", "sub", "subkey"]
    dealt = dealt.repartition(tasks(fingerprints.sparkSession), *shard).sortWithinPartitions(*shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch[c].to_pylist() for c in (*shard, "fp", "rep")))

        out: list[tuple[int, int]] = []
        for (choice, _, s, _), own in groupby(rows(), key=lambda r: r[:4]):
            own = list(own)
            free = [b for b in frees[choice] if s < 0 or b not in finer[choice][s]]
            codes = [r[4] & 0xFFFFFFFFFFFFFFFF for r in own]
            out += [(own[i][5], own[j][5]) for i, j in links_in(codes, free, radius)]
            if len(out) > 100_000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(out: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def simhash_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [signed(fingerprint(t, shingle)) for t in strings(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(codes, pa.int64())], ["doc_id", "fp"])

    rows = saved(texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long"), "fingerprints")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "distinct-fingerprints")
    joined = components(shard_links(distinct.filter("rep is not null").select("fp", "rep"), radius))
    classes = distinct.join(joined.withColumnRenamed("node", "rep"), "rep", "left").filter("n > 1 or component is not null")
    classes = saved(classes.select("fp", "n", F.coalesce("component", "rep").alias("component")), "fingerprint-classes")
    found = join_hot(rows, classes, "fp", "n", rows.count())
    component = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component.alias("component_id"))


def op2_simhash(spark, sf: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, at most 2 differing bits."""
    return simhash_groups(spark.read.parquet(f"{sf}/documents.parquet"))
