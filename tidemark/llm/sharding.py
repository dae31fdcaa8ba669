"""Sharding: groups of equal texts into a fixed number of shards, by best-fit-decreasing bin packing.

Rows of equal text are one indivisible group. Groups of at least 1/(64 * shards) of all bytes are
items of their own (at most 64 * shards of them); smaller ones are dealt by a hash of the text into
``packets`` items. This bounded list of items is packed: sorted by size, each into the shard with the
tightest room that still takes it, found in a balanced tree. The capacity is the smallest that
needs no more shards than asked for. A group above the even share has a shard to itself, and the
others share the rest evenly.

Defined cases: a null text is an empty one, so both are one group; repeated rows each get a slot; a
null doc_id comes first within its cell; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from zlib import crc32

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, texts

#: Bytes counted for a row beside its text.
ROW_BYTES = 16


class Tree:
    """A balanced search tree (treap) of (room, shard) pairs."""

    def __init__(self) -> None:
        self.root: list | None = None

    def _split(self, node, key):
        """Parts below the key, and from it on."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return [a[0], a[1], a[2], self._merge(a[3], b)]
        return [b[0], b[1], self._merge(a, b[2]), b[3]]

    def add(self, room: int, shard: int) -> None:
        low, high = self._split(self.root, (room, shard))
        priority = crc32(b"%d %d" % (room, shard))
        self.root = self._merge(self._merge(low, [(room, shard), priority, None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the pair with the least room that is at least ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        node = high
        while node[2] is not None:
            node = node[2]
        key = node[0]
        _, rest = self._split(high, (key[0], key[1] + 1))
        self.root = self._merge(low, rest)
        return key


def pack_bins(sizes: list[int], capacity: int, most: int) -> list[int] | None:
    """Best fit for sizes in falling order; None if over ``most`` bins of ``capacity`` are needed."""
    tree, used, out = Tree(), 0, []
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            if used == most or size > capacity:
                return None
            found, used = (capacity, used), used + 1
        tree.add(found[0] - size, found[1])
        out.append(found[1])
    return out


def place(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size, for sizes in falling order, with the least capacity that suffices."""
    total, alone, out = sum(sizes), 0, []
    while alone < len(sizes) and alone < shards - 1 and sizes[alone] * (shards - alone) > total:
        out.append(alone)
        total -= sizes[alone]
        alone += 1
    rest, bins = sizes[alone:], shards - alone
    if not rest:
        return out
    low = max(rest[0], -(-total // bins))
    high = low
    while (best := pack_bins(rest, high, bins)) is None:
        low, high = high + 1, high + max(1, high // 64)
    while low < high and high - low > max(1, low // 100_000):
        middle = (low + high) // 2
        if (got := pack_bins(rest, middle, bins)) is None:
            low = middle + 1
        else:
            best, high = got, middle
    return out + [alone + b for b in best]


def shard(
    docs: DataFrame, shards: int = 40, packets: int = 4096, cell_rows: int = 1000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row; slots count from 0 in each shard."""
    text = F.coalesce("text", F.lit(""))
    rows = saved(
        texts(docs, id_col, text_col).select(
            "doc_id",
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
        ),
        "shard-rows",
    )
    spark, key = docs.sparkSession, ["h", "text_crc32", "size"]
    groups = rows.groupBy(*key).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    # Groups that the hash and checksum cannot tell apart would only share a shard.
    large = groups.withColumn("large", F.col("bytes") * F.lit(64 * shards) >= F.lit(total))
    packet = F.pmod(F.col("h"), F.lit(packets))
    items = (
        large.groupBy(
            F.when(~F.col("large"), packet).alias("packet"),
            *[F.when(F.col("large"), F.col(k)).alias(k) for k in key],
        )
        .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        .collect()
    )  # at most packets + 64 * shards rows
    items.sort(key=lambda r: (-r["bytes"], r["h"] or 0, r["packet"] or 0))
    to = place([r["bytes"] for r in items], shards)
    kind = "item int, packet long, h long, text_crc32 long, size long, shard int, cells int"
    plan = [
        (i, r["packet"], r["h"], r["text_crc32"], r["size"], s, math.ceil(r["rows"] / cell_rows))
        for i, (r, s) in enumerate(zip(items, to))
    ]
    planned = spark.createDataFrame(plan, kind)
    own = planned.filter("packet is null").select(*key, *[F.col(c).alias(f"own_{c}") for c in ("item", "shard", "cells")])
    shared = planned.filter("packet is not null").select("packet", "item", "shard", "cells")
    either = [F.coalesce(f"own_{c}", c).alias(c) for c in ("item", "shard", "cells")]
    dealt = (
        rows.withColumn("packet", packet)
        .join(F.broadcast(own), key, "left")
        .join(F.broadcast(shared), "packet", "left")
        .select("doc_id", "size", "text_crc32", *either)
        .withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells")))
    )
    ahead = Window.partitionBy("shard").orderBy("item", "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        dealt.groupBy("shard", "item", "cell")
        .agg(F.count("*").alias("rows"))
        .select("item", "cell", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("ahead"))
    )
    inside = Window.partitionBy("item", "cell").orderBy("doc_id", "size", "text_crc32")
    return (
        dealt.withColumn("place", F.row_number().over(inside) - 1)
        .join(cells, ["item", "cell"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("ahead") + F.col("place")).alias("slot"))
    )


def op10_shard(spark, sf: str) -> DataFrame:
    """Shards 0 to 39 of near-equal bytes over all documents."""
    return shard(spark.read.parquet(f"{sf}/documents.parquet")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
