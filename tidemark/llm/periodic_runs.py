"""Periodic runs: stretches of words that repeat with some period four times or more, found by seeds on diagonals.

A run of period q has at least 3q words that are equal to the words q places on. So of periods from 2^j to 2^(j+1) - 1, every
run has a gram of 3 * 2^j words that stands again q places on, and this gram is as long as the period, so no place between
the two can hold it as well unless the run has a smaller period. Seeds are therefore pairs of neighbouring places of one gram in
one document, at most one for each place and class of periods; no other pairs are made. Grams have exact names: a gram of
twice the length is named by the names of its halves, and only places whose halves are repeated go on to the next class.

Seeds lie on diagonals, by their distance. Along a diagonal a seed that the furthest stretch so far already covers is
left out; any other is extended to both sides as long as words are equal, and the table of the furthest place per distance is
brought up to date. So each stretch is walked once.

Texts are worked through in numpy, many at a time, each whole; documents need nothing from one another, so nothing is shuffled.

Defined cases: null and blank texts have no words and no runs; every row gives one row, repeated rows and null ids too; runs
that overlap are all reported, by start and then period; a word goes from the collapsed text if any run holds it after its first
period; a run is at least ``least`` words long; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.llm.common import BLANK, pieces, texts, utf8
from tidemark.llm.pretokens import numbered, slices

#: A run has at least this many words, and this many times its period.
LEAST, TIMES = 6, 4
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", RUNS), ("collapsed", pa.string())])


def words_of(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word among the distinct ones, its text, first word of each text) of texts one after another."""
    word = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = word & (edge[:-1] | ~np.append(False, word[:-1]))
    first = np.flatnonzero(start)
    place = np.cumsum(word)  # in the bytes of words alone
    number, _ = numbered(slices(np.append(place[first] - 1, place[-1] if len(place) else 0), data[word]))
    bounds = np.searchsorted(first, offsets)
    return number.astype(np.int64), np.repeat(np.arange(len(offsets) - 1), np.diff(bounds)), bounds


def _dense(key: np.ndarray) -> np.ndarray:
    return np.unique(key, return_inverse=True)[1]


def seeds(number: np.ndarray, text: np.ndarray, stop: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(gram length, places, distances) by class of periods. ``stop`` is the end of the text of each place."""
    n = len(number)
    if n < 3:
        return
    most = int(number.max()) + 1
    pair = number[:-1] * most + number[1:]
    at = np.flatnonzero(stop[: n - 2] >= np.arange(3, n + 1))
    key = (_dense(pair) if most**3 >= 1 << 62 else pair)[at] * most + number[at + 2]
    k, low, name = 3, 1, np.full(n, -1, np.int64)
    while len(at):
        order = np.argsort(key, kind="stable")  # by place within a gram
        own, here = key[order], at[order]
        same = (own[1:] == own[:-1]) & (text[here[1:]] == text[here[:-1]])
        place, lag = here[:-1][same], (here[1:] - here[:-1])[same]
        wanted = (lag >= low) & (lag < 2 * low)
        if wanted.any():
            yield k, place[wanted], lag[wanted]
        again = np.append(False, same) | np.append(same, False)
        name[:] = -1
        name[here[again]] = np.append(0, np.cumsum(own[1:] != own[:-1]))[again]
        at = np.sort(here[again])
        at = at[at + 2 * k <= stop[at]]
        at = at[name[at + k] >= 0]
        key = name[at] * n + name[at + k]
        k, low = 2 * k, 2 * low


def _equal(number: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many places from a and b on (step 1) or before them (step -1) are equal, ``most`` at the most."""
    done, size = 0, 16
    while done < most:
        size = min(2 * size, most - done)
        one, two = (number[x + done : x + done + size] if step > 0 else number[x - done - size : x - done][::-1] for x in (a, b))
        differ = np.flatnonzero(one != two)
        if len(differ):
            return done + int(differ[0])
        done += size
    return done


def find(number: np.ndarray, text: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs, in this order; starts count from the first word of a text."""
    stop, out = bounds[1:][text], []
    for k, place, lag in seeds(number, text, stop):
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # a seed right behind another on its diagonal is covered by what that one extends to
        new = np.append(True, (place[1:] != place[:-1] + 1) | (lag[1:] != lag[:-1]))
        furthest: dict[int, int] = {}
        for i, q in zip(place[new].tolist(), lag[new].tolist()):
            if i < furthest.get(q, 0):
                continue
            own, end = int(bounds[text[i]]), int(stop[i])
            first = i - _equal(number, i, i + q, i - own, -1)
            last = i + k + _equal(number, i + k, i + k + q, end - i - k - q, 1)
            furthest[q] = last
            length = last + q - first
            if length >= max(least, TIMES * q):
                out.append((int(text[i]), first - own, length, q))
    return sorted(out)


def measure(ids: pa.Array, text: pa.Array, least: int) -> pa.RecordBatch:
    offsets, data = utf8(text)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    number, of, bounds = words_of(offsets, data)
    found: list[list[dict]] = [[] for _ in range(len(ids))]
    gone = np.zeros(len(number) + 1, np.int64)
    for doc, start, length, period in find(number, of, bounds, least):
        found[doc].append({"start": start, "length": length, "period": period})
        gone[bounds[doc] + start + period] += 1
        gone[bounds[doc] + start + length] -= 1
    kept, raw, collapsed = np.cumsum(gone[:-1]) == 0, data.tobytes(), []
    for doc, (lo, hi) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        words = raw[lo:hi].split()  # bytes are split at the same blanks
        if found[doc]:
            words = [w for w, k in zip(words, kept[bounds[doc] : bounds[doc + 1]].tolist()) if k]
        collapsed.append(b" ".join(words))
    columns = [ids, pa.array(np.diff(bounds)), pa.array(found, RUNS), pa.array(collapsed, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: its runs, and its words without what repeats in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, _ = utf8(batch["text"])
            for lo, hi in pieces(offsets):
                yield measure(batch["doc_id"].slice(lo, hi - lo), batch["text"].slice(lo, hi - lo), least)

    return texts(docs, id_col, text_col).mapInArrow(run, from_arrow_schema(SCHEMA))


def planted(docs: DataFrame) -> DataFrame:
    """The documents, with a stretch at the end of about every tenth one (by the crc32 of its id; none without an id) made periodic."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    hashed = hashed.withColumn("w", F.when(chosen, words)).withColumn("g", F.expr("h div 10"))
    n = F.size("w").cast("long")
    begin = hashed.withColumn("a", F.when(n > 0, F.col("g") % n))
    cut = begin.withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    moved = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("w", source(i).cast("int")))
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The runs of every document, the one with the greatest exponent, and digests of all runs and of the collapsed text."""
    found = periodic_runs(planted(texts(spark.read.parquet(f"{sf}/documents.parquet"))))
    better = lambda b, r: r["length"] * b["period"] > b["length"] * r["period"]  # noqa: E731 runs come by start, period
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(better(b, r), r).otherwise(b))
    found = found.withColumn("best", best)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
