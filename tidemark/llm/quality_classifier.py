"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Document statistics (shares of kinds of characters, word lengths, repetition, lines) are computed in numpy over Arrow
batches and written once. They are standardised by mean and spread over all documents; cosines of random projections
approximate a Gaussian kernel; every task sums its part of the normal equations over its labelled rows, the parts are summed
row by row of the matrix, and one matrix of fixed size is solved on the driver. Scores of labelled rows that the
ridge did not see are put in 4096 bins, and pooling of adjacent violators on the bins gives a rising map to
probabilities. Labels choose and weigh training rows only; ids, language and source are no inputs.

Folds: crc32 of the doc_id as text, modulo 5. 0 is held out, 4 calibrates, the others fit.

Defined cases: a null or empty text has statistics of zero and is scored; a doc_id of null is never labelled, and is not
held out; each label row counts, whatever repeats; null labels don't count; without any label of one
of the folds all scores are the mean label, 0.5 if there is none; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORDS, Words, mix, pieces, saved, tasks, texts, utf8

FOLDS, HELD_OUT, CALIBRATES = 5, 0, 4
THRESHOLD, BINS = 0.3, 4096
NAMES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "long_words", "short_words", "upper", "lower", "digit",
    "symbols", "marks", "bars", "stops", "other_ascii", "wide", "blank", "upper_words", "symbol_words", "bare_symbol_words",
    "distinct_words", "equal_neighbours", "equal_pairs", "top_length", "lines", "line_words", "stop_words_end",
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


KINDS = {
    "upper": _table(bytes(range(65, 91))), "lower": _table(bytes(range(97, 123))), "digit": _table(b"0123456789"),
    "symbols": _table(b"#*$%&<>@^~=+_\\"), "marks": _table(b"!?"), "bars": _table(b"|"), "stops": _table(b".,;:"),
    "other_ascii": _table(b"\"'()-/[]{}`"), "wide": np.arange(256) >= 0xC0, "blank": _table(b" \t\n\v\f\r"),
}
LETTERS = _table(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def statistics(text: pa.Array) -> np.ndarray:
    """A row of statistics per text."""
    offsets, data = utf8(text)
    words = Words(offsets, data)
    first, last = int(offsets[0]), int(offsets[-1])
    n = len(offsets) - 1
    part, own = data[first:last], offsets - first
    size = np.diff(own).astype(float)
    out = {k: np.zeros(n) for k in NAMES}

    def running(values: np.ndarray) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(values)))

    def share(values: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """Mean over the words of each text of a value per word."""
        total = running(values)
        return (total[words.bounds[1:]] - total[words.bounds[:-1]]) / np.maximum(words.counts if of is None else of, 1)

    for kind, table in KINDS.items():
        total = running(table[part])
        out[kind] = (total[own[1:]] - total[own[:-1]]) / np.maximum(size, 1)
    length = (words.end - words.start).astype(float)
    inner = lambda table: (lambda t: t[words.end - first] - t[words.start - first])(running(table[part]))
    out["log_bytes"], out["log_words"] = np.log1p(size), np.log1p(words.counts)
    out["word_length"] = share(length)
    out["word_length_spread"] = np.sqrt(np.maximum(share(length**2) - out["word_length"] ** 2, 0))
    out["long_words"], out["short_words"] = share(length > 15), share(length < 3)
    upper, letters, symbols = inner(KINDS["upper"]), inner(LETTERS), inner(KINDS["symbols"])
    out["upper_words"] = share((upper > 1) & (2 * upper > length))
    out["symbol_words"], out["bare_symbol_words"] = share(symbols > 0), share(letters == 0)
    key = mix(words.hash ^ mix(words.text.astype(np.uint64) + np.uint64(1)))
    if len(words):
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), bool)
        new[order[1:]] = key[order[1:]] != key[order[:-1]]
        out["distinct_words"] = share(new)
        same = np.zeros(len(key), bool)
        same[1:] = key[1:] == key[:-1]
        out["equal_neighbours"] = share(same)
        second = np.zeros(len(key), bool)
        second[2:] = key[2:] == key[:-2]
        out["equal_pairs"] = share(second)
        out["top_length"] = np.log1p(np.maximum.reduceat(np.append(length, 0), np.minimum(words.bounds[:-1], len(length)))) * (words.counts > 0)
        ends = KINDS["stops"][data[words.end - 1]]
        out["stop_words_end"] = share(ends)
    lines = running(part == 10)
    count = lines[own[1:]] - lines[own[:-1]]
    out["lines"] = count / np.maximum(words.counts, 1)
    out["line_words"] = np.log1p(words.counts / (count + 1))
    return np.stack([out[k] for k in NAMES], 1)


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    projection: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features of the standardised statistics, and a constant."""
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.sqrt(2 / len(self.shift)) * np.cos(z @ self.projection + self.shift)
        return np.hstack([np.ones((len(x), 1)), waves])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.clip(self.raw(x), 0, 1)
        return np.clip(np.interp(self.raw(x), self.knots, self.levels), 0, 1)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest rising sequence, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist()):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def fold():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of every row, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, _ = utf8(batch["text"])
            for lo, hi in pieces(offsets):
                x = statistics(batch["text"].slice(lo, hi - lo)).astype(np.float32)
                at = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], ["doc_id", "x"]
                )

    return saved(texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, x array<float>"), "statistics")


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch["x"]
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(NAMES)).astype(float)


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each statistic over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, np.zeros(len(NAMES)), np.zeros(len(NAMES))
        for batch in batches:
            x = matrix(batch)
            n, s, q = n + len(x), s + x.sum(0), q + (x**2).sum(0)
        k = np.arange(len(NAMES))
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.full(len(k), n)), pa.array(s), pa.array(q)], ["k", "n", "s", "q"])

    parts = rows.select("x").mapInArrow(run, "k long, n long, s double, q double")
    sums = parts.groupBy("k").agg(F.sum("n"), F.sum("s"), F.sum("q")).orderBy("k").collect()  # a row per statistic
    if not sums or not sums[0][1]:
        return np.zeros(len(NAMES)), np.ones(len(NAMES))
    n, s, q = (np.array([r[c] for r in sums], float) for c in (1, 2, 3))
    spread = np.sqrt(np.maximum(q / n - (s / n) ** 2, 0))
    return s / n, np.where(spread > 1e-9, spread, 1)


def fit(rows: DataFrame, labels: DataFrame, features: int = 256, width: float = 5.0, ridge: float = 1e-3, seed: int = 7) -> Model:
    """The model of labelled rows; ``width`` is the kernel's, in units of the standardised statistics."""
    mean, spread = moments(rows)
    rng = np.random.default_rng(seed)
    model = Model(
        mean, spread, rng.standard_normal((len(NAMES), features)) / width, rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), np.zeros(0), np.zeros(0),
    )
    marks = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("double").alias("y"))
    n = tasks(rows.sparkSession)
    known = rows.join(marks.filter("y is not null"), "doc_id").filter(fold() != HELD_OUT)
    known = saved(known.select("doc_id", "x", "y", fold().alias("fold")), "labelled")
    size = features + 2  # the last column is the label

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            z = np.hstack([model.features(matrix(batch)), batch["y"].to_numpy()[:, None]])
            total += z.T @ z
        at = pa.array(np.arange(0, size * size + 1, size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.ListArray.from_arrays(at, pa.array(total.ravel()))], ["row", "sums"]
        )

    def together(table: pa.Table) -> pa.Table:
        sums = table["sums"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        whole = sums[np.lexsort(sums.T[:2])].sum(0)  # in one order, whatever the order of arrival
        return pa.table({"row": table["row"].slice(0, 1), "sums": pa.array([whole.tolist()])})

    fitted = known.filter(F.col("fold") != CALIBRATES).repartition(n, "doc_id").select("x", "y")
    parts = fitted.mapInArrow(add_up, "row long, sums array<double>")
    sums = parts.groupBy("row").applyInArrow(together, "row long, sums array<double>").orderBy("row").collect()  # fixed size
    a = np.array([r["sums"] for r in sums])
    if not len(a) or not a[0, 0]:
        return model._replace(weights=np.concatenate(([0.5], np.zeros(features))))
    penalty = np.full(size - 1, ridge * a[0, 0])
    penalty[0] = 0
    weights = np.linalg.solve(a[:-1, :-1] + np.diag(penalty) + 1e-9 * np.eye(size - 1), a[:-1, -1])
    model = model._replace(weights=weights)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.floor((np.clip(model.raw(matrix(batch)), -0.5, 1.5) + 0.5) / 2 * (BINS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(k), batch["y"]], ["bin", "y"])

    scored = known.filter(F.col("fold") == CALIBRATES).select("x", "y").mapInArrow(bins, "bin long, y double")
    seen = scored.groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("bin").collect()  # BINS rows at most
    if not seen:
        return model
    levels = isotonic(np.array([r["y"] for r in seen]), np.array([float(r["n"]) for r in seen]))
    return model._replace(knots=(np.array([r["bin"] for r in seen]) + 0.5) / (BINS - 1) * 2 - 0.5, levels=levels)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = document_statistics(docs, id_col, text_col)
    model = fit(rows, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.score(matrix(batch)))], ["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op3_quality_classifier(spark, sf: str) -> DataFrame:
    """Quality score of every document, learnt from the labels outside the held-out fold."""
    return classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
