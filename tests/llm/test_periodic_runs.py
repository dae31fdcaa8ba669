"""Periodic runs against a plain search of every lag."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF
from tests.llm.test_operators import CLASHES, HARD, bag
from tests.llm.test_parts import TWINS
from tidemark.llm import periodic_runs as runs_module
from tidemark.llm.common import utf8
from tidemark.llm.periodic_runs import find, op12_periodic_runs, periodic_runs, planted, words_of
from tidemark.llm.queries import QUERIES


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def plain_runs(w, least=6):
    """(start, length, period): for every lag the stretches of equal words, without those of a smaller period."""
    names = {x: k for k, x in enumerate(dict.fromkeys(w))}
    code, out = np.array([names[x] for x in w]), set()
    for q in range(1, len(w) // 4 + 1):
        step = np.diff(np.concatenate(([0], (code[:-q] == code[q:]).astype(int), [0])))
        for i, j in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            own = code[i : j + q]
            if len(own) >= max(least, 4 * q) and not any((own[d:] == own[:-d]).all() for d in range(1, q)):
                out.add((i, len(own), q))
    return sorted(out)


def plain_planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collapsed(w, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


def digest(doc_id, w):
    runs = plain_runs(w)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs)).hexdigest()


def found(texts, least=6):
    offsets, data = utf8(pa.array(texts))
    got = [[] for _ in texts]
    for doc, *run in find(*words_of(offsets, data), least):
        got[doc].append(tuple(run))
    return got


def test_runs_of_random_texts():
    rng = random.Random(3)
    for _ in range(120):
        texts = []
        for _ in range(rng.randint(1, 5)):
            w = []
            while len(w) < rng.randint(0, 90):
                part = [rng.choice("abc") for _ in range(rng.randint(1, 8))]
                w += part * rng.choice([1, 1, 2, 3, 4, 5, 9]) + part[: rng.randint(0, len(part))]
            texts.append(rng.choice([" ", "\n\t", "  "]).join(w))
        assert found(texts) == [plain_runs(plain_words(t)) for t in texts]
        assert found(texts, 12) == [plain_runs(plain_words(t), 12) for t in texts]


def test_runs_of_fibonacci_words_and_powers():
    a, b = "a", "a b"
    for _ in range(9):
        a, b = b, b + " " + a
    texts = [b, " ".join([b] * 5), "x " * 700, "x y " * 300 + "x x x x x x", f"{TWINS[0]} {TWINS[1]} " * 2 + TWINS[0], f"{TWINS[0]} {TWINS[1]} " * 4]
    got = found(texts)
    assert got == [plain_runs(plain_words(t)) for t in texts] and not got[4] and got[5] == [(0, 8, 2)]


def test_a_stretch_is_walked_once(monkeypatch):
    calls = []
    own = runs_module._equal
    monkeypatch.setattr(runs_module, "_equal", lambda *a: calls.append(a) or own(*a))
    assert found(["a b c d e f g " * 3000]) == [[(0, 21_000, 7)]]
    assert len(calls) == 2


@pytest.fixture(scope="module")
def hard(spark):
    names = ", ".join(f"{c} int" for c in (*CLASHES, "w", "a", "p", "g", "runs", "collapsed", "best"))
    more = [(i, " ".join(f"w{k % (40 + i)}" for k in range(200 + i))) for i in range(100, 160)]
    rows = [*HARD, *more, (30, TWINS[0]), (31, "x " * 9), (31, "x " * 9), (-7, "a b c " * 20), (200, "  ")]
    return spark.createDataFrame([(*r, *[7] * (len(CLASHES) + 7)) for r in rows], f"doc_id long, text string, {names}").repartition(3)


def test_operator_on_hard_rows(hard):
    want = Counter()
    for doc_id, text in hard.select("doc_id", "text").collect():
        w = plain_words(text)
        if len(w) < 3000:
            runs = plain_runs(w)
            want[doc_id, len(w), tuple(runs), collapsed(w, runs).decode()] += 1
    got = periodic_runs(hard).filter("n_words < 3000").collect()
    assert Counter((d, n, tuple(tuple(r) for r in runs), text) for d, n, runs, text in got) == want
    assert periodic_runs(hard.limit(0)).count() == 0


def test_query_equals_the_plain_version(spark, hard, tmp_path):
    small = hard.filter("text is null or length(text) < 20000")
    small.write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter(digest(d, plain_planted(d, plain_words(t))) for d, t in small.select("doc_id", "text").collect())
    got = op12_periodic_runs(spark, str(tmp_path))
    assert bag(got) == want and any(r[1] for r in want)
    kinds = dict(got.dtypes)
    assert kinds.pop("runs_sha256") == kinds.pop("collapsed_sha256") == "string" and set(kinds.values()) == {"bigint"}


def test_query_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert len(out) == len(docs)
    for doc_id, text in docs:
        w = plain_planted(doc_id, plain_words(text))
        if len(w) < 1500:
            assert out[doc_id] == digest(doc_id, w)


def test_only_chosen_texts_are_changed(hard):
    own = bag(hard.select("doc_id", "text"))
    for r, n in bag(planted(hard.select("doc_id", "text"))).items():
        assert own[r] == n or (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0)
