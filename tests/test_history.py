"""Validity intervals and the as-of join against plain versions."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators.history import as_of, changed_columns, history

START = datetime(2024, 1, 1)


def at(n):
    return None if n is None else START + timedelta(hours=n)


def changes(spark, data):
    return spark.createDataFrame([(k, at(t), a, b, n) for n, (k, t, a, b) in enumerate(data)], "k int, t timestamp_ntz, a string, b int, n int")


def test_versions(spark, rows):
    data = [
        (1, 0, "x", 1), (1, 5, "x", 1), (1, 9, "y", 1), (1, 12, "y", None), (1, 13, "y", None), (1, 20, "x", 1),
        (2, 3, None, None), (2, 4, None, None), (None, 1, "x", 1), (3, None, "x", 1), (4, 7, "p", 1), (4, 7, "q", 2),
    ]
    out = history(changes(spark, data), ["k"], "t", ["a", "b"], ["n"])
    assert rows(out) == sorted([
        (1, at(0), "x", 1, at(9), False), (1, at(9), "y", 1, at(12), False), (1, at(12), "y", None, at(20), False), (1, at(20), "x", 1, None, True),
        (2, at(3), None, None, None, True), (4, at(7), "q", 2, None, True),
    ], key=str)
    said = out.select("k", "valid_from", changed_columns(out, ["k"], ["a", "b"]).alias("c"))
    assert rows(said.filter("k = 1"), "c") == sorted([([],), (["a"],), (["b"],), (["a", "b"],)], key=str)
    # replays and copies make no versions
    twice = changes(spark, data).unionByName(changes(spark, data))
    assert rows(history(twice, ["k"], "t", ["a", "b"], ["n"])) == rows(out)
    assert history(changes(spark, []), ["k"], "t").count() == 0


@pytest.mark.parametrize("width", ["1 hour", "7 hours", "400 days"])
def test_as_of(spark, rows, width):
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2, 3]), rng.randint(-50, 300), rng.choice("xyz"), rng.randint(0, 2)) for _ in range(60)]
    versions = history(changes(spark, data), ["k"], "t", ["a", "b"], ["n"])
    known = [(r["k"], r["valid_from"], r["valid_to"], r["a"], r["b"]) for r in versions.collect()]
    facts = [(rng.choice([1, 2, 3, 4, None]), rng.choice([None, *range(-60, 320)]), n) for n in range(200)] + [(1, 10, 0), (1, 10, 0)]
    want = []
    for k, t, n in facts:
        found = [(a, b) for key, since, until, a, b in known if k == key and t is not None and since <= at(t) and (until is None or at(t) < until)]
        assert len(found) <= 1
        want.append((k, at(t), n, *(found[0] if found else (None, None))))
    given = spark.createDataFrame([(k, at(t), n) for k, t, n in facts], "k int, happened timestamp_ntz, n int")
    assert rows(as_of(given, versions, ["k"], "happened", ["a", "b"], width)) == sorted(want, key=str)
    assert as_of(given, versions.limit(0), ["k"], "happened", ["a"]).filter("a is not null").count() == 0
    assert as_of(given.limit(0), versions, ["k"], "happened", ["a"]).count() == 0
