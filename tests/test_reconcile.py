"""Reconciliation by checksums of buckets."""

from collections import Counter
from datetime import datetime

import pytest

from tests.test_jobs import T1, T2, landed
from tidemark.operators.reconcile import checksums, differing_keys
from tidemark.plans.merge import merge_table
from tidemark.plans.reconcile import reconcile_table
from tidemark.sources.staging import StagingTable

SCHEMA = "k int, j string, v double, at timestamp_ntz"


def copy(spark, n=300):
    return [(i, "ab"[i % 2] if i % 7 else None, i / 4, datetime(2024, 1, 1 + i % 28) if i % 5 else None) for i in range(n)]


@pytest.mark.parametrize("fan, levels", [(4, 1), (8, 3), (1024, 2)])
def test_exactly_the_damaged_keys_are_found(spark, rows, fan, levels):
    left = copy(spark)
    right = dict(enumerate(left))
    right[3] = (3, "b", 0.5, right[3][3])  # another value
    right[10] = (*right[10][:3], datetime(2030, 1, 1))  # a value for a NULL
    right[14] = (*right[14][:2], None, right[14][3])  # a NULL for a value; its key has a NULL as well
    del right[50], right[51]
    other = [*right.values(), (999, None, 1.0, None), left[70]]
    frames = [spark.createDataFrame(data, SCHEMA).repartition(n) for n, data in ((3, left), (5, other))]
    found = differing_keys(*frames, ["k", "j"], fan=fan, levels=levels)
    want = [(3, "b", "different"), (10, "a", "different"), (14, None, "different"), (50, "a", "missing_right"), (51, "b", "missing_right"),
            (70, None, "different"), (999, None, "missing_left")]
    assert rows(found) == sorted(want, key=str)
    assert rows(differing_keys(*frames, ["k", "j"], ["v"], fan, levels), "k") == sorted([(k,) for k in (3, 14, 50, 51, 70, 999)], key=str)
    assert differing_keys(frames[0], frames[0].repartition(7).select("at", "v", "k", "j"), ["k", "j"], fan=fan, levels=levels).count() == 0


def test_two_copies_of_a_row_do_not_cancel(spark, rows):
    one, three = (spark.createDataFrame([(1, "x")] * n + [(2, "y")], "k int, v string") for n in (1, 3))
    assert rows(differing_keys(one, three, ["k"])) == [(1, "different")]
    swapped = spark.createDataFrame([(1, "y"), (2, "x")], "k int, v string")
    assert rows(differing_keys(one, swapped, ["k"]), "k") == [(1,), (2,)]


def test_types_may_differ_and_empty_sides_are_missing(spark, rows):
    left = spark.createDataFrame([(1, 2)], "k int, v int")
    assert differing_keys(left, spark.createDataFrame([(1, 2.0)], "k bigint, v double"), ["k"]).count() == 0
    assert rows(differing_keys(left, left.limit(0), ["k"])) == [(1, "missing_right")]
    assert differing_keys(left.limit(0), left.limit(0), ["k"]).count() == 0
    with pytest.raises(TypeError, match="'v'"):
        differing_keys(left, spark.createDataFrame([(1, [2])], "k int, v array<int>"), ["k"])


def test_checksums_do_not_depend_on_order(spark):
    df = spark.createDataFrame(copy(spark), SCHEMA).selectExpr("*", "k % 5 as b")
    sums = [Counter(map(tuple, checksums(df.repartition(n), ["b"], df.columns).collect())) for n in (1, 6)]
    assert sums[0] == sums[1]


def test_source_raw_and_staging(spark, tmp_path, rows):
    raw, staging = f"{tmp_path}/raw", StagingTable(spark, f"{tmp_path}/staging", ["id"])
    source = lambda *data: spark.createDataFrame(list(data), "id int, v string")
    assert rows(reconcile_table(spark, source((1, "a")), raw, staging, ["id"])) == [(1, "source", "raw", "missing_right")]
    landed(spark, raw, T1, (1, "a"), (2, "a"), (None, "x"))
    merge_table(spark, raw, staging)
    landed(spark, raw, T2, (2, "b"), (3, "b"))
    found = reconcile_table(spark, source((1, "a"), (2, "b"), (3, "b"), (4, "d"), (None, "x")), raw, staging, ["id"])
    assert rows(found) == [(2, "raw", "staging", "different"), (3, "raw", "staging", "missing_right"), (4, "source", "raw", "missing_right")]
    merge_table(spark, raw, staging)
    assert rows(reconcile_table(spark, source((1, "a"), (2, "b"), (3, "b")), raw, staging, ["id"])) == []
