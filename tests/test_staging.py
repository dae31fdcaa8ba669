"""Staging tables: merges equal a full recompute, however they are cut and carried out."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.cdc import stamp
from tidemark.operators.dedupe import dedupe_latest
from tidemark.sources import staging as module
from tidemark.sources.staging import BUCKET, StagingTable
from tidemark.sources.storage import VersionTaken, child_names, publish

START = datetime(2025, 11, 5)
SCHEMA = "k int, seq int, v string"


def hour(n):
    return START + timedelta(hours=n)


def load(spark, data, n, schema=SCHEMA):
    return stamp(spark.createDataFrame(data, schema), hour(n))


@pytest.fixture(params=["broadcast", "shuffle"])
def way(request, setting):
    """Both ways of a merge, for small increments and for large ones."""
    if request.param == "shuffle":
        setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    return request.param


@pytest.fixture
def table(spark, tmp_path):
    return StagingTable(spark, f"{tmp_path}/staging", ["k"], buckets=5)


@pytest.mark.parametrize("seed", range(1))
@pytest.mark.parametrize("keep_newer", [False, True])
def test_merges_equal_a_recompute(spark, table, rows, way, seed, keep_newer):
    rng = random.Random(seed)
    loads = [[(rng.randrange(30), rng.randrange(6), rng.choice("abc")) for _ in range(40)] for _ in range(3)]
    everything = None
    for n, data in enumerate(loads):
        df = load(spark, data, n)
        everything = df if everything is None else everything.unionByName(df)
        before = 0 if n == 0 else table.read().count()
        done = table.merge(df, ["seq"], keep_newer)
        assert done.high_mark == table.high_mark() == hour(n)
        assert table.read().count() == before + done.inserted
        assert done.updated + done.inserted == len({k for k, _, _ in data})
    assert rows(table.read()) == rows(dedupe_latest(everything, ["k"], ["insert_timestamp", "seq"]))


def test_same_merge_twice_changes_nothing(spark, table, rows, way):
    df = load(spark, [(1, 1, "a"), (2, 1, "b")], 0)
    table.merge(df, ["seq"])
    once = rows(table.read())
    done = table.merge(df, ["seq"])
    assert rows(table.read()) == once and (done.updated, done.inserted) == (2, 0)


def test_old_load_wins_only_without_keep_newer(spark, table, rows, way):
    table.merge(load(spark, [(1, 1, "new")], 5))
    table.merge(load(spark, [(1, 9, "old")], 1), keep_newer=True)
    assert rows(table.read(), "v") == [("new",)]
    table.merge(load(spark, [(1, 9, "old")], 1))
    assert rows(table.read(), "v") == [("old",)] and table.high_mark() == hour(5)


def test_null_keys_are_rejected_and_counted(spark, table, rows, way):
    done = table.merge(load(spark, [(None, 1, "x"), (None, 2, "y"), (1, 1, "a")], 0))
    assert (done.inserted, done.rejected) == (1, 2)
    done = table.merge(load(spark, [(None, 1, "x")], 1))
    assert (done.inserted, done.rejected, done.high_mark) == (0, 1, hour(1))
    assert rows(table.read(), "k") == [(1,)]


def test_null_keys_are_inserted_at_each_merge_on_demand(spark, table, rows, way):
    for n in range(3):
        table.merge(load(spark, [(None, 1, "x"), (None, 2, "y"), (1, 1, "a")], n), ["seq"], null_keys="insert")
    assert rows(table.read(), "k", "v") == [(1, "a")] + [(None, "y")] * 3


def test_nothing_to_merge(spark, table):
    assert table.read() is None and table.high_mark() is None
    assert table.merge(load(spark, [], 0)).high_mark is None
    table.merge(load(spark, [(1, 1, "a")], 0))
    assert table.merge(load(spark, [], 1)).high_mark is None
    assert table.read().count() == 1 and table.high_mark() == hour(0)


def test_new_columns_are_null_in_old_rows_and_missing_ones_in_new(spark, table, rows, way):
    table.merge(load(spark, [(k, 1, "a") for k in range(10)], 0))
    table.merge(load(spark, [(3, 2, "b", 7)], 1, SCHEMA + ", extra int"))
    table.merge(load(spark, [(4, 3)], 2, "k int, seq int"))
    got = rows(table.read().filter("k in (2, 3, 4)"), "k", "seq", "extra")
    assert got == [(2, 1, None), (3, 2, 7), (4, 3, None)]


def test_changes_are_old_and_new_rows(spark, table, rows, way):
    assert table.changes(0) is None
    marks = [table.version()]
    loads = [
        ([(1, 1, "a"), (2, 1, "a"), (3, 1, "a")], "k int, seq int, v string"), ([(2, 2, "b"), (4, 2, "b"), (3, 1, "a")], "k int, seq int, v string"),
        ([(5, 3, "c")], "k int, seq bigint, v string"),
    ]
    for n, (data, columns) in enumerate(loads):
        table.merge(load(spark, data, n, columns))
        marks.append(table.version())
    image = ["k", "old.v as was", "new.v as is"]
    got = [rows(table.changes(a, b).selectExpr(*image)) for a, b in zip(marks, marks[1:])]
    assert got[0] == [(1, None, "a"), (2, None, "a"), (3, None, "a")]
    assert got[1] == [(2, "a", "b"), (4, None, "b")]  # 3 came again as it was
    assert got[2] == [(5, None, "c")]  # the type of a column grew, and no other row changed
    assert rows(table.changes(marks[1]).selectExpr(*image)) == [(2, "a", "b"), (4, None, "b"), (5, None, "c")]
    assert table.changes(marks[3]).count() == 0


def test_values_take_the_type_of_the_table(spark, table, rows, way):
    table.merge(load(spark, [(1, 1, "a")], 0))
    table.merge(load(spark, [(1, 2, 30)], 1, "k bigint, seq bigint, v int"))
    # wider numbers make the column wider, numbers in a text column are text
    assert dict(table.read().dtypes)["k"] == "bigint" and rows(table.read(), "k", "seq", "v") == [(1, 2, "30")]


def merges(table):
    """Directories of the table's merges, in order."""
    return [f"{table._data}/{n}" for n in child_names(table.spark, table._data)]


def test_only_touched_buckets_are_written(spark, table, way):
    table.merge(load(spark, [(k, 1, "a") for k in range(50)], 0))
    table.merge(load(spark, [(7, 2, "b")], 1))
    parts = child_names(spark, merges(table)[1])
    assert sum(p.startswith(BUCKET) for p in parts) == 1
    assert table.read().count() == 50


def test_a_crash_before_publishing_changes_nothing(spark, table, rows, way, monkeypatch):
    table.merge(load(spark, [(1, 1, "a")], 0))
    before = rows(table.read())

    def crash(*_):
        raise OSError("lost")

    monkeypatch.setattr(module, "publish", crash)
    with pytest.raises(OSError):
        table.merge(load(spark, [(1, 2, "b"), (2, 1, "c")], 1))
    assert rows(table.read()) == before and table.high_mark() == hour(0)
    monkeypatch.setattr(module, "publish", publish)
    table.merge(load(spark, [(1, 2, "b"), (2, 1, "c")], 1))
    assert rows(table.read(), "k", "v") == [(1, "b"), (2, "c")]


def test_vacuum_deletes_what_no_recent_state_reads(spark, table, rows):
    for n in range(4):
        table.merge(load(spark, [(k, n, "a") for k in range(50)], n))
    want = rows(table.read())
    assert table.vacuum(keep=2) == 10
    assert rows(table.read()) == want
    table.merge(load(spark, [(1, 9, "z")], 9))
    assert table.read().count() == 50


def test_large_merge_shuffles_by_bucket_once(spark, table, setting, monkeypatch):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    write = StagingTable._write

    def spy(self, number, merged, before):
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return write(self, number, merged, before)

    monkeypatch.setattr(StagingTable, "_write", spy)
    table.merge(load(spark, [(k, 1, "a") for k in range(20)], 0))
    table.merge(load(spark, [(k, 2, "a") for k in range(20)], 1))
    assert plans[1].count("Exchange") == 1 and "Join" not in plans[1]


def test_buckets_of_a_first_load(spark, tmp_path, setting, monkeypatch):
    monkeypatch.setattr(module, "MIN_BUCKETS", 1)
    load(spark, [(k, 1, "a" * 20) for k in range(200)], 0).write.parquet(f"{tmp_path}/input")
    rows = spark.read.parquet(f"{tmp_path}/input")
    table = StagingTable(spark, f"{tmp_path}/staging", ["k"])
    table._bucket_bytes = module.planned_bytes(rows) // 10
    for tasks, buckets in ((8, 8), (20, 10), (40, 10), (199, 10), (6, 6), (4, 10)):
        setting("spark.sql.shuffle.partitions", str(tasks))
        assert table._first_buckets(rows) == buckets


def test_first_load_is_shuffled_once_where_tasks_allow(spark, tmp_path, setting, monkeypatch):
    plans = []
    write = StagingTable._write

    def spy(self, number, merged, before):
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return write(self, number, merged, before)

    monkeypatch.setattr(StagingTable, "_write", spy)
    setting("spark.sql.shuffle.partitions", "6")
    for buckets in (3, 5):
        table = StagingTable(spark, f"{tmp_path}/staging-{buckets}", ["k"], buckets)
        table.merge(load(spark, [(k, 1, "a") for k in range(50)], 0))
        assert table.read().count() == 50
        assert sum(n.startswith(BUCKET) for n in child_names(spark, merges(table)[0])) == buckets
    assert [p.count("Exchange") for p in plans] == [1, 2]


def test_large_buckets_are_shared_by_tasks(spark, table, rows, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    table = StagingTable(spark, table.path, ["k"], buckets=5, bucket_bytes=100, max_buckets=5)
    data = [(k, 1, "a" * 20) for k in range(200)]
    load(spark, data, 0).write.parquet(f"{table.path}-input")
    for n in range(2):
        table.merge(stamp(spark.read.parquet(f"{table.path}-input"), hour(n)))
        parts = merges(table)[n]
        files = [f for p in child_names(spark, parts) if p.startswith(BUCKET) for f in child_names(spark, f"{parts}/{p}")]
        assert len(files) > 10
    assert rows(table.read(), "k", "seq", "v", "insert_timestamp") == sorted([(*r, hour(1)) for r in data], key=str)


def test_composite_keys_and_hot_keys(spark, tmp_path, rows, way):
    table = StagingTable(spark, f"{tmp_path}/staging", ["a", "b"])
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"), F.col("id").alias("seq")
    )
    table.merge(stamp(hot, hour(0)), ["seq"])
    done = table.merge(stamp(hot.withColumn("seq", F.col("seq") + 1), hour(1)), ["seq"])
    distinct = hot.select("a", "b").distinct().count()
    assert (done.updated, done.inserted) == (distinct, 0)
    assert rows(table.read().filter("a = 1"), "seq") == [(2998,)]


def test_both_ways_agree_on_all_columns_when_a_load_lacks_some(spark, tmp_path, rows):
    got = []
    for limit in (-1, 1 << 30):
        table = StagingTable(spark, f"{tmp_path}/staging{limit}", ["k"], buckets=3, broadcast_bytes=limit)
        table.merge(load(spark, [(1, 1, "a", "old"), (2, 1, "b", "old")], 0, "k int, seq int, v string, extra string"))
        table.merge(load(spark, [(2, 2, True), (3, 2, True)], 1, "k int, seq int, flag boolean"))
        got.append(rows(table.read(), "k", "seq", "v", "extra", "flag"))
    assert got[0] == got[1] == [(1, 1, "a", "old", None), (2, 2, None, None, True), (3, 2, None, None, True)]


def test_rejected_rows_are_written_aside(spark, table, rows, way):
    table.merge(load(spark, [(1, 1, "a"), (None, 1, "lost"), (None, 2, "lost too")], 0))
    done = table.merge(load(spark, [(2, 1, "b"), (None, 3, "late")], 1))
    assert done.rejected == 1 and rows(table.read(), "k") == [(1,), (2,)]
    assert {r["v"] for r in table.rejects().collect()} == {"late", "lost", "lost too"}


def test_a_load_of_rejects_only_keeps_a_table_that_would_split(spark, table, way):
    table.merge(load(spark, [(k, 1, "a" * 50) for k in range(100)], 0))
    grown = StagingTable(spark, table.path, ["k"], bucket_bytes=50)
    assert grown.merge(load(spark, [(None, 1, "b")], 1)).rejected == 1
    assert grown.read().count() == 100


def test_of_two_writers_one_publishes(spark, table, rows, way, monkeypatch):
    table.merge(load(spark, [(1, 1, "a")], 0))
    write = StagingTable._write

    def slow(self, *args):
        monkeypatch.setattr(StagingTable, "_write", write)
        StagingTable(spark, self.path, ["k"]).merge(load(spark, [(1, 5, "first")], 2))
        return write(self, *args)

    monkeypatch.setattr(StagingTable, "_write", slow)
    with pytest.raises(VersionTaken):
        table.merge(load(spark, [(1, 3, "second"), (2, 3, "second")], 1))
    assert rows(table.read(), "k", "v") == [(1, "first")]
    table.merge(load(spark, [(1, 3, "second"), (2, 3, "second")], 3))
    assert rows(table.read(), "k", "v") == [(1, "second"), (2, "second")]


def test_buckets_double_as_the_table_grows(spark, tmp_path, rows, way):
    table = StagingTable(spark, f"{tmp_path}/staging", ["k"], buckets=2, bucket_bytes=2000)
    seen, want = [], {}
    for n in range(5):
        data = [(k, n, f"{k * 7919 % 10007}-{n}") for k in range(n * 150, n * 150 + 400)]
        want |= {r[0]: r for r in data}
        table.merge(load(spark, data, n))
        seen.append(table._entries()[1][0]["buckets"])
    assert seen[0] == 2 and seen[-1] >= 8 and seen == sorted(seen)
    assert rows(table.read(), "k", "seq", "v") == sorted(want.values(), key=str)
    table.vacuum(keep=1)
    assert table.read().count() == len(want)
