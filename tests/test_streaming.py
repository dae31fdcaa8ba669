"""Streams: merge with replays, copies removed, running newest row."""

import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from tidemark.operators.cdc import stamp
from tidemark.sources.raw import write_raw
from tidemark.sources.staging import StagingTable
from tidemark.sources.storage import child_names
from tidemark.streaming import merge as module
from tidemark.streaming.merge import (
    raw_stream,
    read_deduped,
    read_updates,
    run_deduped,
    run_to_files,
    run_updates,
    stream_dedupe,
    stream_latest,
    stream_merge,
)

START = datetime(2025, 11, 5, 6)
SCHEMA = "k int, ts timestamp_ntz, v string"


def minute(n):
    return START + timedelta(minutes=n)


@pytest.fixture
def feed(spark, tmp_path):
    class Feed:
        path, base = f"{tmp_path}/raw", str(tmp_path)

        def land(self, data, at):
            df = spark.createDataFrame([(k, minute(m), v) for k, m, v in data], SCHEMA)
            before = {*Path(self.path).rglob("*.parquet")}
            write_raw(stamp(df, at), self.path, at, "append")
            # A row has a file of its own, and tasks that write at once end in any order: the last row's comes first.
            files = sorted({*Path(self.path).rglob("*.parquet")} - before, reverse=True)
            first = min(f.stat().st_mtime_ns for f in files)
            for k, file in enumerate(files):
                os.utime(file, ns=(first + k * 2_000_000,) * 2)

        def stream(self, **kw):
            schema = stamp(spark.createDataFrame([], SCHEMA), START).schema
            return raw_stream(spark, self.path, schema, **kw)

    return Feed()


def test_merge_follows_the_files(spark, feed, rows):
    staging = StagingTable(spark, f"{feed.base}/staging", ["k"])
    feed.land([(1, 0, "a"), (2, 0, "a"), (1, 1, "b")], minute(2))
    stream_merge(feed.stream(), staging, f"{feed.base}/cp", ["ts"]).awaitTermination()
    feed.land([(2, 5, "c"), (3, 5, "c")], minute(6))
    feed.land([(1, 0, "late")], minute(1))
    stream_merge(feed.stream(max_files=1), staging, f"{feed.base}/cp", ["ts"]).awaitTermination()
    # The file that came last is older by its stamp: it was not passed over, and lost.
    assert rows(staging.read(), "k", "v") == [(1, "b"), (2, "c"), (3, "c")]


def test_merged_batches_leave_no_old_buckets(spark, feed):
    staging = StagingTable(spark, f"{feed.base}/staging", ["k"], buckets=1)
    for n in range(5):
        feed.land([(1, n, "a")], minute(n))
    stream_merge(feed.stream(max_files=1), staging, f"{feed.base}/cp", ["ts"], keep_states=2).awaitTermination()
    assert len(child_names(spark, f"{feed.base}/staging/data")) == 2


def test_replay_of_all_files_changes_nothing(spark, feed, rows):
    staging = StagingTable(spark, f"{feed.base}/staging", ["k"])
    for n in range(3):
        feed.land([(1, n, "a"), (n, n, "b")], minute(n))
    stream_merge(feed.stream(), staging, f"{feed.base}/cp1", ["ts"]).awaitTermination()
    once = rows(staging.read())
    stream_merge(feed.stream(max_files=1), staging, f"{feed.base}/cp2", ["ts"]).awaitTermination()
    assert rows(staging.read()) == once


@pytest.mark.parametrize("salts", [1, 4])
def test_copies_within_the_delay_go(spark, feed, rows, salts):
    for at, data in (
        (minute(10), [(1, 0, "a"), (1, 0, "a"), (2, 9, "a")]),
        (minute(20), [(2, 9, "a"), (3, 15, "a"), (3, 15, "a"), (3, 15, "a")]),
        (minute(60), [(4, 59, "a"), (3, 15, "a")]),
    ):
        feed.land(data, at)
        deduped = stream_dedupe(feed.stream().drop("insert_timestamp"), ["k"], "ts", salts=salts)
        run_to_files(deduped, f"{feed.base}/out", f"{feed.base}/cp")
    out = rows(spark.read.parquet(f"{feed.base}/out"), "k")
    assert out == [(1,), (2,), (3,), (4,)]


# Six files, one a micro-batch; key 3 comes an hour late, key 4 comes late twice, key 2 is a late copy of one that was on time.
LATE = [
    [(1, 0, "a"), (2, 1, "a")], [(5, 60, "a")], [(3, 2, "a"), (2, 1, "a")], [(6, 120, "a")],
    [(4, 3, "a"), (6, 120, "a"), (None, 4, "n")], [(4, 3, "b"), (7, 125, "a")],
]


def run_late(spark, feed, **kw):
    return run_deduped(feed.stream(max_files=1).drop("insert_timestamp"), ["k"], "ts", f"{feed.base}/out", f"{feed.base}/cp", **kw)


@pytest.mark.parametrize("salts", [1, 4])
def test_no_late_key_is_lost_whatever_the_driver_remembers(spark, feed, rows, setting, salts):
    setting("spark.sql.streaming.numRecentProgressUpdates", "1")
    for n, data in enumerate(LATE):
        feed.land(data, minute(n))
    late = run_late(spark, feed, salts=salts)
    out = rows(read_deduped(spark, f"{feed.base}/out"), "k", "late")
    assert late == sum(is_late for _, is_late in out) and [k for k, _ in out] == [1, 2, 3, 4, 5, 6, 7, None]
    if salts == 1:  # behind a salted pass the stream's watermark is a batch older, so it may take a row that is late here
        assert out == [(1, False), (2, False), (3, True), (4, True), (5, False), (6, False), (7, False), (None, True)]
    # a run without news changes nothing, and one with more late copies adds none
    assert run_late(spark, feed, salts=salts) == 0
    feed.land([(3, 2, "c"), (8, 9, "c")], minute(7))
    assert run_late(spark, feed, salts=salts) == 1
    assert rows(read_deduped(spark, f"{feed.base}/out"), "k", "late") == sorted([*out, (8, True)], key=str)


@pytest.mark.parametrize("where", ["batch", "late", "forget"])
def test_a_crash_between_output_and_late_rows_loses_none(spark, feed, rows, monkeypatch, where):
    for n, data in enumerate(LATE):
        feed.land(data, minute(n))
    own = {"batch": module.write_text, "late": module.dedupe_latest, "forget": module.delete}[where]
    name, calls = own.__name__, []

    def crash(*args, **kw):
        calls.append(args)
        settling = where != "forget" or str(args[1]).endswith(f"{module.KIND}={module.SEEN}")
        if settling and len(calls) > (3 if where == "batch" else 0):
            raise OSError("gone")
        return own(*args, **kw)

    monkeypatch.setattr(module, name, crash)
    with pytest.raises(Exception, match="gone"):
        run_late(spark, feed)
    monkeypatch.setattr(module, name, own)
    run_late(spark, feed)
    assert rows(read_deduped(spark, f"{feed.base}/out"), "k") == [(1,), (2,), (3,), (4,), (5,), (6,), (7,), (None,)]


def test_without_notes_all_old_rows_are_compared(spark, feed, rows):
    for n, data in enumerate(LATE[:3]):
        feed.land(data, minute(n))
    run_late(spark, feed)
    for name in child_names(spark, f"{feed.base}/out/{module.MARKS}"):
        module.delete(spark, f"{feed.base}/out/{module.MARKS}/{name}")
    for n, data in enumerate(LATE[3:]):
        feed.land(data, minute(n + 3))
    run_late(spark, feed)
    assert len(rows(read_deduped(spark, f"{feed.base}/out"))) == 8


def test_running_newest_row(spark, feed, rows):
    for at, data in (
        (minute(10), [(1, 0, "a"), (1, 5, "b"), (2, 1, "c")]),
        (minute(20), [(1, 3, "late"), (2, 7, None)]),
    ):
        feed.land(data, at)
        latest = stream_latest(feed.stream().drop("insert_timestamp"), ["k"], ["ts"])
        run_updates(latest, f"{feed.base}/out", f"{feed.base}/cp", ["k"])
        assert child_names(feed.stream().sparkSession, f"{feed.base}/out/updates") == []
    assert rows(read_updates(spark, f"{feed.base}/out", ["k"])) == [(1, minute(5), "b"), (2, minute(7), None)]
