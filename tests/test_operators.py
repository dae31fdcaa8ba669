"""Operators on small frames, quirks included, and the plans they lead to."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.operators.cdc import (
    append_extract,
    cdc_filter,
    new_watermark,
    raw_high_mark,
    raw_since,
    split_bounds,
)
from tidemark.operators.config import (
    advance_merge_watermark,
    advance_source_watermark,
    invalid_config,
    merge_task,
    ready,
    repeated_config,
    seed_config,
    sync_config,
)
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.gold import dim_date
from tidemark.operators.upsert import FROM_SOURCE, merge_inserts, merge_stats, rejected_rows, upsert, upsert_stored
from tidemark.schemas import LOAD_CONFIG, MERGE_STATE, RUN_STATE
from tidemark.sources.databases import FileSource


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def at(text):
    return datetime.fromisoformat(text)


# --- change extraction ---------------------------------------------------------------------


def changes(spark):
    schema = "id int, a timestamp_ntz, b timestamp_ntz"
    new, old = at("2024-01-02 00:00:00"), at("2024-01-01 00:00:00")
    return spark.createDataFrame([(1, new, None), (2, None, new), (3, old, None), (4, None, None)], schema)


def test_change_filter_is_strict_and_three_valued(spark, rows):
    assert rows(cdc_filter(changes(spark), ["a", "b"], "2024-01-01 00:00:00"), "id") == [(1,), (2,)]


def test_change_filter_reaches_the_scan(spark):
    extract = FileSource(SF, ".parquet").extract(spark, "lineitem", ["l_shipdate"], "2000-01-01 00:00:00")
    plan = plan_of(extract.select("l_orderkey"))
    assert "GreaterThan(l_shipdate,2000-01-01T00:00)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in plan


def test_watermark_ignores_nulls_and_may_be_null(spark, rows):
    df = changes(spark)
    assert rows(new_watermark(df, ["a", "b"])) == [(at("2024-01-02"),)]
    assert rows(new_watermark(df.filter("id = 4"), ["a", "b"])) == [(None,)]


def test_bounds_of_nothing_are_zero_and_of_dates_stay_null(spark, rows):
    none = changes(spark).filter("id > 9")
    assert rows(split_bounds(none, "id")) == [(0, 0)]
    assert rows(split_bounds(none, "a")) == [(None, None)]
    assert rows(split_bounds(changes(spark), "id")) == [(1, 4)]


def test_append_keeps_repeats_and_fills_new_columns(spark, rows):
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(append_extract(old, new)) == [(1, 2), (1, None)]


def test_raw_window_is_open_below_and_closed_above(spark, rows):
    raw = changes(spark).withColumnRenamed("a", "insert_timestamp")
    assert rows(raw_since(raw, "2024-01-01 00:00:00", "2024-01-02 00:00:00"), "id") == [(1,)]
    assert rows(raw_since(raw, None), "id") == [(1,), (3,)]


def test_high_mark_stays_without_news(spark, rows):
    raw = changes(spark).withColumnRenamed("a", "insert_timestamp")
    assert rows(raw_high_mark(raw, "2030-01-01 00:00:00")) == [(at("2030-01-01"),)]
    assert rows(raw_high_mark(raw, None)) == [(at("2024-01-02"),)]


# --- newest row per key --------------------------------------------------------------------


def test_ties_have_one_winner_however_rows_are_spread(spark, rows):
    data = [(k, 1, v) for k in range(5) for v in range(20)]
    schema = "k int, ts int, v int"
    random.Random(1).shuffle(data)
    first = rows(dedupe_latest(spark.createDataFrame(data, schema).repartition(3), ["k"], ["ts"]))
    random.Random(2).shuffle(data)
    assert rows(dedupe_latest(spark.createDataFrame(data, schema).repartition(7), ["k"], ["ts"])) == first
    assert first == [(k, 1, 19) for k in range(5)]


def test_null_is_a_key_and_the_oldest_stamp(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, None), (1, 1)], "k int, ts int")
    assert rows(dedupe_latest(df, ["k"], ["ts"])) == [(1, 1), (None, 2)]


def test_maps_do_not_order_rows(spark, rows):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k int, ts int, m map<string,int>")
    assert rows(dedupe_latest(df, ["k"], ["ts"])) == [(1, 2, {"b": 2})]


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = plan_of(dedupe_latest(events, ["user_id"], ["ts"]))
    below_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle and "Partial" in below_shuffle


# --- merge ---------------------------------------------------------------------------------


def merged_in_python(target, source, newer=False, null_keys="reject"):
    out, source = list(target), [r for r in source if r[0] is not None or null_keys == "insert"]
    for row in source:
        hits = [i for i, t in enumerate(target) if t[0] == row[0] is not None]
        for i in hits:
            if not newer or row[1] >= target[i][1]:
                out[i] = row
        if not hits:
            out.append(row)
    return sorted(out, key=str)


@pytest.mark.parametrize("null_keys", ["reject", "insert"])
@pytest.mark.parametrize("newer", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_upsert_equals_a_plain_merge(spark, rows, seed, newer, null_keys):
    rng = random.Random(seed)
    schema = "k int, ts int, v string"

    def side(name):
        keys = rng.sample(range(40), 25)
        return [(k, rng.randrange(5), rng.choice([name, None])) for k in keys] + [(None, 1, name)]

    target, source = side("t"), side("s")
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    want = merged_in_python(target, source, newer, null_keys)
    by = ["ts"] if newer else []
    assert rows(upsert(t, s, ["k"], by, null_keys)) == want
    kept, added = upsert_stored(t, s, ["k"], by, null_keys)
    assert rows(kept.unionByName(added).drop(FROM_SOURCE)) == want


def test_upsert_takes_nulls_of_the_source_and_keeps_repeats_of_the_target(spark, rows):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    s = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(upsert(t, s, ["k"])) == [(1, None), (1, None), (2, "c")]


def test_upsert_with_columns_on_one_side_only(spark, rows):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, old int")
    s = spark.createDataFrame([(2, 200), (3, 300)], "k int, new int")
    assert rows(upsert(t, s, ["k"])) == [(1, 10, None), (2, 20, 200), (3, None, 300)]


def test_upsert_twice_changes_nothing(spark, rows):
    t = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "a int, b int, v string")
    s = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, v string")
    once = upsert(t, s, ["a", "b"])
    assert rows(once) == [(1, 1, "x"), (1, 2, "y"), (2, 1, "b")]
    assert rows(upsert(once, s, ["a", "b"])) == rows(once)


def test_merge_of_newest_rows_shuffles_each_side_once(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    events = spark.read.parquet(f"{SF}/events.parquet")
    newest = dedupe_latest(events, ["user_id"], ["ts"])
    assert plan_of(upsert(newest, newest.withColumn("value", F.lit(0.0)), ["user_id"])).count("Exchange") == 2


def test_small_increment_does_not_shuffle_a_stored_target(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.filter("l_quantity = 5").write.parquet(f"{tmp_path}/few")
    kept, _ = upsert_stored(lines, spark.read.parquet(f"{tmp_path}/few"), ["l_orderkey", "l_linenumber"])
    assert "Exchange hashpartitioning" not in plan_of(kept)


def test_unknown_null_mode(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="null_keys"):
        upsert(df, df, ["k"], null_keys="keep")


def test_stats_do_not_match_null_keys(spark, rows):
    t = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    s = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert rows(merge_stats(t, s, ["k"])) == [(1, 1, 2, 1)]
    assert rows(merge_stats(t, s, ["k"], null_keys="insert")) == [(1, 2, 2, 0)]
    assert rows(merge_stats(t.limit(0), s.limit(0), ["k"])) == [(0, 0, 0, 0)]
    assert rows(merge_inserts(t, s, ["k"])) == [(3,)] and merge_inserts(t, s, ["k"], "insert").count() == 2
    assert rejected_rows(s, ["k"]).count() == 1 and upsert(t, s, ["k"]).count() == 4


def test_maps_within_structs_do_not_order_rows(spark):
    df = spark.sql("select 1 k, 1 seq, named_struct('m', map('a', 1), 'n', 1) s union all select 1, 2, named_struct('m', map('b', 2), 'n', 0)")
    assert dedupe_latest(df, ["k"], ["seq"]).select("s.n").first()[0] == 0


# --- config and state ----------------------------------------------------------------------


def test_watermarks_never_go_back(spark, rows):
    none = None
    state = spark.createDataFrame(
        [("d", "a", "2024-01-02 00:00:00", none), ("d", "b", "2024-01-02 00:00:00.5", none), ("d", "c", none, none)],
        RUN_STATE,
    )
    updates = spark.createDataFrame(
        [("d", "a", "2024-01-01 00:00:00"), ("d", "b", none), ("d", "x", "2024-01-01 00:00:00")],
        "database_name string, table_name string, last_updated_on string",
    )
    got = rows(advance_source_watermark(state, updates), "table_name", "last_updated_on")
    assert got == [
        ("a", "2024-01-02 00:00:00"),
        ("b", "2024-01-02 00:00:00.500000"),
        ("c", None),
        ("x", "2024-01-01 00:00:00"),
    ]


def test_merge_watermark_stays_without_news(spark, rows):
    state = spark.createDataFrame([("s", "a", at("2024-01-02"))], MERGE_STATE)
    updates = spark.createDataFrame([("s", "a", None), ("s", "b", at("2024-01-01"))], MERGE_STATE)
    assert rows(advance_merge_watermark(state, updates)) == [
        ("s", "a", at("2024-01-02")),
        ("s", "b", at("2024-01-01")),
    ]


def config_row(table, load_type="cdc_load", col="ts", key="id"):
    return ("d", table, load_type, col, None, None, key, "TRUE")


def test_seed_takes_the_last_line_of_a_key_whole(spark, rows):
    current = spark.createDataFrame([config_row("a"), config_row("b")], LOAD_CONFIG)
    lines = [(*config_row("a", "x"), 2), (*config_row("a", None, None), 10), (*config_row("c"), 1)]
    incoming = spark.createDataFrame(lines, LOAD_CONFIG.simpleString()[7:-1].replace(":", " ") + ", line bigint")
    got = rows(seed_config(current, incoming, "line"), "table_name", "load_type", "incremental_col1")
    assert got == [("a", None, None), ("b", "cdc_load", "ts"), ("c", "cdc_load", "ts")]


def test_repeats_and_gaps_are_reported(spark, rows):
    config = spark.createDataFrame(
        [config_row("a"), config_row("a"), config_row("b", ""), config_row("c", None, key=""), config_row("e", key=" "), config_row(" a")], LOAD_CONFIG
    )
    assert rows(repeated_config(config)) == [("d", "a", 3)]
    assert rows(invalid_config(config), "table_name", "missing") == [
        ("c", "partition_col"),
        ("e", "partition_col"),
    ]


def test_sync_keeps_rows_with_nulls(spark, rows):
    config = spark.createDataFrame([config_row(" a ", key=None), config_row("b", key=" ")], LOAD_CONFIG)
    assert rows(sync_config(config)) == [("d", "a", None), ("d", "b", None)]


def test_merge_task_of_one_database(spark):
    registry = spark.createDataFrame(
        [("shop", "SECOND", 2), ("SHOP", "FIRST", 1)], "database_name string, task_name string, position int"
    )
    assert merge_task(registry, "Shop") == "FIRST"
    with pytest.raises(LookupError):
        merge_task(registry, "other")


def test_gate_needs_a_true_status(spark, rows):
    status = spark.createDataFrame(
        [("a", "TRUE"), ("a", "TRUE"), ("b", "FALSE"), ("c", None)], "database_name string, is_extraction_complete string"
    )
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "database_name string, v int")
    assert rows(ready(df, status)) == [("a", 1)]


def test_calendar_of_no_dates_has_the_unknown_day_only(spark):
    assert [r["date_key"] for r in dim_date(changes(spark).filter("id > 9"), "a").collect()] == [-1]
