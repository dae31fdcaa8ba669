"""Ingest and merge jobs, end to end over file sources."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import SF
from tidemark.functions.timestamps import ntz
from tidemark.operators.cdc import stamp
from tidemark.operators.dedupe import dedupe_latest
from tidemark.plans import ingest, merge
from tidemark.plans.ingest import ingest_database, ingest_table
from tidemark.plans.load_plan import load_plan
from tidemark.plans.merge import merge_schema, merge_table
from tidemark.schemas import LOAD_CONFIG, MERGE_CONFIG, MERGE_STATE, RUN_STATE
from tidemark.sources.control import read_audit
from tidemark.sources.databases import FileSource
from tidemark.sources.raw import read_raw, write_raw
from tidemark.sources.staging import StagingTable
from tidemark.sources.storage import control_rows, publish, read_current

MERGE = T.StructType([*MERGE_CONFIG.fields, T.StructField("kind", T.StringType())])
T1, T2, T3 = datetime(2025, 11, 5, 6, 20), datetime(2025, 11, 5, 19, 40), datetime(2025, 11, 6, 2, 0)


def landed(spark, raw, at, *data, columns="id int, v string"):
    write_raw(stamp(spark.createDataFrame(list(data), columns), at), raw, at, "append")


def test_a_load_that_finishes_late_is_merged_and_replaces_nothing_newer(spark, tmp_path, rows):
    raw, staging = f"{tmp_path}/raw", StagingTable(spark, f"{tmp_path}/staging", ["id"])
    landed(spark, raw, T1, (1, "a"), (2, "a"), (3, "a"))
    merge_table(spark, raw, staging)
    landed(spark, raw, T3, (1, "c"), (4, "c"))
    merge_table(spark, raw, staging)
    landed(spark, raw, T2, (1, "b"), (2, "b"), (5, "b"))
    done = merge_table(spark, raw, staging)
    assert rows(staging.read(), "id", "v") == [(1, "c"), (2, "b"), (3, "a"), (4, "c"), (5, "b")]
    assert (done.inserted, done.high_mark, staging.high_mark()) == (1, T2, T3)
    # a second load under a stamp that has been merged is news too; nothing new is no news
    landed(spark, raw, T1, (6, "a"))
    merge_table(spark, raw, staging)
    assert rows(staging.read(), "id") == [(1,), (2,), (3,), (4,), (5,), (6,)]
    assert merge_table(spark, raw, staging).high_mark is None
    assert len(staging.merged_loads()) == 4


def test_a_load_that_finishes_while_rows_are_read_is_merged_next(spark, tmp_path, rows, monkeypatch):
    raw, staging = f"{tmp_path}/raw", StagingTable(spark, f"{tmp_path}/staging", ["id"])
    landed(spark, raw, T1, (1, "a"))
    own = merge.read_raw

    def read(*args, **kw):
        out = own(*args, **kw)  # listed; then two loads finish, the newer of which is merged by another job's hand
        monkeypatch.setattr(merge, "read_raw", own)
        landed(spark, raw, T3, (3, "c"))
        landed(spark, raw, T2, (2, "b"))
        return out

    monkeypatch.setattr(merge, "read_raw", read)
    merge_table(spark, raw, staging)
    merge_table(spark, raw, staging)
    assert rows(staging.read(), "id") == [(1,), (2,), (3,)]


def test_a_table_merged_before_there_was_a_ledger_goes_on(spark, tmp_path, rows):
    raw, staging = f"{tmp_path}/raw", StagingTable(spark, f"{tmp_path}/staging", ["id"])
    landed(spark, raw, T1, (1, "a"))
    staging.merge(read_raw(spark, raw).drop("load_date", "load_hour"))
    assert staging.merged_loads() is None
    landed(spark, raw, T2, (1, "b"))
    assert merge_table(spark, raw, staging).updated == 1 and len(staging.merged_loads()) == 2


def test_a_table_grows_with_its_columns_types(spark, tmp_path, rows):
    raw, staging = f"{tmp_path}/raw", StagingTable(spark, f"{tmp_path}/staging", ["id"], buckets=3)
    landed(spark, raw, T1, *[(n, n) for n in range(9)], columns="id int, v int")
    merge_table(spark, raw, staging)
    landed(spark, raw, T2, (None, 1), columns="id int, v bigint")
    assert merge_table(spark, raw, staging).rejected == 1  # nothing but a NULL key: the table stays as it is
    assert staging.read().schema["v"].dataType == T.IntegerType()
    landed(spark, raw, T2, (3, 2**40), (2**41, 7), columns="id bigint, v bigint")
    merge_table(spark, raw, staging)
    want = [(n, n) for n in range(9) if n != 3] + [(3, 2**40), (2**41, 7)]
    assert rows(staging.read(), "id", "v") == sorted(want, key=str)
    assert dict(staging.read().dtypes)["id"] == "bigint"
    landed(spark, raw, T3, (3, 5), columns="id int, v int")  # narrower again: cast, not written anew
    merge_table(spark, raw, staging)
    assert rows(staging.read().filter("id = 3"), "id", "v") == [(3, 5)]


def config(spark, *rows):
    return control_rows(spark, [("shop", *r) for r in rows], LOAD_CONFIG)


def state(spark, *rows):
    return control_rows(spark, [("shop", *r) for r in rows], RUN_STATE)


def cdc(table, *cols, load_type="cdc_load", flag="TRUE"):
    cols = [*cols, None, None, None][:3]
    return (table, load_type, *cols, "id", flag)


# --- what to load --------------------------------------------------------------------------


def planned(spark, row, mark="2024-01-02 10:23:45", **kw):
    marks = state(spark, (row[0], mark, None)) if mark is not None else state(spark)
    return load_plan(config(spark, row), marks, **kw).first()


def test_plan_of_a_change_load(spark):
    plan = planned(spark, cdc("t", " a ", "", "b"), kind="stream")
    assert (plan["action"], plan["reason"], plan["change_cols"]) == ("CDC", None, ["a", "b"])
    assert (plan["split_col"], plan["splits"], plan["cutoff"]) == ("id", 2, datetime(2024, 1, 2, 10, 18))


@pytest.mark.parametrize("load_type", [None, "", "  ", "full_load"])
def test_blank_means_full(spark, load_type):
    plan = planned(spark, cdc("t", load_type=load_type, flag="FALSE"), mark=None)
    assert (plan["action"], plan["cutoff"], plan["split_col"], plan["splits"]) == ("FULL", None, None, 1)


def test_an_unreadable_watermark_is_an_error(spark):
    plan = planned(spark, cdc("t", "a"), mark="soon")
    assert (plan["action"], plan["reason"]) == ("ERROR", "unreadable_watermark")


@pytest.mark.parametrize("mark", [None, "", " "])
def test_change_load_without_watermark_is_skipped(spark, mark):
    plan = planned(spark, cdc("t", "a"), mark=mark)
    assert (plan["action"], plan["reason"]) == ("SKIPPED", "no_watermark")


def test_change_load_without_change_columns_is_skipped(spark):
    assert planned(spark, cdc("t", " "))["reason"] == "no_change_columns"


def test_unknown_load_type(spark):
    row = cdc("t", "a", load_type="snapshot")
    assert (planned(spark, row)["action"], planned(spark, row)["reason"]) == ("ERROR", "unknown_load_type")
    assert planned(spark, row, unknown="drop") is None
    with pytest.raises(Exception, match="unknown load type: snapshot"):
        planned(spark, row, unknown="raise")
    with pytest.raises(ValueError):
        planned(spark, row, unknown="guess")


# --- runs ----------------------------------------------------------------------------------


@pytest.fixture
def shop(spark, tmp_path):
    """A source database with one table that changes, and the places of a run."""

    class Shop:
        source = FileSource(f"{tmp_path}/source")
        root, control = f"{tmp_path}/raw", f"{tmp_path}/control"
        staging = f"{tmp_path}/staging"

        def put(self, name, data, schema="id int, v string, changed_at timestamp_ntz"):
            spark.createDataFrame(data, schema).write.mode("overwrite").parquet(f"{self.source.location}/{name}")

        def configure(self, *rows, marks=()):
            publish(config(spark, *rows), f"{self.control}/batch_config")
            publish(state(spark, *marks), f"{self.control}/state")

        def ingest(self, at):
            return ingest_database(spark, "shop", self.source, self.root, self.control, at)

        def state(self):
            return {r["table_name"]: r for r in read_current(spark, f"{self.control}/state", RUN_STATE).collect()}

        def raw(self, name):
            return read_raw(spark, f"{self.root}/Files/shop/{name}")

    return Shop()


def day(n, minute=0):
    return datetime(2024, 1, n, 0, minute)


def test_full_then_change_loads_reach_the_latest_source(spark, shop, rows):
    merge = control_rows(spark, [("shop", "t", "id", "batch")], MERGE)
    first = [(i, "a", day(1)) for i in range(10)]
    shop.put("t", first)
    shop.configure(cdc("t", "changed_at", load_type="full_load"))
    shop.ingest(T1)
    merge_schema(spark, merge, "shop", "batch", f"{shop.root}/Files", shop.staging)
    assert shop.state()["t"]["last_updated_on"] == "2024-01-01 00:00:00"

    publish(config(spark, cdc("t", "changed_at")), f"{shop.control}/batch_config")
    for at, changes in ((T2, {3: "b", 11: "b"}), (T3, {3: "c", 4: "c", 12: "c"})):
        current = {r[0]: r for r in first} | {k: (k, v, day(2 if at == T2 else 3)) for k, v in changes.items()}
        first = list(current.values())
        shop.put("t", first)
        results = shop.ingest(at)
        done = merge_schema(spark, merge, "shop", "batch", f"{shop.root}/Files", shop.staging)
        assert done.first()["status"] == "SUCCESS"
    # The look-back read the rows of the day before once more; staging has each key once.
    assert results[0].row_count == 5 - 1
    staged = StagingTable(spark, f"{shop.staging}/SHOP/T", ["id"]).read()
    assert rows(staged, "id", "v", "changed_at") == sorted(first, key=str)


def test_full_load_seeds_the_watermark_and_marks_the_raw_table(spark, shop):
    shop.put("t", [(1, "a", day(4)), (2, "b", None)])
    shop.configure(cdc("t", "changed_at", load_type="full_load"))
    (done,) = shop.ingest(T1)
    assert (done.status, done.row_count, done.last_updated_on) == ("SUCCESS", 2, "2024-01-04 00:00:00")
    assert shop.state()["t"]["full_loaded_at"] == T1


def test_change_load_of_nothing_leaves_the_state(spark, shop):
    shop.put("t", [(1, "a", day(1))])
    shop.configure(cdc("t", "changed_at"), marks=[("t", "2024-02-01 00:00:00", T1)])
    (done,) = shop.ingest(T2)
    assert (done.status, done.row_count) == ("SUCCESS", 0)
    assert shop.state()["t"]["last_updated_on"] == "2024-02-01 00:00:00"
    assert shop.state()["t"]["full_loaded_at"] == T1


def test_change_columns_without_values_keep_the_watermark(spark, shop):
    shop.put("t", [(1, "a", None)])
    shop.configure(cdc("t", "changed_at", load_type="full_load"), marks=[("t", "2024-02-01 00:00:00", None)])
    shop.ingest(T2)
    assert shop.state()["t"]["last_updated_on"] == "2024-02-01 00:00:00"


def test_the_watermark_covers_all_change_columns(spark, shop):
    schema = "id int, a timestamp_ntz, b date"
    shop.put("t", [(1, day(1, 5), day(2).date()), (2, None, day(3).date())], schema)
    shop.configure(cdc("t", "a", "b", load_type="full_load"))
    assert shop.ingest(T1)[0].last_updated_on == "2024-01-03 00:00:00"


def test_a_failed_table_is_audited_and_raised_and_the_others_count(spark, shop, rows):
    shop.put("t", [(1, "a", day(1))])
    shop.configure(cdc("t", load_type="full_load"), cdc("missing", load_type="full_load"), cdc("none", "a"))
    with pytest.raises(Exception, match="missing"):
        shop.ingest(T1)
    audit = read_audit(spark, f"{shop.control}/audit")
    assert rows(audit, "table_name", "layer", "status", "row_count") == [
        ("missing", "RAW", "FAILED", 0),
        ("none", "RAW", "SKIPPED", 0),
        ("t", "RAW", "SUCCESS", 1),
    ]
    assert set(shop.state()) == {"t"} and shop.raw("t").count() == 1


def test_every_row_of_an_extract_has_the_load_time(spark, shop):
    shop.put("t", [(i, "a", day(1)) for i in range(20)])
    plan = load_plan(config(spark, cdc("t", load_type="full_load")), state(spark)).first()
    ingest_table(spark, plan, shop.source, shop.root, T1)
    assert [tuple(r) for r in shop.raw("t").select("insert_timestamp").distinct().collect()] == [(T1,)]


def test_rows_landing_during_a_merge_are_left_for_the_next(spark, tmp_path, rows):
    raw = f"{tmp_path}/raw"
    def land(key, at):
        write_raw(stamp(spark.createDataFrame([(key, "a")], "id int, v string"), at), raw, at, "append")

    staging = StagingTable(spark, f"{tmp_path}/staging", ["id"])
    land(1, T1)
    assert merge_table(spark, raw, staging).high_mark == T1
    land(2, T2)
    assert merge_table(spark, raw, staging).high_mark == T2
    assert merge_table(spark, raw, staging).high_mark is None
    assert rows(staging.read(), "id") == [(1,), (2,)]


def test_merge_sees_the_raw_table_of_the_last_full_load(spark, tmp_path, rows):
    raw = f"{tmp_path}/raw"
    for key, at, mode in ((1, T1, "append"), (2, T2, "overwrite")):
        df = spark.createDataFrame([(key, "a")], "id int, v string")
        write_raw(stamp(df, at), raw, at, mode)
    staging = StagingTable(spark, f"{tmp_path}/staging", ["id"])
    merge_table(spark, raw, staging, full_loaded_at=T2)
    assert rows(staging.read(), "id") == [(2,)]


def test_schema_merge_goes_on_after_a_failure(spark, shop, rows):
    shop.put("t", [(1, "a", day(1)), (None, "b", day(1))])
    shop.configure(cdc("t", load_type="full_load"))
    shop.ingest(T1)
    merge = control_rows(
        spark,
        [("shop", "t", "id", "batch"), ("shop", " t", "id", "batch"), ("shop", "t", "v", "stream"), ("shop", "u", None, "batch")],
        MERGE,
    )
    done = merge_schema(spark, merge, "shop", "BATCH", f"{shop.root}/Files", shop.staging, workers=1)
    assert rows(done, "schema_name", "table_name", "status", "inserted", "rejected") == [
        ("SHOP", "T", "SUCCESS", 1, 1),
        ("SHOP", "U", "FAILED", None, None),
    ]
    assert merge_schema(spark, merge, "none", "batch", shop.root, shop.staging).count() == 0
    merge_schema(spark, merge, "shop", "batch", f"{shop.root}/Files", shop.staging, control=shop.control)
    assert rows(read_current(spark, f"{shop.control}/merge_state", MERGE_STATE)) == [("SHOP", "T", T1)]


def test_a_table_configured_in_two_ways_is_not_merged(spark, shop, rows):
    shop.put("t", [(1, "a", day(1))])
    shop.configure(cdc("t", load_type="full_load"))
    shop.ingest(T1)
    for other in (("shop", "t", "v", "batch"), ("shop", "T", "id", "batch")):
        merge = control_rows(spark, [("shop", "t", "id", "batch"), other], MERGE)
        done = merge_schema(spark, merge, "shop", "batch", f"{shop.root}/Files", shop.staging)
        assert rows(done, "table_name", "status") == [("T", "FAILED")]
        assert StagingTable(spark, f"{shop.staging}/SHOP/T", ["id"]).read() is None


def test_schema_merge_uses_the_load_plan(spark, shop, rows):
    """Two versions of a key in one extract: the change column decides, not the other columns.
    What was in RAW before the last full load is not merged."""
    shop.put("t", [(1, "z", day(1)), (1, "a", day(2)), (9, "x", day(1))])
    shop.configure(cdc(" t ", "changed_at", load_type="full_load"))
    shop.ingest(T1)
    shop.put("t", [(1, "z", day(1)), (1, "a", day(2)), (2, "b", day(1))])
    shop.ingest(T2)
    merge = control_rows(spark, [("shop", "t", "id", "batch")], MERGE)
    loads = read_current(spark, f"{shop.control}/batch_config", LOAD_CONFIG)
    plan = load_plan(loads, read_current(spark, f"{shop.control}/state", RUN_STATE))
    merge_schema(spark, merge, "shop", "batch", f"{shop.root}/Files", shop.staging, plan)
    staged = StagingTable(spark, f"{shop.staging}/SHOP/T", ["id"]).read()
    assert rows(staged, "id", "v") == [(1, "a"), (2, "b")]


def test_stream_runs_have_their_own_config_and_one_try(spark, shop, monkeypatch):
    shop.put("t", [(1, "a", day(1))])
    publish(config(spark, cdc("t", load_type="full_load")), f"{shop.control}/stream_config")
    tries = []

    def failing(*_):
        tries.append(1)
        raise OSError("lost")

    monkeypatch.setattr(ingest, "write_raw", failing)
    with pytest.raises(OSError):
        ingest_database(spark, "shop", shop.source, shop.root, shop.control, T1, kind="stream")
    assert len(tries) == 1


def test_incremental_equals_recompute_on_the_event_feed(spark, tmp_path, rows):
    events = spark.read.parquet(f"{SF}/events.parquet")
    staging = StagingTable(spark, f"{tmp_path}/staging", ["user_id"])
    cuts = ["2024-01-01 00:00:00", "2024-01-11 00:00:00", "2024-01-21 00:00:00", "2024-02-01 00:00:00"]
    for at, low, high in zip((T1, T2, T3), cuts, cuts[1:]):
        back = ntz(low) - F.expr("interval 10 minutes")
        part = events.filter((F.col("ts") > back) & (F.col("ts") <= ntz(high)))
        write_raw(stamp(part, at), f"{tmp_path}/raw", at, "append")
        merge_table(spark, f"{tmp_path}/raw", staging, ["ts"])
    assert rows(staging.read().drop("insert_timestamp")) == rows(dedupe_latest(events, ["user_id"], ["ts"]))
