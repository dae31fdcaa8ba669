"""Source databases, RAW files, control tables."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cdc import stamp
from tidemark.plans import admin
from tidemark.plans.admin import backup, seed, sync_all
from tidemark.plans.pools import in_threads
from tidemark.schemas import LOAD_CONFIG, MERGE_CONFIG, SNAPSHOT_MANIFEST
from tidemark.sources.control import expire_snapshots, load_config, read_load_config_csv, snapshot_tables
from tidemark.sources.databases import FileSource, JdbcSource, source_for, split_options
from tidemark.sources import raw as raw_files
from tidemark.sources.raw import finished_loads, noted_schema, raw_path, raw_table, read_raw, write_mode, write_raw, write_with_retry
from tidemark.sources.storage import (
    KEPT_VERSIONS,
    VersionTaken,
    child_names,
    control_rows,
    current_version,
    exists,
    publish,
    read_current,
    update,
    versions,
)

HOUR_1, HOUR_2, NEXT_DAY = (
    datetime(2025, 11, 5, 6, 20),
    datetime(2025, 11, 5, 7, 0),
    datetime(2025, 11, 5, 18, 45),
)


# --- JDBC: what the reader is asked for (no database is started for tests) -------------------


@pytest.mark.parametrize(
    "kind, query",
    [
        ("MySQL", "SELECT * FROM `shop`.`orders` WHERE `a` > CAST('2024-01-01 00:00:00' AS DATETIME)"),
        ("postgresql", "SELECT * FROM \"shop\".\"orders\" WHERE \"a\" > CAST('2024-01-01 00:00:00' AS TIMESTAMP)"),
    ],
)
def test_extract_is_filtered_by_the_database(kind, query):
    asked = record_reads(JdbcSource(kind, "jdbc:x"), "shop.orders", ["a"], "2024-01-01 00:00:00")
    assert [o["dbtable"] for o in asked] == [f"({query}) src"]


def test_any_change_column_qualifies_a_row():
    where = JdbcSource("mysql", "jdbc:x").changed_rows(["a", "b`c"], "2024-01-01 00:00:00")
    limit = "CAST('2024-01-01 00:00:00' AS DATETIME)"
    assert where == f" WHERE `a` > {limit} OR `b``c` > {limit}"


def test_parallel_read_asks_for_the_bounds_of_the_same_rows():
    source = JdbcSource("mysql", "jdbc:x", {"user": "u"}, fetch_size=1000)
    bounds, read = record_reads(source, "t", ["a"], "2024-01-01 00:00:00", "id", 2, bounds=(5, 95))
    assert bounds["dbtable"].startswith("(SELECT MIN(`id`) AS min_val, MAX(`id`) AS max_val FROM `t` WHERE `a` >")
    assert read["dbtable"].startswith("(SELECT * FROM `t` WHERE `a` >")
    ranged = {k: read[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    assert ranged == {"partitionColumn": "id", "lowerBound": "5", "upperBound": "95", "numPartitions": "2"}
    assert (read["fetchsize"], read["user"], read["zeroDateTimeBehavior"]) == ("1000", "u", "convertToNull")


def test_bounds_of_nothing_and_of_dates():
    assert split_options("id", None, None, 10) == {} == split_options("d", None, None, 2)
    assert split_options("id", Decimal("-1.50"), Decimal("9.01"), 3) == {
        "partitionColumn": "id", "lowerBound": "-2", "upperBound": "10", "numPartitions": "3"
    }
    assert split_options("x", 0.25, 7.0, 2)["lowerBound"] == "0" and split_options("x", 0.25, 7.0, 2)["upperBound"] == "7"
    assert split_options("d", datetime(2024, 1, 2), datetime(2024, 1, 3), 2)["lowerBound"] == "2024-01-02 00:00:00"


def test_source_types():
    assert isinstance(source_for("Parquet", "/x"), FileSource)
    assert source_for("POSTGRESQL", "jdbc:x").directory == "PostgreSQL"
    with pytest.raises(ValueError, match="unsupported source type"):
        source_for("oracle", "jdbc:x")


def test_credentials_are_not_printed():
    assert "secret" not in repr(JdbcSource("mysql", "jdbc:x", {"password": "secret"}))


def test_splits_follow_the_range_of_keys():
    source = JdbcSource("mysql", "jdbc:x", rows_per_split=100)
    for bounds, splits in (((1, 1000), "10"), ((1, 150), "2"), ((Decimal("0.5"), Decimal("999.5")), "10")):
        assert record_reads(source, "t", [], None, "id", 2, bounds=bounds)[1]["numPartitions"] == splits
    day = (datetime(2024, 1, 1), datetime(2025, 1, 1))
    assert record_reads(source, "t", [], None, "d", 2, bounds=day)[1]["numPartitions"] == "2"
    assert "numPartitions" not in record_reads(source, "t", [], None, "d", 2, bounds=(None, None))[1]


def record_reads(source, *args, bounds=(0, 0)):
    """Options of each read the source asks of a session."""
    asked = []

    class Reader:
        def format(self, name):
            assert name == "jdbc"
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return self

        def first(self):
            return bounds

    class Session:
        read = Reader()

    source.extract(Session, *args)
    return asked


# --- RAW -----------------------------------------------------------------------------------


@pytest.fixture
def raw(spark, tmp_path):
    path = raw_path(str(tmp_path), "MySQL", "shop", "orders")

    def write(n, at, mode, **extra):
        df = spark.range(n).withColumns({k: F.lit(v) for k, v in extra.items()})
        write_raw(stamp(df, at), path, at, mode)
        return path

    return write


def test_layout_is_source_database_table_date_hour(spark, raw):
    path = raw(5, NEXT_DAY, "append")
    assert path.endswith("/MySQL/shop/orders")
    assert exists(spark, f"{path}/load_date=2025-11-06/load_hour=00")
    files = child_names(spark, f"{path}/load_date=2025-11-06/load_hour=00")
    assert all(f.endswith(".snappy.parquet") for f in files if f.startswith("part"))
    assert read_raw(spark, path).select("load_date", "load_hour").distinct().collect() == [("2025-11-06", "00")]


def test_overwrite_is_for_the_hour(spark, raw, rows):
    raw(3, HOUR_1, "append")
    raw(4, HOUR_2, "append")
    path = raw(2, HOUR_2, "overwrite")
    assert rows(read_raw(spark, path).groupBy("load_hour").count()) == [("11", 3), ("12", 2)]


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_no_rows_change_nothing(spark, raw, mode):
    raw(3, HOUR_1, "append")
    path = raw(0, HOUR_1, mode)
    assert read_raw(spark, path).count() == 3


def test_earlier_dates_are_not_opened(spark, raw):
    raw(3, HOUR_1, "append")
    path = raw(4, NEXT_DAY, "append")
    later = read_raw(spark, path, since=NEXT_DAY)
    assert later.count() == 4 and "load_date=2025-11-05" not in "".join(later.inputFiles())
    assert read_raw(spark, path, since=datetime(2026, 1, 1)) is None
    assert read_raw(spark, f"{path}-none") is None


def test_raw_table_starts_at_the_last_full_load(spark, raw):
    raw(3, HOUR_1, "overwrite")
    path = raw(4, HOUR_2, "overwrite")
    assert raw_table(read_raw(spark, path), HOUR_2).count() == 4
    assert raw_table(read_raw(spark, path), None).count() == 7


def test_new_columns_of_later_files_are_seen(spark, raw, rows):
    raw(1, HOUR_1, "append")
    path = raw(1, HOUR_2, "append", extra="x")
    assert rows(read_raw(spark, path), "extra") == [("x",), (None,)]


def test_columns_named_like_the_partitions_are_refused(raw):
    with pytest.raises(ValueError, match="load_date"):
        raw(1, HOUR_1, "append", load_date="x")


def test_write_modes():
    assert (write_mode("full_load"), write_mode("cdc_load")) == ("overwrite", "append")


@pytest.mark.parametrize("failures, attempts, fine", [(2, 3, True), (3, 3, False), (1, 1, False)])
def test_retry(failures, attempts, fine):
    calls = []

    def write():
        calls.append(1)
        if len(calls) <= failures:
            raise OSError("lost")
        return "done"

    if fine:
        assert write_with_retry(write, attempts) == "done"
    else:
        with pytest.raises(OSError):
            write_with_retry(write, attempts)
    assert len(calls) == min(failures + 1, attempts)


# --- control tables ------------------------------------------------------------------------


def test_a_version_without_success_marker_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(1), path)
    publish(spark.range(2), path)
    (tmp_path / "t" / "v=0000000002" / "_SUCCESS").unlink()
    assert current_version(spark, path) == 1
    assert read_current(spark, path, spark.range(1).schema).count() == 1
    assert publish(spark.range(5), path) == 2
    assert read_current(spark, path, spark.range(1).schema).count() == 5


def test_of_two_publishers_one_gets_the_version(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(1), path)
    publish(spark.range(2), path, 2)
    with pytest.raises(VersionTaken):
        publish(spark.range(3), path, 2)
    assert read_current(spark, path, spark.range(1).schema).count() == 2
    assert len(child_names(spark, path)) == 2


COUNTER = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def counted(spark, name):
    """The change that adds one to the count of a name."""
    return lambda state: state.unionByName(control_rows(spark, [(name, 1)], COUNTER)).groupBy("name").agg(F.sum("n").alias("n"))


def test_an_update_overtaken_is_applied_to_the_newer_state(spark, tmp_path, rows):
    path, seen = str(tmp_path / "t"), []

    def slow(state):
        seen.append(rows(state))
        if len(seen) < 3:  # another writer comes first, twice
            update(spark, path, COUNTER, counted(spark, "b"))
        return counted(spark, "a")(state)

    assert update(spark, path, COUNTER, slow) == 3
    assert seen == [[], [("b", 1)], [("b", 2)]]
    assert rows(read_current(spark, path, COUNTER)) == [("a", 1), ("b", 2)]


def test_updates_of_many_writers_all_count(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    in_threads(spark, lambda name: update(spark, path, COUNTER, counted(spark, name)), ["a", "b", "a", "c", "a", "b"], 6)
    assert rows(read_current(spark, path, COUNTER)) == [("a", 3), ("b", 2), ("c", 1)]
    assert versions(spark, path) == [1, 2, 3, 4, 5, 6]


def test_an_update_ends_after_its_attempts_and_on_errors_of_its_own(spark, tmp_path, rows):
    path = str(tmp_path / "t")

    def overtaken(state):
        update(spark, path, COUNTER, counted(spark, "b"))
        return counted(spark, "a")(state)

    with pytest.raises(VersionTaken):
        update(spark, path, COUNTER, overtaken, attempts=2)
    with pytest.raises(ZeroDivisionError):
        update(spark, path, COUNTER, lambda state: 1 // 0)
    assert rows(read_current(spark, path, COUNTER)) == [("b", 2)]


def test_a_version_long_removed_is_not_published_again(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(5):
        publish(spark.range(1), path, keep=2)
    with pytest.raises(VersionTaken):
        publish(spark.range(9), path, 2)
    assert versions(spark, path) == [4, 5] and len(child_names(spark, path)) == 2


def test_raw_columns_are_noted_and_hours_pruned(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    loads = [(datetime(2025, 1, 1, 3), "id int, a int"), (datetime(2025, 1, 1, 9), "id int, b string"), (datetime(2025, 1, 2, 1), "id int")]
    for n, (at, columns) in enumerate(loads):
        values = [(n, None)] if "," in columns else [(n,)]
        write_raw(stamp(spark.createDataFrame(values, columns), at), path, at, "append")
    assert [f.name for f in noted_schema(spark, path).fields if f.name != "insert_timestamp"] in (["id", "a", "b"], ["id", "b", "a"])
    assert rows(read_raw(spark, path), "id", "a", "b") == [(0, None, None), (1, None, None), (2, None, None)]
    late = read_raw(spark, path, since=loads[1][0])
    assert rows(late, "id") == [(1,), (2,)] and all("load_hour=08" not in f for f in late.inputFiles())
    assert set(late.columns) >= {"a", "b"}
    write_raw(stamp(spark.createDataFrame([(3, 1.5)], "id int, a double"), loads[2][0]), f"{path}2", loads[2][0], "append")
    write_raw(stamp(spark.createDataFrame([(3, 1)], "id int, a int"), loads[1][0]), f"{path}2", loads[1][0], "append")
    assert noted_schema(spark, f"{path}2") is None


def land(spark, path, at, value, columns="id int", mode="append"):
    write_raw(stamp(spark.createDataFrame([(value,)], columns), at), path, at, mode)


def test_the_ledger_has_loads_as_they_finish(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    assert finished_loads(spark, path) == []
    for n, at in enumerate((HOUR_2, HOUR_1, HOUR_1)):  # the older one later, and two of one stamp
        land(spark, path, at, n)
    loads = finished_loads(spark, path)
    assert [load.stamp for load in loads] == [HOUR_1, HOUR_1, HOUR_2] and len({load.id for load in loads}) == 3
    assert finished_loads(spark, path, HOUR_2) == loads[2:]
    files = [f.rsplit("/", 1)[1] for f in read_raw(spark, path).inputFiles()]
    assert sorted(f.split("-")[1] for f in files) == sorted(load.id for load in loads)
    assert "_landing" not in child_names(spark, path) or not child_names(spark, f"{path}/_landing")
    # an older hour is read again for a load in it, and no other hour is
    late = read_raw(spark, path, since=NEXT_DAY, also=[HOUR_1])
    assert rows(late, "id") == [(1,), (2,)]


def test_an_overwrite_replaces_its_hour_and_an_empty_load_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    for n, (at, mode) in enumerate([(HOUR_1, "append"), (HOUR_2, "append"), (HOUR_1, "overwrite")]):
        land(spark, path, at, n, mode=mode)
    empty = spark.createDataFrame([], "id int")
    write_raw(stamp(empty, HOUR_2), path, HOUR_2, "overwrite")
    assert rows(read_raw(spark, path), "id") == [(1,), (2,)]
    assert len(finished_loads(spark, path)) == 4


def test_a_load_that_fails_half_way_leaves_nothing(spark, tmp_path, rows, monkeypatch):
    path, calls = str(tmp_path / "raw"), []
    land(spark, path, HOUR_1, 0)
    own = raw_files.move

    def crash(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("gone")
        own(*args)

    monkeypatch.setattr(raw_files, "move", crash)
    two = spark.createDataFrame([(1,), (2,)], "id int").repartition(2)
    with pytest.raises(OSError):
        write_raw(stamp(two, HOUR_1), path, HOUR_1, "overwrite")
    assert len(calls) == 2 and rows(read_raw(spark, path), "id") == [(0,)] and len(finished_loads(spark, path)) == 1


def test_loads_of_other_types_are_read_as_the_widest(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    land(spark, path, HOUR_1, 1)
    land(spark, path, HOUR_1, 2**40, "id bigint")  # in the same hour
    land(spark, path, HOUR_2, 2**41, "id bigint")
    land(spark, path, NEXT_DAY, Decimal("1.5"), "id decimal(4,1)")
    out = read_raw(spark, path)
    assert out.schema["id"].dataType == T.DecimalType(21, 1)
    assert rows(out, "id") == sorted([(Decimal(v),) for v in ("1.0", f"{2**40}.0", f"{2**41}.0", "1.5")], key=str)
    assert rows(read_raw(spark, path, since=HOUR_2), "id") == sorted([(Decimal(f"{2**41}.0"),), (Decimal("1.5"),)], key=str)
    land(spark, path, NEXT_DAY, "x", "id string")
    assert rows(read_raw(spark, path), "id") == [("1",), ("1.5",), (str(2**40),), (str(2**41),), ("x",)]
    land(spark, path, NEXT_DAY, [1], "id array<int>")
    with pytest.raises(TypeError, match="column 'id'"):
        read_raw(spark, path)


def test_files_from_before_the_ledger_are_opened(spark, tmp_path, rows):
    path = str(tmp_path / "raw")
    land(spark, path, HOUR_1, 1)
    raw_files.delete(spark, f"{path}/_loads")
    land(spark, path, HOUR_1, 2**40, "id bigint")
    assert rows(read_raw(spark, path), "id") == [(1,), (2**40,)]


def test_long_replaced_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(KEPT_VERSIONS + 2):
        publish(spark.range(1), path)
    assert len(versions(spark, path)) == KEPT_VERSIONS


def test_a_sync_that_is_overtaken_reads_the_configs_again(spark, tmp_path, rows, monkeypatch):
    control, lines = str(tmp_path / "control"), tmp_path / "lines.csv"
    lines.write_text("line,table_name,database_name,partition_col\n1,a,shop,id\n")
    seed(spark, str(lines), control, "line")
    own, calls = admin.sync_config, []

    def sync(config):
        calls.append(config)
        if len(calls) == 2:  # both configs are read; a table is added and synced before this one ends
            lines.write_text("line,table_name,database_name,partition_col\n1,b,shop,id\n")
            seed(spark, str(lines), control, "line")
            sync_all(spark, control)
        return own(config)

    monkeypatch.setattr(admin, "sync_config", sync)
    sync_all(spark, control)
    merge = T.StructType([*MERGE_CONFIG.fields, T.StructField("kind", T.StringType())])
    assert rows(read_current(spark, f"{control}/merge_config", merge), "table_name") == [("a",), ("b",)]


def test_snapshots_of_two_jobs_are_all_listed(spark, tmp_path, rows):
    taken = [datetime(2025, 1, d) for d in (1, 2, 3, 4)]
    in_threads(spark, lambda at: snapshot_tables(spark, {"t": spark.range(1)}, str(tmp_path), at), taken, 4)
    assert len(rows(read_current(spark, f"{tmp_path}/manifest", SNAPSHOT_MANIFEST))) == 4
    in_threads(spark, lambda days: expire_snapshots(spark, str(tmp_path), datetime(2025, 2, 1), days), [30, 29, 29], 3)
    assert rows(read_current(spark, f"{tmp_path}/manifest", SNAPSHOT_MANIFEST), "created_at") == [(datetime(2025, 1, 3),), (datetime(2025, 1, 4),)]


def test_lines_that_do_not_parse_are_kept_as_they_are(spark, tmp_path, rows):
    control, csv = str(tmp_path / "control"), tmp_path / "lines.csv"
    bad = ["2,b", "3,c,shop,id,x,y", "x4,d,shop,id", '5,"e,shop,id']
    csv.write_text("\n".join(["line,table_name,database_name,partition_col", "1,a,shop,id", *bad, "6,,shop,id", '7,"f,g",shop,id', ""]))
    seed(spark, str(csv), control, "line")
    assert rows(load_config(spark, f"{control}/stream_config"), "table_name") == [("a",), ("f,g",)]
    rejected = spark.read.parquet(f"{control}/rejected_config")
    assert rows(rejected, "reason", "damaged_line") == sorted([("damaged", b) for b in bad] + [("unnamed", None)], key=str)
    assert rows(rejected.filter("reason = 'unnamed'").select("database_name", "partition_col")) == [("shop", "id")]
    assert read_load_config_csv(spark, str(csv)).count() == 4  # without a number column, x4 is a line like any other


def test_seed_and_sync(spark, tmp_path, rows):
    control, csv = str(tmp_path / "control"), tmp_path / "lines.csv"
    csv.write_text("line,table_name,database_name,partition_col\n1, a ,shop,id\n2,b,shop,\n3,b,shop,key\n")
    seed(spark, str(csv), control, "line")
    seed(spark, str(csv), control, "line", kind="batch")
    config = load_config(spark, f"{control}/stream_config", "shop")
    assert rows(config, "table_name", "load_type", "partition_col", "is_partitioned") == [
        ("a", "full_load", "id", None),
        ("b", "full_load", "key", None),
    ]
    assert load_config(spark, f"{control}/stream_config", "other").count() == 0
    sync_all(spark, control)
    merge = spark.read.parquet(f"{control}/merge_config/v=0000000001")
    assert rows(merge) == [
        ("shop", "a", "id", "batch"),
        ("shop", "a", "id", "stream"),
        ("shop", "b", "key", "batch"),
        ("shop", "b", "key", "stream"),
    ]


def test_backup_and_retention(spark, tmp_path, rows):
    control, backups = str(tmp_path / "control"), str(tmp_path / "backups")
    publish(control_rows(spark, [("d", "t", *[None] * 6)], LOAD_CONFIG), f"{control}/batch_config")
    publish(spark.range(3), f"{control}/state")
    backup(spark, " batch_config , state", control, backups, datetime(2025, 1, 1, 0, 0, 5), 30)
    assert spark.read.parquet(f"{backups}/state-backup-2025-01-01-00-00-05").count() == 3
    # Exactly as old as allowed stays, a second older goes.
    assert backup(spark, "state", control, backups, datetime(2025, 1, 31, 0, 0, 5), 30) == 0
    assert backup(spark, "state", control, backups, datetime(2025, 1, 31, 0, 0, 6), 30) == 2
    assert not exists(spark, f"{backups}/state-backup-2025-01-01-00-00-05")
    left = read_current(spark, f"{backups}/manifest", SNAPSHOT_MANIFEST)
    assert rows(left, "backup_name") == [("state-backup-2025-01-31-00-00-05",), ("state-backup-2025-01-31-00-00-06",)]
