"""RAW files, ingest jobs, audit."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cdc import stamp
from tidemark.plans.ingest import ingest_database, ingest_table
from tidemark.plans.load_plan import load_plan
from tidemark.schemas import LOAD_CONFIG, RUN_STATE
from tidemark.session import work_dir
from tidemark.sources.control import read_audit
from tidemark.sources.databases import FileSource
from tidemark.sources.raw import raw_path, raw_table, read_raw, write_raw
from tidemark.sources.storage import control_rows, publish, read_current
from workloads.inputs import T1, T2, T2_LATER, T3, Query, between, sql_ts, table

MARK = "2024-01-15 00:09:30.500000"
RECENT = "2001-01-01 00:00:00"


def raw_layout(spark: SparkSession, sf: str) -> DataFrame:
    path = raw_path(work_dir(spark, "raw_layout"), "MySQL", "shop", "events")
    write_raw(stamp(table(spark, sf, "events"), T2), path, T2, "append")
    return read_raw(spark, path)


def _three_loads(spark: SparkSession, sf: str, label: str) -> str:
    """A full load, then in a later hour a change load and a full load again."""
    path = raw_path(work_dir(spark, label), "PostgreSQL", "shop", "orders")
    orders = table(spark, sf, "orders")
    write_raw(stamp(orders, T1), path, T1, "overwrite")
    write_raw(stamp(between(orders, "o_orderdate", after=RECENT), T2), path, T2, "append")
    write_raw(stamp(orders, T2_LATER), path, T2_LATER, "overwrite")
    return path


def full_load_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    return read_raw(spark, _three_loads(spark, sf, "full_load_overwrite"))


def raw_table_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = _three_loads(spark, sf, "raw_table")
    recent = between(table(spark, sf, "orders"), "o_orderdate", after=RECENT)
    write_raw(stamp(recent, T3), path, T3, "append")
    return raw_table(read_raw(spark, path, since=T2_LATER), T2_LATER)


def _source(sf: str) -> FileSource:
    return FileSource(sf, ".parquet")


def _config(spark: SparkSession, *rows: tuple) -> DataFrame:
    return control_rows(spark, [("shop", *r) for r in rows], LOAD_CONFIG)


def _state(spark: SparkSession, **marks: str) -> DataFrame:
    return control_rows(spark, [("shop", t, m, None) for t, m in marks.items()], RUN_STATE)


def _one_plan(spark: SparkSession, mark: str):
    config = _config(spark, ("events", "cdc_load", "ts", None, None, "event_id", "TRUE"))
    return load_plan(config, _state(spark, events=mark)).first()


def ingested_table(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "ingest_table")
    ingest_table(spark, _one_plan(spark, MARK), _source(sf), root, T3)
    return read_raw(spark, raw_path(root, "Files", "shop", "events"))


def empty_extract(spark: SparkSession, sf: str) -> DataFrame:
    """A change load that finds nothing after a full load: the files stay as they were."""
    root = work_dir(spark, "empty_extract")
    path = raw_path(root, "Files", "shop", "events")
    write_raw(stamp(table(spark, sf, "events"), T1), path, T1, "overwrite")
    done = ingest_table(spark, _one_plan(spark, "2100-01-01 00:00:00"), _source(sf), root, T2)
    return (
        read_raw(spark, path)
        .groupBy("insert_timestamp")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumns(
            {
                "status": F.lit(done.status),
                "row_count": F.lit(done.row_count).cast("bigint"),
                "last_updated_on": F.lit(done.last_updated_on).cast("string"),
            }
        )
    )


def _run_database(spark: SparkSession, sf: str, label: str) -> str:
    """Six tables: two full loads, a change load, and three that are skipped for cause."""
    base = work_dir(spark, label)
    config = _config(
        spark,
        ("orders", "full_load", "o_orderdate", None, None, "o_orderkey", "TRUE"),
        ("lineitem", None, None, None, None, "l_orderkey", "TRUE"),
        ("events", "cdc_load", " ts ", None, "", "event_id", None),
        ("part", "cdc_load", "p_size", None, None, "p_partkey", None),
        ("supplier", "snapshot", None, None, None, "s_suppkey", None),
        ("customer", "cdc_load", None, None, None, "c_custkey", None),
    )
    publish(config, f"{base}/control/batch_config")
    publish(_state(spark, events=MARK, customer=MARK), f"{base}/control/state")
    ingest_database(spark, "shop", _source(sf), f"{base}/raw", f"{base}/control", T3)
    return base


def ingested_database(spark: SparkSession, sf: str) -> DataFrame:
    """What landed per table, next to the state after the run."""
    base = _run_database(spark, sf, "ingest_database")
    state = read_current(spark, f"{base}/control/state", RUN_STATE)
    counts = [
        read_raw(spark, raw_path(f"{base}/raw", "Files", "shop", name))
        .groupBy("load_date", "load_hour")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("table_name", F.lit(name))
        for name in ("orders", "lineitem", "events")
    ]
    landed = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return landed.join(state.drop("database_name"), "table_name", "left")


class _Interrupted(FileSource):
    """A source whose first read of a table runs another job to its end."""

    def __init__(self, location: str, suffix: str, meanwhile: Callable[[], object]):
        super().__init__(location, suffix)
        object.__setattr__(self, "pending", [meanwhile])

    def extract(self, *args, **kwargs) -> DataFrame:
        while self.pending:
            self.pending.pop()()
        return super().extract(*args, **kwargs)


def two_databases(spark: SparkSession, sf: str) -> DataFrame:
    """The state after two databases were loaded on one control folder, the second one while the
    first was under way; both had watermarks before."""
    base = work_dir(spark, "ingest_two_databases")
    tables = [("events", "cdc_load", "ts", None, None, "event_id", None), ("orders", "full_load", "o_orderdate", None, None, "o_orderkey", None)]
    config = control_rows(spark, [(d, *t) for d in ("shop", "mirror") for t in tables], LOAD_CONFIG)
    publish(config, f"{base}/control/batch_config")
    publish(control_rows(spark, [(d, "events", MARK, None) for d in ("shop", "mirror")], RUN_STATE), f"{base}/control/state")

    def load(database: str, source: FileSource, at: datetime) -> None:
        ingest_database(spark, database, source, f"{base}/raw", f"{base}/control", at, workers=1)

    load("shop", _Interrupted(sf, ".parquet", lambda: load("mirror", _source(sf), T2)), T3)
    return read_current(spark, f"{base}/control/state", RUN_STATE)


def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    base = _run_database(spark, sf, "audit_log")
    return read_audit(spark, f"{base}/control/audit")


def _partition_sql(at: datetime) -> str:
    local = f"{sql_ts(at)} + interval 330 minute"
    return f"strftime({local}, '%Y-%m-%d') as load_date, strftime({local}, '%H') as load_hour"


_EVENTS_MARK = "timestamp '2024-01-14 23:59:00'"

QUERIES = {
    "raw_layout": Query(
        raw_layout, f"select *, {sql_ts(T2)} as insert_timestamp, {_partition_sql(T2)} from events"
    ),
    "full_load_overwrite": Query(
        full_load_overwrite,
        f"""select *, {sql_ts(T1)} as insert_timestamp, {_partition_sql(T1)} from orders
            union all
            select *, {sql_ts(T2_LATER)}, {_partition_sql(T2_LATER)} from orders""",
    ),
    "raw_table_overwrite": Query(
        raw_table_overwrite,
        f"""select *, {sql_ts(T2_LATER)} as insert_timestamp from orders
            union all
            select *, {sql_ts(T3)} from orders where o_orderdate > {sql_ts(RECENT)}""",
    ),
    "ingest_table": Query(
        ingested_table,
        f"""select *, {sql_ts(T3)} as insert_timestamp, {_partition_sql(T3)} from events
            where ts > {_EVENTS_MARK}""",
    ),
    "empty_extract": Query(
        empty_extract,
        f"""select {sql_ts(T1)} as insert_timestamp, count(*) as rows, 'SUCCESS' as status,
                   cast(0 as bigint) as row_count, cast(null as varchar) as last_updated_on from events""",
    ),
    "ingest_database": Query(
        ingested_database,
        f"""select 'orders' as table_name, {_partition_sql(T3)}, count(*) as rows,
                   strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as last_updated_on,
                   {sql_ts(T3)} as full_loaded_at from orders
            union all
            select 'lineitem', {_partition_sql(T3)}, count(*), null, {sql_ts(T3)} from lineitem
            union all
            select 'events', {_partition_sql(T3)}, count(*), strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f'), null
            from events where ts > {_EVENTS_MARK}""",
    ),
    "ingest_two_databases": Query(
        two_databases,
        f"""select database_name, 'events' as table_name, strftime(newest, '%Y-%m-%d %H:%M:%S.%f') as last_updated_on,
                   cast(null as timestamp) as full_loaded_at
            from (select max(ts) as newest from events where ts > {_EVENTS_MARK}), (values ('shop'), ('mirror')) as d (database_name)
            union all
            select database_name, 'orders', strftime(newest, '%Y-%m-%d %H:%M:%S'), loaded_at
            from (select max(o_orderdate) as newest from orders),
                 (values ('shop', {sql_ts(T3)}), ('mirror', {sql_ts(T2)})) as d (database_name, loaded_at)""",
    ),
    "audit_log": Query(
        audit_log,
        f"""with audit (table_name, status, row_count, error) as (
              select 'orders', 'SUCCESS', count(*), null from orders
              union all select 'lineitem', 'SUCCESS', count(*), null from lineitem
              union all select 'events', 'SUCCESS', count(*), null from events where ts > {_EVENTS_MARK}
              union all select 'part', 'SKIPPED', 0, 'no_watermark'
              union all select 'supplier', 'ERROR', 0, 'unknown_load_type'
              union all select 'customer', 'SKIPPED', 0, 'no_change_columns')
            select 'shop' as database_name, table_name, 'RAW' as layer, status, row_count,
                   {sql_ts(T3)} as inserted_at, error from audit""",
    ),
}
