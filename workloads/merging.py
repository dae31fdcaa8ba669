"""Newest row per key, upsert, merge jobs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cdc import raw_since, stamp
from tidemark.operators.config import KEY, advance_merge_watermark
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.reconcile import differing_keys
from tidemark.operators.upsert import merge_inserts, merge_matched, merge_stats, upsert
from tidemark.plans.merge import merge_schema, merge_table
from tidemark.plans.pools import in_threads
from tidemark.session import work_dir
from tidemark.sources.raw import PARTITIONS, finished_loads, read_raw, write_raw
from tidemark.schemas import MERGE_STATE
from tidemark.sources.staging import StagingTable
from tidemark.sources.storage import read_current
from workloads.inputs import (
    EVENTS_BACK,
    EVENTS_CUT,
    ORDERS_BACK,
    ORDERS_CUT,
    T1,
    T2,
    T2_LATER,
    T3,
    Query,
    between,
    sql_ts,
    table,
)

LINE_KEY = ["l_orderkey", "l_linenumber"]


def newest_event(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_latest(table(spark, sf, "events"), ["user_id"], ["ts"])


def newest_line(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe_latest(table(spark, sf, "lineitem"), LINE_KEY, ["l_shipdate"])


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Users' newest events up to a cut, merged with those of the load that follows it."""
    events = table(spark, sf, "events")
    target = dedupe_latest(between(events, "ts", up_to=EVENTS_CUT), ["user_id"], ["ts"])
    source = dedupe_latest(between(events, "ts", after=EVENTS_BACK), ["user_id"], ["ts"])
    return upsert(target, source, ["user_id"])


def merge_upsert_composite(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines by key, where the row shipped later wins also when its load came first."""
    lines = table(spark, sf, "lineitem")
    returned = F.col("l_returnflag") == "R"
    target = dedupe_latest(lines.filter(returned), LINE_KEY, ["l_shipdate"])
    source = dedupe_latest(lines.filter(~returned), LINE_KEY, ["l_shipdate"])
    return upsert(target, source, LINE_KEY, newer_by=["l_shipdate"])


def _order_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    return between(orders, "o_orderdate", up_to=ORDERS_CUT), between(orders, "o_orderdate", after=ORDERS_BACK)


def matched(spark: SparkSession, sf: str) -> DataFrame:
    return merge_matched(*_order_sides(spark, sf), ["o_orderkey"])


def inserts(spark: SparkSession, sf: str) -> DataFrame:
    return merge_inserts(*_order_sides(spark, sf), ["o_orderkey"])


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return merge_stats(*_order_sides(spark, sf), ["o_orderkey"])


def merge_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """One table per event type and user: the state up to a cut, and what came after it."""
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("schema_name"), F.col("user_id").cast("string").alias("table_name"), "ts"
    )
    mark = F.max("ts").alias("insert_timestamp")
    state = between(events, "ts", up_to="2024-01-15 00:00:00").groupBy("schema_name", "table_name").agg(mark)
    fresh = between(events, "ts", after="2024-01-15 00:00:00").groupBy("schema_name", "table_name").agg(mark)
    return advance_merge_watermark(state, fresh)


def _land(rows: DataFrame, raw: str, at: datetime) -> None:
    write_raw(stamp(rows, at), raw, at, "append")


def merged_table(spark: SparkSession, sf: str) -> DataFrame:
    base = work_dir(spark, "merge_table")
    events = table(spark, sf, "events")
    staging = StagingTable(spark, f"{base}/staging", ["user_id"])
    _land(between(events, "ts", up_to=EVENTS_CUT), f"{base}/raw", T1)
    merge_table(spark, f"{base}/raw", staging, ["ts"])
    _land(between(events, "ts", after=EVENTS_BACK), f"{base}/raw", T2)
    merge_table(spark, f"{base}/raw", staging, ["ts"])
    return staging.read()


def merged_by_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """``merge_table`` with increments beyond the broadcast limit, into buckets that double."""
    base = work_dir(spark, "merge_table_shuffled")
    events = table(spark, sf, "events")
    staging = StagingTable(
        spark, f"{base}/staging", ["user_id"], buckets=2, bucket_bytes=4096, max_buckets=8, broadcast_bytes=-1
    )
    loads = [(T1, None, EVENTS_CUT), (T2, EVENTS_BACK, "2024-01-25 00:00:00"), (T3, "2024-01-24 23:50:00", None)]
    for at, after, up_to in loads:
        _land(between(events, "ts", after, up_to), f"{base}/raw", at)
        merge_table(spark, f"{base}/raw", staging, ["ts"])
    return staging.read()


def reconciled(spark: SparkSession, sf: str) -> DataFrame:
    """What differs between orders and their staging table, of which some rows were changed, lost, added,
    brought twice, or have another NULL, and whose key has become wider."""
    base = work_dir(spark, "reconcile_tables")
    orders, key = table(spark, sf, "orders"), F.col("o_orderkey")
    staging = StagingTable(spark, f"{base}/staging", ["o_orderkey"])
    _land(orders, f"{base}/raw", T1)
    merge_table(spark, f"{base}/raw", staging)
    copy = staging.read()
    damaged = copy.filter(key % 89 != 3).withColumns({
        "o_totalprice": F.when(key % 97 == 0, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")),
        "o_orderpriority": F.when(key % 101 != 0, F.col("o_orderpriority")),
        "o_orderkey": key.cast("decimal(20,0)"),
    })
    extra = copy.withColumn("o_orderkey", key.cast("decimal(20,0)"))
    added = extra.filter((key % 103 == 0) & (key > 0)).withColumn("o_orderkey", -F.col("o_orderkey"))
    damaged = damaged.unionByName(added).unionByName(extra.filter(key % 107 == 0))
    found = differing_keys(orders, damaged, ["o_orderkey"], fan=64)
    return found.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


# Loads of events in the order in which they finish: the second one comes last.
OUT_OF_TURN = [
    (T1, None, EVENTS_CUT),
    (T3, "2024-01-24 23:50:00", None),
    (T2, EVENTS_BACK, "2024-01-25 00:00:00"),
]


def merged_out_of_turn(spark: SparkSession, sf: str) -> DataFrame:
    """Staging after three loads, of which the second by its stamp finished last."""
    base = work_dir(spark, "merge_out_of_order")
    staging = StagingTable(spark, f"{base}/staging", ["user_id"])
    for at, after, up_to in OUT_OF_TURN:
        _land(between(table(spark, sf, "events"), "ts", after, up_to), f"{base}/raw", at)
        merge_table(spark, f"{base}/raw", staging, ["ts"])
    return staging.read()


def raw_out_of_turn(spark: SparkSession, sf: str) -> DataFrame:
    """The increment of RAW after the first and the third load were merged and the second landed."""
    base = work_dir(spark, "raw_incremental_out_of_order")
    staging = StagingTable(spark, f"{base}/staging", ["user_id"])
    for at, after, up_to in OUT_OF_TURN:
        _land(between(table(spark, sf, "events"), "ts", after, up_to), f"{base}/raw", at)
        if at != T2:
            merge_table(spark, f"{base}/raw", staging, ["ts"])
    last, merged = staging.high_mark(), staging.merged_loads()
    late = [load.stamp for load in finished_loads(spark, f"{base}/raw") if load.id not in merged]
    return raw_since(read_raw(spark, f"{base}/raw", since=last, also=late), last, also=late).drop(*PARTITIONS)


def widened(spark: SparkSession, sf: str) -> DataFrame:
    """Orders merged from three loads whose columns grow: whole numbers to longer ones and to decimals,
    decimals to more digits, dates to times, and a number to text. Two of them land in one hour."""
    base = work_dir(spark, "merge_widened")
    orders = table(spark, sf, "orders")
    price = F.col("o_totalprice")
    plain = orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("customer"),
        price.cast("decimal(12,1)").alias("price"),
        F.col("o_orderdate").cast("date").alias("ordered"),
        F.col("o_custkey").cast("int").alias("code"),
        "o_orderdate",
    )
    grown = orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("bigint").alias("customer"),
        price.cast("decimal(16,2)").alias("price"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("ordered"),
        F.concat(F.lit("c"), F.col("o_custkey")).alias("code"),
        "o_orderdate",
    )
    longer = grown.withColumn("customer", F.col("customer").cast("decimal(20,1)"))
    staging = StagingTable(spark, f"{base}/staging", ["o_orderkey"])
    loads = [(T1, plain, None, "1996-01-01 00:00:00"), (T2, grown, "1995-01-01 00:00:00", ORDERS_CUT), (T2_LATER, longer, ORDERS_BACK, None)]
    for number, (at, rows, after, up_to) in enumerate(loads):
        _land(between(rows, "o_orderdate", after, up_to).drop("o_orderdate"), f"{base}/raw", at)
        if number != 1:
            merge_table(spark, f"{base}/raw", staging)
    return staging.read()


def _schema_change(spark: SparkSession, sf: str, limit: int) -> DataFrame:
    base = work_dir(spark, "merge_schema_change")
    orders = table(spark, sf, "orders")
    staging = StagingTable(spark, f"{base}/staging", ["o_orderkey"], broadcast_bytes=limit)
    later = between(orders, "o_orderdate", after=ORDERS_BACK)
    staging.merge(stamp(between(orders, "o_orderdate", up_to=ORDERS_CUT), T1))
    staging.merge(stamp(later.withColumn("urgent", F.col("o_orderpriority") < "3").drop("o_orderpriority"), T2))
    return staging.read()


def schema_change(spark: SparkSession, sf: str) -> DataFrame:
    """A later load lacks one column and has a new one; merged without a shuffle of the table and with."""
    parts = [_schema_change(spark, sf, n).withColumn("limit_bytes", F.lit(n).cast("bigint")) for n in (-1, 1 << 30)]
    return parts[0].unionByName(parts[1])


def null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose later load lost the key of pending orders: the rows of the table and the rejects."""
    base = work_dir(spark, "merge_null_keys")
    older, later = _order_sides(spark, sf)
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    staging = StagingTable(spark, f"{base}/staging", ["o_orderkey"])
    staging.merge(stamp(older, T1))
    later = later.withColumn("o_orderkey", key)
    staging.merge(stamp(later, T2))
    kept = staging.read().withColumn("kind", F.lit("merged"))
    rejects = staging.rejects().withColumn("kind", F.lit("rejected"))
    rejected = merge_stats(older, later, ["o_orderkey"]).first()["rejected"]
    return kept.unionByName(rejects).withColumn("rejected", F.lit(rejected).cast("bigint"))


def merged_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome of the second of two merges of the batch tables of a schema."""
    base = work_dir(spark, "merge_schema")
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    config = spark.createDataFrame(
        [
            ("shop", "orders", "o_orderkey", "batch"),
            ("shop", "lineitem", "l_orderkey, l_linenumber", "batch"),
            ("shop", "orders", "o_custkey", "stream"),
        ],
        [*KEY, "partition_col", "kind"],
    )

    def merge() -> DataFrame:
        return merge_schema(spark, config, "shop", "Batch", f"{base}/raw", f"{base}/staging")

    _land(between(orders, "o_orderdate", up_to=ORDERS_CUT), f"{base}/raw/shop/orders", T1)
    _land(between(lines, "l_shipdate", up_to=ORDERS_CUT), f"{base}/raw/shop/lineitem", T1)
    merge()
    _land(between(orders, "o_orderdate", after=ORDERS_BACK), f"{base}/raw/shop/orders", T2)
    _land(between(lines, "l_shipdate", after=ORDERS_BACK), f"{base}/raw/shop/lineitem", T2)
    return merge().drop("error")


def merge_state(spark: SparkSession, sf: str) -> DataFrame:
    """The merge state after two merges; the second has news of one table only."""
    base = work_dir(spark, "merge_state")
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    config = spark.createDataFrame(
        [("shop", "orders", "o_orderkey", "batch"), ("shop", "events", "user_id", "batch")],
        [*KEY, "partition_col", "kind"],
    )
    _land(between(orders, "o_orderdate", up_to=ORDERS_CUT), f"{base}/raw/shop/orders", T1)
    _land(events, f"{base}/raw/shop/events", T1)
    for late in (False, True):
        if late:
            _land(between(orders, "o_orderdate", after=ORDERS_BACK), f"{base}/raw/shop/orders", T2)
        merge_schema(spark, config, "shop", "batch", f"{base}/raw", f"{base}/staging", control=f"{base}/control")
    return read_current(spark, f"{base}/control/merge_state", MERGE_STATE)


def two_schemas(spark: SparkSession, sf: str) -> DataFrame:
    """The merge state after two schemas were merged at the same time on one control folder."""
    base = work_dir(spark, "merge_two_schemas")
    feeds = {"shop": ("orders", "o_orderkey"), "feed": ("events", "user_id")}
    config = spark.createDataFrame([(s, t, key, "batch") for s, (t, key) in feeds.items()], [*KEY, "partition_col", "kind"])
    for schema, (name, _) in feeds.items():
        _land(table(spark, sf, name), f"{base}/raw/{schema}/{name}", T1 if schema == "shop" else T2)

    def merge(schema: str) -> None:
        merge_schema(spark, config, schema, "batch", f"{base}/raw", f"{base}/staging", control=f"{base}/control")

    in_threads(spark, merge, list(feeds), len(feeds))
    return read_current(spark, f"{base}/control/merge_state", MERGE_STATE)


def schema_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """A config that repeats one table, names another in two spellings, and has a third once."""
    base = work_dir(spark, "merge_schema_repeats")
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    rows = [("orders", "o_orderkey"), (" orders ", "o_orderkey"), ("lines", "l_orderkey"), ("LINES", "l_orderkey"), ("events", "event_id")]
    config = spark.createDataFrame([("shop", *r, "batch") for r in rows], [*KEY, "partition_col", "kind"])
    for name, df in {"orders": orders, "lines": lines, "LINES": lines, "events": table(spark, sf, "events")}.items():
        _land(df, f"{base}/raw/shop/{name}", T1)
    done = merge_schema(spark, config, "shop", "batch", f"{base}/raw", f"{base}/staging")
    return done.select("table_name", "status", "updated", "inserted", "rejected")


QUERIES = {
    "dedupe_latest": Query(
        newest_event,
        """select event_id, ts, user_id, event_type, value, props
           from (select user_id, unnest(arg_max(struct_pack(event_id, ts, event_type, value, props), ts))
                 from events group by user_id)""",
    ),
    "dedupe_latest_composite": Query(
        newest_line,
        """select * from lineitem
           qualify row_number() over (
             partition by l_orderkey, l_linenumber
             order by l_shipdate desc nulls last, l_partkey desc nulls last, l_suppkey desc nulls last,
                      l_quantity desc nulls last, l_extendedprice desc nulls last, l_discount desc nulls last,
                      l_tax desc nulls last, l_returnflag desc nulls last, l_linestatus desc nulls last) = 1""",
    ),
    "merge_upsert": Query(
        merge_upsert, "select * from events qualify row_number() over (partition by user_id order by ts desc) = 1"
    ),
    "merge_upsert_composite": Query(
        merge_upsert_composite,
        # A tie on the ship date goes to the source, the lines that were not returned.
        """select * from lineitem
           qualify row_number() over (
             partition by l_orderkey, l_linenumber
             order by l_shipdate desc nulls last, l_returnflag <> 'R' desc, l_partkey desc nulls last,
                      l_suppkey desc nulls last, l_quantity desc nulls last, l_extendedprice desc nulls last,
                      l_discount desc nulls last, l_tax desc nulls last, l_returnflag desc nulls last,
                      l_linestatus desc nulls last) = 1""",
    ),
    "merge_matched": Query(
        matched,
        f"""select * from orders where o_orderdate > {sql_ts(ORDERS_BACK)} and o_orderkey in
            (select o_orderkey from orders where o_orderdate <= {sql_ts(ORDERS_CUT)})""",
    ),
    "merge_inserts": Query(
        inserts,
        f"""select * from orders where o_orderdate > {sql_ts(ORDERS_BACK)} and o_orderkey not in
            (select o_orderkey from orders where o_orderdate <= {sql_ts(ORDERS_CUT)})""",
    ),
    "merge_stats": Query(
        stats,
        f"""select count(*) filter (t.o_orderkey is not null and s.o_orderkey is not null) as updated,
                   count(*) filter (t.o_orderkey is null) as inserted,
                   count(*) filter (s.o_orderkey is null) as kept, cast(0 as bigint) as rejected
            from (select o_orderkey from orders where o_orderdate <= {sql_ts(ORDERS_CUT)}) t
            full join (select o_orderkey from orders where o_orderdate > {sql_ts(ORDERS_BACK)}) s
            on t.o_orderkey = s.o_orderkey""",
    ),
    "merge_watermark_advance": Query(
        merge_watermark,
        """select event_type as schema_name, cast(user_id as varchar) as table_name, max(ts) as insert_timestamp
           from events group by 1, 2""",
    ),
    "merge_table": Query(
        merged_table,
        f"""select *, case when ts > {sql_ts(EVENTS_BACK)} then {sql_ts(T2)} else {sql_ts(T1)} end as insert_timestamp
            from events qualify row_number() over (partition by user_id order by ts desc) = 1""",
    ),
    "merge_table_shuffled": Query(
        merged_by_shuffle,
        f"""select *, case when ts > timestamp '2024-01-24 23:50:00' then {sql_ts(T3)}
                           when ts > {sql_ts(EVENTS_BACK)} then {sql_ts(T2)} else {sql_ts(T1)} end as insert_timestamp
            from events qualify row_number() over (partition by user_id order by ts desc) = 1""",
    ),
    "merge_out_of_order": Query(
        merged_out_of_turn,
        f"""select *, case when ts > timestamp '2024-01-24 23:50:00' then {sql_ts(T3)}
                           when ts > {sql_ts(EVENTS_BACK)} then {sql_ts(T2)} else {sql_ts(T1)} end as insert_timestamp
            from events qualify row_number() over (partition by user_id order by ts desc) = 1""",
    ),
    "raw_incremental_out_of_order": Query(
        raw_out_of_turn,
        f"""select *, {sql_ts(T2)} as insert_timestamp from events
            where ts > {sql_ts(EVENTS_BACK)} and ts <= timestamp '2024-01-25 00:00:00'""",
    ),
    "merge_widened": Query(
        widened,
        f"""select o_orderkey, cast(o_custkey as decimal(21,1)) as customer,
                   cast(case when o_orderdate > timestamp '1995-01-01' then cast(o_totalprice as decimal(16,2))
                             else cast(cast(o_totalprice as decimal(12,1)) as decimal(16,2)) end as decimal(16,2)) as price,
                   cast(case when o_orderdate > timestamp '1995-01-01' then o_orderdate else cast(o_orderdate as date) end as timestamp) as ordered,
                   case when o_orderdate > timestamp '1995-01-01' then 'c' else '' end || o_custkey as code,
                   case when o_orderdate > {sql_ts(ORDERS_BACK)} then {sql_ts(T2_LATER)}
                        when o_orderdate > timestamp '1995-01-01' then {sql_ts(T2)} else {sql_ts(T1)} end as insert_timestamp
            from orders""",
    ),
    "reconcile_tables": Query(
        reconciled,
        """select o_orderkey, case when o_orderkey % 89 = 3 and o_orderkey % 107 <> 0 then 'missing_right' else 'different' end as finding
           from orders
           where o_orderkey % 89 = 3 and not (o_orderkey % 107 = 0)
              or o_orderkey % 89 <> 3 and (o_orderkey % 97 = 0 or o_orderkey % 101 = 0 or o_orderkey % 107 = 0)
           union all
           select -o_orderkey, 'missing_left' from orders where o_orderkey % 103 = 0 and o_orderkey > 0""",
    ),
    "merge_schema_change": Query(
        schema_change,
        f"""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                   case when o_orderdate <= {sql_ts(ORDERS_BACK)} then o_orderpriority end as o_orderpriority,
                   case when o_orderdate > {sql_ts(ORDERS_BACK)} then o_orderpriority < '3' end as urgent,
                   case when o_orderdate > {sql_ts(ORDERS_BACK)} then {sql_ts(T2)} else {sql_ts(T1)} end
                     as insert_timestamp,
                   limit_bytes
            from orders, (values (cast(-1 as bigint)), (1073741824)) as limits (limit_bytes)""",
    ),
    "merge_null_keys": Query(
        null_keys,
        f"""with later as (
              select * replace (case when o_orderstatus <> 'P' then o_orderkey end as o_orderkey)
              from orders where o_orderdate > {sql_ts(ORDERS_BACK)}),
            lost as (select * from later where o_orderkey is null),
            rows as (
              select *, {sql_ts(T2)} as insert_timestamp, 'merged' as kind from later where o_orderkey is not null
              union all
              select *, {sql_ts(T1)}, 'merged' from orders
              where o_orderdate <= {sql_ts(ORDERS_CUT)} and o_orderkey not in
                (select o_orderkey from later where o_orderkey is not null)
              union all
              select *, {sql_ts(T2)}, 'rejected' from lost)
            select *, (select count(*) from lost) as rejected from rows""",
    ),
    "merge_state": Query(
        merge_state,
        f"""select 'SHOP' as schema_name, 'ORDERS' as table_name,
                   case when count(*) filter (o_orderdate > {sql_ts(ORDERS_BACK)}) > 0 then {sql_ts(T2)}
                        else {sql_ts(T1)} end as insert_timestamp from orders
            union all
            select 'SHOP', 'EVENTS', {sql_ts(T1)} from events having count(*) > 0""",
    ),
    "merge_two_schemas": Query(
        two_schemas,
        f"""select 'SHOP' as schema_name, 'ORDERS' as table_name, {sql_ts(T1)} as insert_timestamp from orders having count(*) > 0
            union all
            select 'FEED', 'EVENTS', {sql_ts(T2)} from events having count(*) > 0""",
    ),
    "merge_schema_repeats": Query(
        schema_repeats,
        """select 'ORDERS' as table_name, 'SUCCESS' as status, cast(0 as bigint) as updated, count(*) as inserted,
                  cast(0 as bigint) as rejected from orders
           union all
           select 'LINES', 'FAILED', null, null, null
           union all
           select 'EVENTS', 'SUCCESS', 0, count(*), 0 from events""",
    ),
    "merge_schema": Query(
        merged_schema,
        f"""with old_o as (select distinct o_orderkey k from orders where o_orderdate <= {sql_ts(ORDERS_CUT)}),
                 new_o as (select distinct o_orderkey k from orders where o_orderdate > {sql_ts(ORDERS_BACK)}),
                 old_l as (select distinct l_orderkey a, l_linenumber b from lineitem
                           where l_shipdate <= {sql_ts(ORDERS_CUT)}),
                 new_l as (select distinct l_orderkey a, l_linenumber b from lineitem
                           where l_shipdate > {sql_ts(ORDERS_BACK)})
            select 'SHOP' as schema_name, 'ORDERS' as table_name, 'SUCCESS' as status,
                   (select count(*) from new_o where k in (from old_o)) as updated,
                   (select count(*) from new_o where k not in (from old_o)) as inserted,
                   cast(0 as bigint) as rejected, {sql_ts(T2)} as insert_timestamp
            union all
            select 'SHOP', 'LINEITEM', 'SUCCESS', (select count(*) from new_l semi join old_l using (a, b)),
                   (select count(*) from new_l anti join old_l using (a, b)), cast(0 as bigint), {sql_ts(T2)}""",
    ),
}
