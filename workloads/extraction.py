"""Scans, change extraction, timestamps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import (
    cdc_cutoff,
    format_watermark,
    load_partition,
    parse_timestamp,
    parse_watermark,
    unreadable,
)
from tidemark.operators.cdc import (
    append_extract,
    cdc_filter,
    clean_zero_dates,
    count_unreadable,
    new_watermark,
    raw_high_mark,
    raw_since,
    split_bounds,
    stamp,
)
from tidemark.operators.splits import split_of, split_points
from tidemark.sources.databases import LOOKBACK_MINUTES, source_for
from workloads.inputs import (
    ORDERS_BACK,
    ORDERS_CUT,
    ORDERS_SRC,
    T1,
    Query,
    between,
    orders_src,
    sql_ts,
    table,
)

CHANGE_COLS = ["created_at", "updated_at", "status_at"]
CUTOFF = "2001-07-01 10:13:00"
FAR = "2100-01-01 00:00:00"


def full_scan(spark: SparkSession, sf: str) -> DataFrame:
    return source_for("parquet", sf, suffix=".parquet").extract(spark, "orders")


def source_extract(spark: SparkSession, sf: str) -> DataFrame:
    source = source_for("parquet", sf, suffix=".parquet")
    return source.extract(spark, "lineitem", ["l_shipdate"], "2000-06-30 00:00:00")


def cdc_extract(spark: SparkSession, sf: str) -> DataFrame:
    return cdc_filter(orders_src(spark, sf), CHANGE_COLS, CUTOFF)


def cdc_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("event_type") == "view", F.substring(F.col("ts").cast("string"), 1, 19)).otherwise(
        F.col("ts").cast("string")
    )
    mark = parse_watermark(text)
    return table(spark, sf, "events").select(
        "event_id",
        cdc_cutoff(mark, LOOKBACK_MINUTES["batch"]).alias("batch_cutoff"),
        cdc_cutoff(mark, LOOKBACK_MINUTES["stream"]).alias("stream_cutoff"),
    )


def bounds(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    none = between(orders, "o_orderdate", after=FAR)
    recent = cdc_filter(orders_src(spark, sf), CHANGE_COLS, CUTOFF)
    named = {"all": orders, "changed": recent, "none": none}
    parts = [split_bounds(df, "o_orderkey").withColumn("extract", F.lit(n)) for n, df in named.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def time_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return split_bounds(table(spark, sf, "lineitem"), "l_shipdate")


def balanced_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """For split columns of several kinds and shapes: rows over all parts of a read in ten, and whether the
    largest part is within 1.3 of the mean."""
    key = F.col("l_orderkey")
    wide = key.cast("double")  # cubes of keys from 2,097,152 on are no bigint
    lines = table(spark, sf, "lineitem").select(
        key.alias("even"),
        (wide * wide * wide).alias("skewed"),
        F.when(key % 20 != 0, F.concat(F.lit("order/"), key)).alias("text"),
        F.concat(F.when(key % 10 < 8, F.lit("a-common-prefix/")).otherwise(F.substring(F.md5(key.cast("string")), 1, 3)), key).alias("clustered"),
        F.col("l_shipdate").alias("time"),
    )
    parts = []
    for name in lines.columns:
        part = split_of(lines, name, split_points(lines, name, 10)).alias("part")
        sizes = lines.select(part).groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
        within = (F.max("rows") <= 1.3 * F.avg("rows")) & (F.count(F.lit(1)) >= 9)
        parts.append(sizes.agg(F.lit(name).alias("split_col"), F.sum("rows").alias("rows"), within.alias("balanced")))
    return reduce(DataFrame.unionByName, parts)


# Per event type one of the accepted shapes of timestamp text, or none of them.
def _texts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("ts").cast("string")
    day, clock, fraction = F.substring(text, 1, 10), F.substring(text, 12, 8), F.substring(text, 20, 7)
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "view", F.concat_ws(" ", day, clock))
        .when(kind == "click", F.concat(day, F.lit("T"), clock, fraction, F.lit("Z")))
        .when(kind == "signup", F.concat(day, F.lit("T"), clock, F.lit("Z")))
        .when(kind == "purchase", F.concat(day, F.lit(" "), clock, fraction))
        .otherwise(F.concat(F.lit("at "), text))
        .alias("text"),
    )


_TEXTS = """texts as (
  select event_id,
         case event_type when 'view' then strftime(ts, '%Y-%m-%d %H:%M:%S')
              when 'click' then strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
              when 'signup' then strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
              when 'purchase' then strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
              else 'at ' || cast(ts as varchar) end as text
  from events)"""


def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parse_timestamp("text")
    return _texts(spark, sf).select("event_id", parsed.alias("parsed"), unreadable("text", parsed).alias("unreadable"))


def unreadable_texts(spark: SparkSession, sf: str) -> DataFrame:
    """How many texts of the feed and of orders with zero dates are no times."""
    zero = F.when(F.col("o_orderstatus") == "P", "0000-00-00 00:00:00").otherwise(F.col("o_orderdate").cast("string"))
    orders = table(spark, sf, "orders").select(zero.alias("text"))
    parts = {"events": _texts(spark, sf), "orders": orders}
    counts = [count_unreadable(df, ["text"]).withColumn("table_name", F.lit(t)) for t, df in parts.items()]
    return counts[0].unionByName(counts[1])


def watermark_text(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.col("event_type") == "view"
    ts = F.when(whole, F.substring(F.col("ts").cast("string"), 1, 19).cast("timestamp_ntz")).otherwise(F.col("ts"))
    return table(spark, sf, "events").select("event_id", format_watermark(ts).alias("watermark"))


def zero_dates(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", "0000-00-00 00:00:00").otherwise(
        F.col("o_orderdate").cast("string")
    )
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("changed_at"))
    return clean_zero_dates(rows, ["changed_at"])


def source_watermark(spark: SparkSession, sf: str) -> DataFrame:
    rows = orders_src(spark, sf)
    one = new_watermark(rows, ["updated_at"]).withColumn("columns", F.lit("updated_at"))
    return new_watermark(rows, CHANGE_COLS).withColumn("columns", F.lit("all")).unionByName(one)


def stamp_rows(spark: SparkSession, sf: str) -> DataFrame:
    return stamp(table(spark, sf, "orders"), T1)


def load_partitions(spark: SparkSession, sf: str) -> DataFrame:
    date, hour = load_partition(F.col("ts"))
    rows = table(spark, sf, "events").select(date.alias("load_date"), hour.alias("load_hour"))
    return rows.groupBy("load_date", "load_hour").agg(F.count(F.lit(1)).alias("rows"))


def append_overlap(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    first, second = between(orders, "o_orderdate", up_to=ORDERS_CUT), between(orders, "o_orderdate", after=ORDERS_BACK)
    return append_extract(first, second)


def _stamped(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumnRenamed("ts", "insert_timestamp")


def raw_incremental_scan(spark: SparkSession, sf: str) -> DataFrame:
    raw = _stamped(spark, sf)
    later = raw_since(raw, "2024-01-10 00:00:00", "2024-01-20 12:00:00").withColumn("run", F.lit("later"))
    return later.unionByName(raw_since(raw, None, "2024-01-20 12:00:00").withColumn("run", F.lit("first")))


def raw_high_marks(spark: SparkSession, sf: str) -> DataFrame:
    raw = _stamped(spark, sf)
    news = raw_high_mark(raw, "2024-01-20 00:00:00").withColumn("run", F.lit("news"))
    return news.unionByName(raw_high_mark(raw, FAR).withColumn("run", F.lit("no news")))


QUERIES = {
    "full_scan": Query(full_scan, "select * from orders"),
    "source_extract": Query(
        source_extract, "select * from lineitem where l_shipdate > timestamp '2000-06-30 00:00:00'"
    ),
    "cdc_extract": Query(
        cdc_extract,
        f"with {ORDERS_SRC} select * from orders_src where created_at > {sql_ts(CUTOFF)}"
        f" or updated_at > {sql_ts(CUTOFF)} or status_at > {sql_ts(CUTOFF)}",
    ),
    "cdc_cutoff": Query(
        cdc_cutoffs,
        """select event_id, date_trunc('minute', ts - interval 10 minute) as batch_cutoff,
                  date_trunc('minute', case when event_type = 'view' then date_trunc('second', ts) else ts end
                             - interval 5 minute) as stream_cutoff
           from events""",
    ),
    "split_bounds": Query(
        bounds,
        f"""with {ORDERS_SRC}
            select 'all' as extract, coalesce(min(o_orderkey), 0) as min_val, coalesce(max(o_orderkey), 0) as max_val
            from orders
            union all
            select 'changed', coalesce(min(o_orderkey), 0), coalesce(max(o_orderkey), 0) from orders_src
            where greatest(created_at, updated_at, status_at) > {sql_ts(CUTOFF)}
            union all
            select 'none', coalesce(min(o_orderkey), 0), coalesce(max(o_orderkey), 0) from orders
            where o_orderdate > {sql_ts(FAR)}""",
    ),
    "split_bounds_balanced": Query(
        balanced_bounds,
        """select split_col, cast(count(*) as bigint) as rows, true as balanced
           from lineitem, (values ('even'), ('skewed'), ('text'), ('clustered'), ('time')) as c (split_col) group by split_col""",
    ),
    "split_bounds_time": Query(
        time_bounds, "select min(l_shipdate) as min_val, max(l_shipdate) as max_val from lineitem"
    ),
    "parse_timestamps": Query(
        parse_timestamps,
        f"""with {_TEXTS}
            select event_id, try_strptime(text, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S.%fZ',
                                                 '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%d %H:%M:%S.%f']) as parsed,
                   parsed is null as unreadable
            from texts""",
    ),
    "unreadable_texts": Query(
        unreadable_texts,
        f"""with {_TEXTS}
            select 'events' as table_name, count(*) filter (text like 'at %') as text from texts
            union all select 'orders', cast(0 as bigint)""",
    ),
    "format_watermark": Query(
        watermark_text,
        """select event_id, case when event_type = 'view' or microsecond(ts) % 1000000 = 0
                                 then strftime(ts, '%Y-%m-%d %H:%M:%S')
                                 else strftime(ts, '%Y-%m-%d %H:%M:%S.%f') end as watermark
           from events""",
    ),
    "zero_date_to_null": Query(
        zero_dates,
        "select o_orderkey, case when o_orderstatus <> 'P' then o_orderdate end as changed_at from orders",
    ),
    "source_watermark": Query(
        source_watermark,
        f"""with {ORDERS_SRC}
            select 'all' as columns, greatest(max(created_at), max(updated_at), max(status_at)) as watermark
            from orders_src
            union all select 'updated_at', max(updated_at) from orders_src""",
    ),
    "stamp_rows": Query(stamp_rows, f"select *, {sql_ts(T1)} as insert_timestamp from orders"),
    "load_partitions": Query(
        load_partitions,
        """select strftime(ts + interval 330 minute, '%Y-%m-%d') as load_date,
                  strftime(ts + interval 330 minute, '%H') as load_hour, count(*) as rows
           from events group by 1, 2""",
    ),
    "append_overlap": Query(
        append_overlap,
        f"""select * from orders where o_orderdate <= {sql_ts(ORDERS_CUT)}
            union all select * from orders where o_orderdate > {sql_ts(ORDERS_BACK)}""",
    ),
    "raw_incremental_scan": Query(
        raw_incremental_scan,
        """select event_id, ts as insert_timestamp, user_id, event_type, value, props, 'later' as run from events
           where ts > timestamp '2024-01-10 00:00:00' and ts <= timestamp '2024-01-20 12:00:00'
           union all
           select event_id, ts, user_id, event_type, value, props, 'first' from events
           where ts <= timestamp '2024-01-20 12:00:00'""",
    ),
    "raw_high_mark": Query(
        raw_high_marks,
        f"""select 'news' as run, max(ts) as insert_timestamp from events where ts > timestamp '2024-01-20 00:00:00'
            union all
            select 'no news', coalesce(max(ts) filter (ts > {sql_ts(FAR)}), {sql_ts(FAR)}) from events""",
    ),
}
