"""Load config, run state, registries, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import split_list
from tidemark.operators.config import (
    KEY,
    advance_source_watermark,
    catalogue_of,
    column_list,
    expired_snapshots,
    insert_values,
    invalid_config,
    merge_config,
    merge_task_for,
    ready,
    repeated_config,
    seed_config,
    snapshot_name,
    sync_config,
    tables_per_database,
    update_pairs,
)
from tidemark.plans.load_plan import load_plan
from tidemark.session import work_dir
from tidemark.plans.admin import seed
from tidemark.sources.control import load_config, read_load_config_csv, snapshot_tables
from workloads.inputs import (
    LOAD_CONFIG,
    RUN_STATE,
    Query,
    clean,
    load_config_from,
    run_state_from,
    sql_ts,
    table,
)

NOW = "2001-08-01 00:00:00"
DAYS = 365
TAKEN = "2025-11-05 06:20:07"


def _config(spark: SparkSession, sf: str) -> DataFrame:
    return load_config_from(table(spark, sf, "customer"))


def _plan(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    plan = load_plan(_config(spark, sf), run_state_from(spark, sf), kind)
    return plan.drop("full_loaded_at").withColumn("change_cols", F.array_join("change_cols", ","))


def repeated_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Every table twice: with the same row, padded, or with another one, and then by line number."""
    config = _config(spark, sf)
    other = F.when(F.col("partition_col") == " o_orderkey ", F.lit("o_custkey")).otherwise(F.col("partition_col"))
    again = config.withColumns({"table_name": F.concat(F.lit(" "), "table_name", F.lit("\t")), "partition_col": other})
    both = config.withColumn("line", F.lit(1)).unionByName(again.withColumn("line", F.lit(2)))
    state = run_state_from(spark, sf)
    without = load_plan(both.drop("line"), state).withColumn("numbered", F.lit(False))
    plans = without.unionByName(load_plan(both, state, sequence="line").withColumn("numbered", F.lit(True)))
    return plans.select("numbered", *KEY, "merge_key", "action", "reason")


def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf, "batch")


def stream_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf, "stream")


def _plan_sql(splits: int, minutes: int) -> str:
    return f"""with {LOAD_CONFIG}, {RUN_STATE},
      cleaned as (
        select c.database_name, c.table_name, coalesce({clean("load_type")}, 'full_load') as load_type,
               concat_ws(',', {clean("incremental_col1")}, {clean("incremental_col2")},
                         {clean("incremental_col3")}) as change_cols,
               {clean("partition_col")} as merge_key,
               coalesce(upper({clean("is_partitioned")}) = 'TRUE', false) as ranged,
               try_strptime(last_updated_on, ['%Y-%m-%d %H:%M:%S.%f', '%Y-%m-%d %H:%M:%S']) as last_updated_on
        from load_config c left join run_state s
          on c.database_name = s.database_name and c.table_name = s.table_name),
      judged as (
        select *, case when load_type not in ('full_load', 'cdc_load') then 'unknown_load_type'
                       when load_type = 'full_load' then null
                       when last_updated_on is null then 'no_watermark'
                       when change_cols = '' then 'no_change_columns' end as reason
        from cleaned)
      select database_name, table_name, load_type, change_cols, merge_key,
             case when ranged then merge_key end as split_col,
             cast(case when ranged then {splits} else 1 end as integer) as splits,
             last_updated_on, reason,
             case when reason = 'unknown_load_type' then 'ERROR' when reason is not null then 'SKIPPED'
                  when load_type = 'full_load' then 'FULL' else 'CDC' end as action,
             case when reason is null and load_type = 'cdc_load'
                  then date_trunc('minute', last_updated_on - interval {minutes} minute) end as cutoff
      from judged"""


def validation(spark: SparkSession, sf: str) -> DataFrame:
    return invalid_config(_config(spark, sf)).select(*KEY, "missing")


def seeded(spark: SparkSession, sf: str) -> DataFrame:
    """One config line per order, for the table of its customer, and one per supplier; the CSV
    is written, read back and put over the config of the customers."""
    customer = table(spark, sf, "customer")
    lines = (
        table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_mktsegment").alias("database_name"),
            F.col("c_name").alias("table_name"),
            F.when(F.col("o_orderstatus") == "F", "full_load")
            .when(F.col("o_orderstatus") == "O", "cdc_load")
            .alias("load_type"),
            F.col("o_orderpriority").alias("incremental_col1"),
            F.lit(None).cast("string").alias("incremental_col2"),
            F.col("o_orderstatus").alias("incremental_col3"),
            F.col("o_orderkey").cast("string").alias("partition_col"),
            F.lit("TRUE").alias("is_partitioned"),
            F.col("o_orderkey").alias("line"),
        )
    )
    none = F.lit(None).cast("string")
    more = table(spark, sf, "supplier").select(
        F.lit("SUPPLY").alias("database_name"),
        F.col("s_name").alias("table_name"),
        F.lit("full_load").alias("load_type"),
        *[none.alias(f"incremental_col{i}") for i in (1, 2, 3)],
        F.lit("s_suppkey").alias("partition_col"),
        none.alias("is_partitioned"),
        F.col("s_suppkey").alias("line"),
    )
    path = work_dir(spark, "config_seed")
    lines.unionByName(more).write.option("header", True).csv(path)
    return seed_config(_config(spark, sf), read_load_config_csv(spark, path, "line"), "line")


def seeded_damaged(spark: SparkSession, sf: str) -> DataFrame:
    """Which lines of a file a seed accepts and which it rejects: some have too few cells or too many, a number
    that is none, or a quote that is left open."""
    base, key = work_dir(spark, "config_seed_damaged"), F.col("s_suppkey")
    named = F.concat(F.lit(",shop,t"), key)
    whole = F.concat(key, named, F.lit(",full_load,id"))
    line = (
        F.when(key % 10 == 6, F.concat(key, named))
        .when(key % 10 == 7, F.concat(whole, F.lit(",more,cells")))
        .when(key % 10 == 8, F.concat(F.lit("x"), whole))
        .when(key % 10 == 9, F.concat(key, F.lit(',shop,"t'), key, F.lit(",full_load,id")))
        .otherwise(whole)
    )
    header = spark.range(1).select(F.lit(-1).cast("bigint").alias("n"), F.lit("line,database_name,table_name,load_type,partition_col").alias("value"))
    lines = header.unionByName(table(spark, sf, "supplier").select(key.cast("bigint").alias("n"), line.alias("value")))
    lines.repartition(1).sortWithinPartitions("n").select("value").write.text(f"{base}/lines")
    seed(spark, f"{base}/lines", f"{base}/control", "line")
    accepted = load_config(spark, f"{base}/control/stream_config").select(F.lit("accepted").alias("outcome"), F.col("table_name").alias("line"))
    return accepted.unionByName(spark.read.parquet(f"{base}/control/rejected_config").select(F.col("reason").alias("outcome"), F.col("damaged_line").alias("line")))


def synced(spark: SparkSession, sf: str) -> DataFrame:
    return sync_config(_config(spark, sf))


def _kinds(spark: SparkSession, sf: str) -> DataFrame:
    stream = table(spark, sf, "supplier").select(
        F.lit("BUILDING").alias("database_name"),
        F.lower("s_name").alias("table_name"),
        F.lit("s_suppkey").alias("partition_col"),
        F.lit("stream").alias("kind"),
    )
    return synced(spark, sf).withColumn("kind", F.lit("batch")).unionByName(stream)


def lookup(spark: SparkSession, sf: str) -> DataFrame:
    config = _kinds(spark, sf)
    batch = merge_config(config, "BUILDING", "Batch").withColumn("asked", F.lit("Batch"))
    return batch.unionByName(merge_config(config, "BUILDING", "other").withColumn("asked", F.lit("other")))


def task_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer's nation as a database; nations of one region are registered by another
    name, and all twice, in different case."""
    other = F.when(F.col("n_regionkey") == 4, F.lit("former_")).otherwise("")
    nation = table(spark, sf, "nation").withColumn("n_name", F.concat(other, "n_name"))
    registry = nation.select(
        F.col("n_name").alias("database_name"),
        F.concat("n_name", F.lit("_DAILY_LOAD")).alias("task_name"),
        F.col("n_nationkey").alias("position"),
    ).unionByName(
        nation.select(
            F.lower("n_name").alias("database_name"),
            F.concat("n_name", F.lit("_SECOND_LOAD")).alias("task_name"),
            (F.col("n_nationkey") + 100).alias("position"),
        )
    )
    databases = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("Nation_"), F.col("c_nationkey")).alias("database_name")
    )
    return merge_task_for(registry, databases)


def per_database(spark: SparkSession, sf: str) -> DataFrame:
    return tables_per_database(_config(spark, sf))


def repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Config lines of all orders: keys that occur more than once."""
    lines = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("database_name"), F.col("o_custkey").cast("string").alias("table_name")
    )
    return repeated_config(lines)


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of two of the given tables, and one with a quote in its name."""
    lines = table(spark, sf, "lineitem")
    tables = {"orders": table(spark, sf, "orders"), "lineitem": lines.withColumn('net "price"', F.lit(0))}
    return catalogue_of(spark, tables)


def columns(spark: SparkSession, sf: str) -> DataFrame:
    return column_list(_catalogue(spark, sf))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return update_pairs(_catalogue(spark, sf))


def values(spark: SparkSession, sf: str) -> DataFrame:
    return insert_values(_catalogue(spark, sf))


_CATALOGUE = """catalogue as (
  select 'orders' as table_name, column_name, row_number() over () as ordinal_position from (describe orders)
  union all
  select 'lineitem', column_name, row_number() over () from (describe lineitem)
  union all
  select 'lineitem', 'net ""price""', 1000)"""


def _list_sql(item: str, alias: str) -> str:
    return f"""with {_CATALOGUE} select table_name, string_agg({item}, ', ' order by ordinal_position) as {alias}
               from catalogue group by table_name"""


def watermark_advance(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer the last finished order as state, the last other one as what an extract saw."""
    orders = table(spark, sf, "orders")

    def last(finished: bool, suffix: str) -> DataFrame:
        text = F.concat(F.max("o_orderdate").cast("string"), F.lit(suffix))
        return (
            orders.filter((F.col("o_orderstatus") == "F") == finished)
            .groupBy(F.lit("shop").alias("database_name"), F.col("o_custkey").cast("string").alias("table_name"))
            .agg(text.alias("last_updated_on"))
        )

    return advance_source_watermark(last(True, ".5"), last(False, ""))


def names(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer a comma list of two tables to copy."""
    listed = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ,\t"), F.col("c_name"))
    tables = table(spark, sf, "customer").select("c_custkey", F.explode(split_list(listed)).alias("table_name"))
    taken = F.lit(TAKEN).cast("timestamp_ntz")
    return tables.withColumn("backup_name", snapshot_name("table_name", taken))


def copies(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of two copied tables, read from where the manifest says they are."""
    frames = {"load_config": _config(spark, sf), "run_state": run_state_from(spark, sf)}
    manifest = snapshot_tables(spark, frames, work_dir(spark, "snapshots"), TAKEN).collect()
    path = {r["table_name"]: r["path"] for r in manifest}
    config = spark.read.parquet(path["load_config"]).select(*KEY, F.col("load_type").alias("value"))
    state = spark.read.parquet(path["run_state"]).select(*KEY, F.col("last_updated_on").alias("value"))
    return config.withColumn("copy", F.lit("load_config")).unionByName(state.withColumn("copy", F.lit("run_state")))


def retention(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a copy made on its date, some exactly as old as is allowed."""
    manifest = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("table_name"),
        snapshot_name("o_orderpriority", F.col("o_orderdate")).alias("backup_name"),
        F.col("o_orderdate").alias("created_at"),
    )
    gone = expired_snapshots(manifest, NOW, DAYS)
    return gone.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("deleted"), F.max("backup_name").alias("newest_deleted")
    )


def gate(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of the customers that have none pending."""
    orders = table(spark, sf, "orders").withColumn("database_name", F.col("o_custkey").cast("string"))
    status = orders.groupBy("database_name").agg(
        F.when(F.max((F.col("o_orderstatus") == "P").cast("int")) == 0, " true ")
        .otherwise("FALSE")
        .alias("is_extraction_complete"),
        F.lit("batch").alias("type"),
    )
    return ready(orders, status)


_SEED_SQL = f"""with {LOAD_CONFIG},
  lines as (
    select c_mktsegment as database_name, c_name as table_name,
           case o_orderstatus when 'F' then 'full_load' when 'O' then 'cdc_load' end as load_type,
           o_orderpriority as incremental_col1, cast(null as varchar) as incremental_col2,
           o_orderstatus as incremental_col3, cast(o_orderkey as varchar) as partition_col,
           'TRUE' as is_partitioned, o_orderkey as line
    from orders join customer on o_custkey = c_custkey
    union all
    select 'SUPPLY', s_name, 'full_load', null, null, null, 's_suppkey', null, s_suppkey from supplier),
  last_lines as (
    select * exclude (line) from lines
    qualify row_number() over (partition by database_name, table_name order by line desc) = 1)
  select * from last_lines
  union all
  select * from load_config c where not exists
    (select 1 from lines l where l.database_name = c.database_name and l.table_name = c.table_name)"""

QUERIES = {
    "load_plan": Query(batch_plan, _plan_sql(10, 10)),
    "load_plan_stream": Query(stream_plan, _plan_sql(2, 5)),
    "load_plan_repeats": Query(
        repeated_plan,
        f"""with plan as ({_plan_sql(10, 10)}),
              differs as (select *, coalesce(merge_key = 'o_orderkey', false) as other from plan)
            select false as numbered, database_name, table_name,
                   case when other then 'o_custkey' else merge_key end as merge_key,
                   case when other or reason = 'unknown_load_type' then 'ERROR' else action end as action,
                   case when other then 'repeated_config' else reason end as reason
            from differs
            union all
            select true, database_name, table_name, case when other then 'o_custkey' else merge_key end, action, reason
            from differs""",
    ),
    "config_validation": Query(
        validation,
        f"""with {LOAD_CONFIG}
            select database_name, table_name,
                   concat_ws(', ', case when {clean("database_name")} is null then 'database_name' end,
                             case when {clean("table_name")} is null then 'table_name' end,
                             case when {clean("partition_col")} is null then 'partition_col' end) as missing
            from load_config where missing <> ''""",
    ),
    "config_seed": Query(seeded, _SEED_SQL),
    "config_seed_damaged": Query(
        seeded_damaged,
        """select case when k % 10 < 6 then 'accepted' else 'damaged' end as outcome,
                  case when k % 10 < 6 then 't' || k
                       when k % 10 = 6 then k || ',shop,t' || k
                       when k % 10 = 7 then k || ',shop,t' || k || ',full_load,id,more,cells'
                       when k % 10 = 8 then 'x' || k || ',shop,t' || k || ',full_load,id'
                       else k || ',shop,"t' || k || ',full_load,id' end as line
           from (select s_suppkey as k from supplier)""",
    ),
    "config_sync": Query(
        synced,
        f"""with {LOAD_CONFIG} select {clean("database_name")} as database_name, {clean("table_name")} as table_name,
                   {clean("partition_col")} as partition_col from load_config""",
    ),
    "merge_config_lookup": Query(
        lookup,
        f"""with {LOAD_CONFIG}
            select upper(database_name) as database_name, upper(table_name) as table_name,
                   database_name as source_database, table_name as source_table,
                   {clean("partition_col")} as partition_col, 'Batch' as asked
            from load_config where database_name = 'BUILDING'
            union all
            select 'BUILDING', upper(s_name), 'BUILDING', lower(s_name), 's_suppkey', 'other' from supplier""",
    ),
    "merge_task_lookup": Query(
        task_lookup,
        """select c_custkey, 'Nation_' || c_nationkey as database_name,
                  case when n_regionkey <> 4 then n_name || '_DAILY_LOAD' end as task_name
           from customer left join nation on lower(n_name) = lower('Nation_' || c_nationkey)""",
    ),
    "tables_per_database": Query(
        per_database, "select c_mktsegment as database_name, count(*) as tables from customer group by 1"
    ),
    "config_repeats": Query(
        repeated,
        """select o_orderpriority as database_name, cast(o_custkey as varchar) as table_name, count(*) as rows
           from orders group by 1, 2 having count(*) > 1""",
    ),
    "column_list": Query(columns, _list_sql("""'"' || column_name || '"'""", "column_list")),
    "update_pairs": Query(
        pairs,
        _list_sql("""'target."' || column_name || '" = source."' || column_name || '"'""", "update_pairs"),
    ),
    "insert_values": Query(values, _list_sql("""'source."' || column_name || '"'""", "insert_values")),
    "source_watermark_advance": Query(
        watermark_advance,
        """with marks as (
             select cast(o_custkey as varchar) as table_name,
                    case when o_orderstatus = 'F' then o_orderdate + interval 500 millisecond
                         else o_orderdate end as mark
             from orders),
           last as (select table_name, max(mark) as mark from marks group by 1)
           select 'shop' as database_name, table_name,
                  strftime(mark, '%Y-%m-%d %H:%M:%S') ||
                  case when microsecond(mark) % 1000000 = 0 then '' else strftime(mark, '.%f') end as last_updated_on
           from last""",
    ),
    "snapshot_names": Query(
        names,
        """select c_custkey, table_name, table_name || '-backup-2025-11-05-06-20-07' as backup_name
           from (select c_custkey, unnest([c_mktsegment, c_name]) as table_name from customer)""",
    ),
    "snapshot_tables": Query(
        copies,
        f"""with {LOAD_CONFIG}, {RUN_STATE}
            select database_name, table_name, load_type as value, 'load_config' as copy from load_config
            union all
            select database_name, table_name, last_updated_on, 'run_state' from run_state""",
    ),
    "snapshot_retention": Query(
        retention,
        f"""select o_orderpriority as table_name, count(*) as deleted,
                   o_orderpriority || '-backup-' || strftime(max(o_orderdate), '%Y-%m-%d-%H-%M-%S') as newest_deleted
            from orders where o_orderdate < {sql_ts(NOW)} - interval {DAYS} day group by o_orderpriority""",
    ),
    "extraction_gate": Query(
        gate,
        """select cast(o_custkey as varchar) as database_name, * from orders
           where o_custkey not in (select o_custkey from orders where o_orderstatus = 'P')""",
    ),
}
