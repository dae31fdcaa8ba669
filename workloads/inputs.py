"""The given tables, and the feeds, configs and states that the queries derive from them.

Each derivation is stated twice: as a DataFrame for Spark and as SQL for the check.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import ntz


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Load times of the runs the queries play through (UTC); two of them share an hour.
T1 = datetime(2025, 11, 5, 6, 20, 0)
T2 = datetime(2025, 11, 5, 19, 40, 0)
T2_LATER = datetime(2025, 11, 5, 19, 50, 0)
T3 = datetime(2025, 11, 6, 0, 5, 30)


def sql_ts(value: datetime | str) -> str:
    return f"timestamp '{value}'"


# Where feeds are cut into loads; the later load reaches back over the cut.
EVENTS_CUT, EVENTS_BACK = "2024-01-15 00:00:00", "2024-01-14 23:50:00"
ORDERS_CUT, ORDERS_BACK = "2000-01-01 00:00:00", "1999-12-01 00:00:00"


def orders_src(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with three change columns, two of them mostly NULL."""
    return table(spark, sf, "orders").withColumns(
        {
            "created_at": F.col("o_orderdate"),
            "updated_at": F.when(
                F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("interval 7 days")
            ),
            "status_at": F.when(
                F.col("o_orderpriority").startswith("1"), F.col("o_orderdate") + F.expr("interval 30 days")
            ),
        }
    )


ORDERS_SRC = """orders_src as (
  select *, o_orderdate as created_at,
         case when o_orderstatus = 'F' then o_orderdate + interval 7 day end as updated_at,
         case when o_orderpriority like '1%' then o_orderdate + interval 30 day end as status_at
  from orders)"""


def load_config_from(customer: DataFrame) -> DataFrame:
    """A load config with one table per customer, in one database per market segment."""
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    return customer.select(
        F.col("c_mktsegment").alias("database_name"),
        F.col("c_name").alias("table_name"),
        F.when(nation < 8, "full_load")
        .when(nation < 16, "cdc_load")
        .when(nation < 18, " cdc_load\t")
        .when(nation < 20, "")
        .when(nation >= 22, "snapshot")
        .alias("load_type"),
        F.when(balance >= 4000, " o_orderdate ").when(balance >= 2000, "  ").alias("incremental_col1"),
        F.when(balance >= 6000, "updated_at").alias("incremental_col2"),
        F.when(balance >= 8000, "\tstatus_at\n").otherwise("").alias("incremental_col3"),
        F.when(balance >= 1000, " o_orderkey ").otherwise(" ").alias("partition_col"),
        F.when(balance >= 5000, "TRUE")
        .when(balance >= 3000, " true ")
        .when(balance >= 1000, "FALSE")
        .alias("is_partitioned"),
    )


LOAD_CONFIG = """load_config as (
  select c_mktsegment as database_name, c_name as table_name,
         case when c_nationkey < 8 then 'full_load' when c_nationkey < 16 then 'cdc_load'
              when c_nationkey < 18 then ' cdc_load' || chr(9) when c_nationkey < 20 then ''
              when c_nationkey >= 22 then 'snapshot' end as load_type,
         case when c_acctbal >= 4000 then ' o_orderdate ' when c_acctbal >= 2000 then '  ' end as incremental_col1,
         case when c_acctbal >= 6000 then 'updated_at' end as incremental_col2,
         case when c_acctbal >= 8000 then chr(9) || 'status_at' || chr(10) else '' end as incremental_col3,
         case when c_acctbal >= 1000 then ' o_orderkey ' else ' ' end as partition_col,
         case when c_acctbal >= 5000 then 'TRUE' when c_acctbal >= 3000 then ' true '
              when c_acctbal >= 1000 then 'FALSE' end as is_partitioned
  from customer)"""

CLEAN = """nullif(trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '')"""


def clean(column: str) -> str:
    return CLEAN.format(column)


def run_state_from(spark: SparkSession, sf: str) -> DataFrame:
    """A run state: per customer with orders the date of the last urgent finished one, as text
    with or without a fraction, empty text, or NULL where there is none."""
    urgent = (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").startswith("1")
    last = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max(F.when(urgent, F.col("o_orderdate"))).cast("string").alias("last"))
    )
    balance = F.col("c_acctbal")
    text = (
        F.when(balance >= 9000, "")
        .when(balance >= 5000, F.concat("last", F.lit(".125000")))
        .otherwise(F.col("last"))
    )
    return (
        table(spark, sf, "customer")
        .join(last, "c_custkey")
        .select(
            F.col("c_mktsegment").alias("database_name"),
            F.col("c_name").alias("table_name"),
            text.alias("last_updated_on"),
            F.lit(None).cast("timestamp_ntz").alias("full_loaded_at"),
        )
    )


RUN_STATE = """run_state as (
  select c_mktsegment as database_name, c_name as table_name,
         case when c_acctbal >= 9000 then ''
              when c_acctbal >= 5000
              then strftime(max(o_orderdate) filter (urgent), '%Y-%m-%d %H:%M:%S') || '.125000'
              else strftime(max(o_orderdate) filter (urgent), '%Y-%m-%d %H:%M:%S') end as last_updated_on
  from customer join (select *, o_orderstatus = 'F' and o_orderpriority like '1%' as urgent from orders)
    on o_custkey = c_custkey
  group by c_mktsegment, c_name, c_acctbal)"""


def between(df: DataFrame, column: str, after: str | None = None, up_to: str | None = None) -> DataFrame:
    c: Column = F.col(column)
    if after is not None:
        df = df.filter(c > ntz(after))
    return df if up_to is None else df.filter(c <= ntz(up_to))
