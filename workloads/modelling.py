"""Gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cdc import stamp
from tidemark.operators.gold import (
    apply_rules,
    changed_sums,
    dim_customer,
    dim_date,
    fact_order_line,
    metrics_from_sums,
    metrics_monthly,
    order_sums,
)
from tidemark.operators.history import as_of, history
from tidemark.plans.gold import build_gold
from tidemark.schemas import EXTRACTION_STATUS
from tidemark.session import work_dir
from tidemark.sources.staging import StagingTable
from tidemark.sources.storage import control_rows, publish, read_current
from workloads.inputs import ORDERS_BACK, ORDERS_CUT, T1, T2, T3, Query, between, table

SUMS = T.StructType(
    [
        T.StructField("customer_key", T.LongType()),
        T.StructField("month", T.StringType()),
        T.StructField("revenue", T.DecimalType(28, 2)),
        T.StructField("orders", T.LongType()),
    ]
)


def order_rules(spark: SparkSession, sf: str) -> DataFrame:
    return apply_rules(table(spark, sf, "orders"), table(spark, sf, "lineitem"))


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return dim_customer(*[table(spark, sf, t) for t in ("customer", "nation", "region")])


def dates(spark: SparkSession, sf: str) -> DataFrame:
    return dim_date(table(spark, sf, "lineitem"), "l_shipdate")


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Pending orders and customers in debt have other keys, so those of their lines are unknown."""
    orders = table(spark, sf, "orders").withColumn(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
    )
    return fact_order_line(
        table(spark, sf, "lineitem"), orders, _some_renamed(spark, sf), table(spark, sf, "part"), table(spark, sf, "supplier")
    )


def _some_renamed(spark: SparkSession, sf: str) -> DataFrame:
    key = F.when(F.col("c_acctbal") < 0, -2 - F.col("c_custkey")).otherwise(F.col("c_custkey"))
    return table(spark, sf, "customer").withColumn("c_custkey", key)


FOLLOWED = ["o_orderpriority", "o_orderstatus"]


def customer_history(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by the priority and state of their latest order: a version for each change of either."""
    versions = history(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", FOLLOWED, ["o_orderkey"])
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return versions.join(names, "o_custkey", "left")


def lines_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with what their customer was when they were shipped; one line in fifty has no ship date."""
    orders = table(spark, sf, "orders")
    versions = history(orders, ["o_custkey"], "o_orderdate", FOLLOWED, ["o_orderkey"])
    shipped = F.when(F.col("l_orderkey") % 50 != 7, F.col("l_shipdate")).alias("shipped")
    lines = table(spark, sf, "lineitem").join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return as_of(lines.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", shipped), versions, ["o_custkey"], "shipped", FOLLOWED)


def incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly metrics kept by the changes of three merges: some orders first have another price, customer or
    date, later orders follow, and then all are put right."""
    base, key = work_dir(spark, "gold_metrics_incremental"), F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    wrong = orders.withColumns({
        "o_totalprice": F.when(key % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_custkey": F.when(key % 11 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")),
        "o_orderdate": F.when(key % 13 == 0, F.col("o_orderdate") + F.expr("interval 40 days")).otherwise(F.col("o_orderdate")),
    })
    loads = [
        between(wrong, "o_orderdate", up_to=ORDERS_CUT),
        between(orders, "o_orderdate", after=ORDERS_BACK),
        orders.filter((key % 7 == 0) | (key % 11 == 0) | (key % 13 == 0)),
    ]
    staging, sums = StagingTable(spark, f"{base}/staging", ["o_orderkey"]), order_sums(orders.limit(0))
    for load, at in zip(loads, (T1, T2, T3)):
        before = staging.version()
        staging.merge(stamp(load, at))
        publish(changed_sums(sums, staging.changes(before)), f"{base}/sums")
        sums = read_current(spark, f"{base}/sums", SUMS)
    return metrics_from_sums(sums, customers(spark, sf))


def gated(spark: SparkSession, sf: str) -> DataFrame:
    """The gold job for two databases, of which the extraction of one is complete."""
    base = work_dir(spark, "gold_job")
    status = control_rows(spark, [("shop", "batch", " true "), ("outlet", "batch", "FALSE")], EXTRACTION_STATUS)
    publish(status, f"{base}/control/extraction_status")
    names = ("orders", "lineitem", "customer", "nation", "region", "part", "supplier")
    staged = {name: table(spark, sf, name) for name in names}
    done = [build_gold(spark, d, staged, f"{base}/control", f"{base}/{d}") for d in ("shop", "outlet")]
    return done[0].unionByName(done[1])


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of customers in debt count for the unknown member."""
    known = dim_customer(_some_renamed(spark, sf), table(spark, sf, "nation"), table(spark, sf, "region"))
    return metrics_monthly(table(spark, sf, "orders"), known)


_NET = """cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2)))
               as decimal(18,4)) as net_amount"""

_VERSIONS = """one as (
  select * from orders where o_custkey is not null and o_orderdate is not null
  qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc, o_totalprice desc) = 1),
marked as (
  select *, row_number() over w = 1 or o_orderpriority is distinct from lag(o_orderpriority) over w
            or o_orderstatus is distinct from lag(o_orderstatus) over w as new
  from one window w as (partition by o_custkey order by o_orderdate)),
versions as (
  select o_custkey, o_orderdate as valid_from, o_orderpriority, o_orderstatus,
         lead(o_orderdate) over (partition by o_custkey order by o_orderdate) as valid_to
  from marked where new)"""

QUERIES = {
    "gold_metrics_incremental": Query(
        incremental,
        """select n_name as nation, c_mktsegment as segment, strftime(o_orderdate, '%Y-%m') as month,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as revenue, count(*) as orders,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as mean_order_value
           from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1, 2, 3""",
    ),
    "gold_dim_customer_history": Query(
        customer_history,
        f"""with {_VERSIONS} select versions.*, valid_to is null as is_current, c_name
            from versions left join customer on c_custkey = o_custkey""",
    ),
    "gold_fact_as_of": Query(
        lines_as_of,
        f"""with {_VERSIONS},
            lines as (
              select l_orderkey, l_linenumber, l_partkey, o_custkey, case when l_orderkey % 50 <> 7 then l_shipdate end as shipped
              from lineitem join orders on l_orderkey = o_orderkey)
            select lines.*, o_orderpriority, o_orderstatus
            from lines asof left join versions on lines.o_custkey = versions.o_custkey and shipped >= valid_from""",
    ),
    "gold_order_rules": Query(
        order_rules,
        f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                   case when o_totalprice < 50000 then 'small' when o_totalprice < 250000 then 'medium'
                        else 'large' end as size_band,
                   date_diff('day', o_orderdate, l_shipdate) > 90 as is_late, {_NET}
            from lineitem join orders on l_orderkey = o_orderkey""",
    ),
    "gold_dim_customer": Query(
        customers,
        """select c_custkey as customer_key, c_name as customer_name, c_mktsegment as segment,
                  n_name as nation, r_name as region
           from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey
           union all
           select -1, 'unknown', 'unknown', 'unknown', 'unknown'""",
    ),
    "gold_dim_date": Query(
        dates,
        """select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as date, cast(year(d) as integer) as year,
                  cast(month(d) as integer) as month, cast(day(d) as integer) as day,
                  cast(quarter(d) as integer) as quarter, cast(isodow(d) as integer) as iso_weekday
           from (select unnest(generate_series(min(l_shipdate), max(l_shipdate), interval 1 day)) as d
                 from lineitem)
           union all
           select -1, null, null, null, null, null, null""",
    ),
    "gold_fact_order_line": Query(
        order_lines,
        f"""select l_orderkey, l_linenumber, coalesce(c_custkey, -1) as customer_key,
                   coalesce(p_partkey, -1) as part_key, coalesce(s_suppkey, -1) as supplier_key,
                   coalesce(cast(strftime(o_orderdate, '%Y%m%d') as integer), -1) as order_date_key,
                   coalesce(cast(strftime(l_shipdate, '%Y%m%d') as integer), -1) as ship_date_key,
                   cast(l_quantity as decimal(18,2)) as quantity, {_NET}
            from lineitem
            left join orders on l_orderkey = o_orderkey and o_orderstatus <> 'P'
            left join customer on o_custkey = c_custkey and c_acctbal >= 0
            left join part on l_partkey = p_partkey
            left join supplier on l_suppkey = s_suppkey""",
    ),
    "gold_monthly_metrics": Query(
        monthly,
        """select case when c_custkey is null then 'unknown' else n_name end as nation,
                  case when c_custkey is null then 'unknown' else c_mktsegment end as segment,
                  strftime(o_orderdate, '%Y-%m') as month,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) as revenue, count(*) as orders,
                  cast(sum(cast(o_totalprice as decimal(18,2))) as double) / count(*) as mean_order_value
           from orders left join customer on o_custkey = c_custkey and c_acctbal >= 0
           left join nation on c_nationkey = n_nationkey
           group by 1, 2, 3""",
    ),
    "gold_job": Query(
        gated,
        """with made (table_name, rows) as (
             select 'dim_customer', count(*) + 1 from customer
             union all
             select 'dim_date', date_diff('day', min(l_shipdate), max(l_shipdate)) + 2 from lineitem
             union all
             select 'fact_order_line', count(*) from lineitem
             union all
             select 'metrics_monthly', count(*) from (
               select distinct n_name, c_mktsegment, strftime(o_orderdate, '%Y-%m'), c_custkey is null
               from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey))
           select 'shop' as database_name, table_name, 'SUCCESS' as status, rows from made
           union all
           select 'outlet', table_name, 'WAITING', null from made""",
    ),
}
