"""Gold layer over staged order data: rules, dimensions, facts, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Our definitions: order sizes by total price, and days to ship before a line is late.
SIZE_BANDS = {"small": 50000, "medium": 250000}
LATE_AFTER_DAYS = 90
# The member of a dimension that facts without a match belong to.
UNKNOWN_KEY, UNKNOWN = -1, "unknown"


def money(c: Column | str) -> Column:
    """Exact sums need exact terms: two decimals, half up."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def size_band(price: Column | str) -> Column:
    value = F.col(price) if isinstance(price, str) else price
    return (
        F.when(value < SIZE_BANDS["small"], "small")
        .when(value < SIZE_BANDS["medium"], "medium")
        .otherwise("large")
    )


def net_amount(price: str, discount: str) -> Column:
    return (F.col(price).cast("decimal(18,2)") * (1 - F.col(discount).cast("decimal(4,2)"))).cast("decimal(18,4)")


def apply_rules(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order lines with the size band of their order, a late flag and the net amount.

    Both sides are cut down to what is kept before they are shuffled.
    """
    headers = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").cast("date").alias("ordered"),
        size_band("o_totalprice").alias("size_band"),
    )
    lines = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        net_amount("l_extendedprice", "l_discount").alias("net_amount"),
    )
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.col("ordered"))
    is_late = (days > LATE_AFTER_DAYS).alias("is_late")
    return lines.join(headers, "l_orderkey").select(*lines.columns, "size_band", is_late)


def dim_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers with the names of their nation and region, and the unknown member; customers
    without a nation stay."""
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"
    )
    known = customer.join(places, "c_nationkey", "left").select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("nation"),
        F.col("r_name").alias("region"),
    )
    texts = ["customer_name", "segment", "nation", "region"]
    return known.unionByName(_unknown(known, "customer_key", {c: F.lit(UNKNOWN) for c in texts}))


def _unknown(known: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """The unknown member of a dimension, with its types; values that are not given are NULL."""
    own = {key: F.lit(UNKNOWN_KEY), **values}
    one = known.sparkSession.range(1)
    return one.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in known.schema.fields])


def dim_date(facts: DataFrame, date_col: str) -> DataFrame:
    """Calendar from the first to the last date of a column, one row per day, and the unknown day."""
    day = F.col(date_col).cast("date")
    span = facts.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )
    parts = {"year": F.year("date"), "month": F.month("date"), "day": F.day("date")}
    number = parts["year"] * 10000 + parts["month"] * 100 + parts["day"]
    known = days.select(
        number.alias("date_key"),
        F.col("date").cast("timestamp_ntz").alias("date"),
        *[c.alias(name) for name, c in parts.items()],
        F.quarter("date").alias("quarter"),
        (F.weekday("date") + 1).alias("iso_weekday"),
    )
    return known.unionByName(_unknown(known, "date_key", {}))


def date_key(c: Column | str) -> Column:
    day = F.col(c) if isinstance(c, str) else c
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)


def fact_order_line(
    lineitem: DataFrame, orders: DataFrame, customers: DataFrame, parts: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Order lines with dimension keys, -1 where a dimension lacks the key.

    Orders meet their customers before the lines join, so the lines, the largest table,
    are shuffled for orders alone unless a dimension is beyond the broadcast limit.
    """
    known_customers = customers.select(F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("customer_key"))
    headers = orders.join(known_customers, "o_custkey", "left").select(
        F.col("o_orderkey").alias("l_orderkey"), "customer_key", date_key("o_orderdate").alias("order_date_key")
    )
    known_parts = parts.select(F.col("p_partkey").alias("l_partkey"), F.col("p_partkey").alias("part_key"))
    known_suppliers = suppliers.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_suppkey").alias("supplier_key"))
    lines = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.coalesce(date_key("l_shipdate"), F.lit(UNKNOWN_KEY)).alias("ship_date_key"),
        money("l_quantity").alias("quantity"),
        net_amount("l_extendedprice", "l_discount").alias("net_amount"),
    )
    joined = (
        lines.join(headers, "l_orderkey", "left")
        .join(known_parts, "l_partkey", "left")
        .join(known_suppliers, "l_suppkey", "left")
    )
    keys = ["customer_key", "part_key", "supplier_key", "order_date_key"]
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        *[F.coalesce(F.col(k), F.lit(UNKNOWN_KEY)).alias(k) for k in keys],
        "ship_date_key",
        "quantity",
        "net_amount",
    )


def metrics_monthly(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, orders and mean order value by nation, segment and month.

    ``customers`` is ``dim_customer``. Orders are summed per customer and month first, so a
    customer with very many orders reaches the join as a few rows. Orders of customers that
    the dimension lacks count for its unknown member, so the revenue is that of all orders.
    """
    return metrics_from_sums(order_sums(orders), customers)


def _month() -> Column:
    return F.substring(F.col("o_orderdate").cast("string"), 1, 7)


def order_sums(orders: DataFrame) -> DataFrame:
    """(customer_key, month, revenue, orders): what the metrics are made of."""
    return orders.groupBy(F.col("o_custkey").alias("customer_key"), _month().alias("month")).agg(
        F.sum(money("o_totalprice")).alias("revenue"), F.count(F.lit(1)).alias("orders")
    )


def changed_sums(sums: DataFrame, changes: DataFrame) -> DataFrame:
    """The sums after changes (old, new) of orders: what an order was is taken away, what it is is added.

    Sums are decimals, so they are what they would be if worked out anew. A customer's month that has no
    order left goes. Only the changed orders and the sums are read.
    """
    image = lambda side, sign: F.when(F.col(side).isNotNull(), F.struct(F.lit(sign).alias("sign"), F.col(side).alias("row")))
    images = changes.select(F.explode(F.array_compact(F.array(image("old", -1), image("new", 1)))).alias("i")).select("i.sign", "i.row.*")
    delta = images.groupBy(F.col("o_custkey").alias("customer_key"), _month().alias("month")).agg(
        F.sum(money("o_totalprice") * F.col("sign")).cast("decimal(28,2)").alias("revenue"), F.sum("sign").alias("orders")
    )
    both = sums.unionByName(delta).groupBy("customer_key", "month")
    after = both.agg(F.sum("revenue").cast("decimal(28,2)").alias("revenue"), F.sum("orders").alias("orders"))
    return after.filter(F.col("orders") > 0)


def metrics_from_sums(sums: DataFrame, customers: DataFrame) -> DataFrame:
    """The metrics of ``metrics_monthly`` from the sums of ``order_sums``."""
    return (
        sums.join(
            customers.select("customer_key", "nation", "segment", F.lit(True).alias("known")), "customer_key", "left"
        )
        .withColumns({c: F.when(F.col("known"), F.col(c)).otherwise(UNKNOWN) for c in ("nation", "segment")})
        .groupBy("nation", "segment", "month")
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
        .select(
            "nation",
            "segment",
            "month",
            F.col("revenue").cast("decimal(18,2)").alias("revenue"),
            "orders",
            (F.col("revenue").cast("double") / F.col("orders")).alias("mean_order_value"),
        )
    )
