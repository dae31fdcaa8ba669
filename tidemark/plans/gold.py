"""Gold job: dimensions, facts and metrics of a database, once its extraction is complete."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.config import ready
from tidemark.operators.gold import dim_customer, dim_date, fact_order_line, metrics_monthly
from tidemark.schemas import EXTRACTION_STATUS
from tidemark.sources.storage import control_rows, read_current

GOLD_RESULT = T.StructType(
    [
        T.StructField("database_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
    ]
)
TABLES = ("dim_customer", "dim_date", "fact_order_line", "metrics_monthly")


def build_gold(
    spark: SparkSession, database: str, staged: Mapping[str, DataFrame], control: str, target: str
) -> DataFrame:
    """Write the gold tables of a database below ``target``, or report that it is waiting.

    ``staged`` has the tables by name. The gate is the extraction status that ``control``
    holds: a database that is not complete is left as it was.
    """
    asked = control_rows(spark, [(database,)], T.StructType([T.StructField("database_name", T.StringType())]))
    status = read_current(spark, f"{control}/extraction_status", EXTRACTION_STATUS)
    if ready(asked, status).isEmpty():
        return control_rows(spark, [(database, name, "WAITING", None) for name in TABLES], GOLD_RESULT)
    customers = dim_customer(staged["customer"], staged["nation"], staged["region"])
    made = {
        "dim_customer": customers,
        "dim_date": dim_date(staged["lineitem"], "l_shipdate"),
        "fact_order_line": fact_order_line(
            *[staged[t] for t in ("lineitem", "orders", "customer", "part", "supplier")]
        ),
        "metrics_monthly": metrics_monthly(staged["orders"], customers),
    }
    rows = []
    for name, df in made.items():
        df.write.mode("overwrite").parquet(f"{target}/{name}")
        rows.append((database, name, "SUCCESS", spark.read.parquet(f"{target}/{name}").count()))
    return control_rows(spark, rows, GOLD_RESULT)
