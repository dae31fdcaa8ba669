"""Types that hold the values of two."""

import itertools
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import widest, widest_fields

PLAIN = [
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(20, 0),
    T.DecimalType(38, 10), T.DateType(), T.TimestampNTZType(), T.TimestampType(), T.BooleanType(), T.StringType(), T.BinaryType(),
]


def test_order_does_not_matter_and_a_type_holds_itself():
    for a, b in itertools.product(PLAIN, PLAIN):
        both = widest(a, b)
        assert both == widest(b, a) and widest(a, a) == a and widest(a, T.NullType()) == a
        assert both is None or widest(both, a) == both


@pytest.mark.parametrize(
    "a, b, want",
    [
        ("int", "bigint", "bigint"), ("int", "decimal(4,2)", "decimal(12,2)"), ("bigint", "decimal(20,1)", "decimal(21,1)"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,10)", "string"), ("int", "float", "double"),
        ("smallint", "float", "float"), ("decimal(10,2)", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", "timestamp"), ("timestamp_ntz", "timestamp", "timestamp"), ("boolean", "int", "string"), ("date", "int", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<a:int>", "struct<a:bigint>", "struct<a:bigint>"), ("struct<a:int>", "struct<b:int>", None), ("array<int>", "int", None), ("binary", "string", None),
    ],
)
def test_widest(spark, a, b, want):
    kinds = [spark.createDataFrame([], f"c {k}").schema["c"].dataType for k in (a, b)]
    for one, two in (kinds, kinds[::-1]):
        got = widest(one, two)
        assert (got and got.simpleString()) == want


def test_values_are_kept(spark):
    values = {
        "tinyint": 7, "smallint": 300, "int": 2**31 - 1, "bigint": 2**62 + 1, "decimal(12,3)": Decimal("123.456"),
        "date": date(2020, 2, 29), "timestamp_ntz": datetime(2020, 2, 29, 1, 2, 3), "boolean": True, "string": "x",
    }
    for (a, x), (b, _) in itertools.product(values.items(), values.items()):
        rows = spark.createDataFrame([(x,)], f"c {a}")
        other = spark.createDataFrame([], f"c {b}").schema["c"].dataType
        wide = rows.select(F.col("c").cast(widest(rows.schema["c"].dataType, other)).alias("c"))
        assert wide.select(F.col("c").cast(a)).first()[0] == x


def test_fields_of_many_schemas():
    one, two = T.StructType().add("a", "integer").add("b", "string"), T.StructType().add("c", "date").add("a", "long", False)
    assert widest_fields([one, two]).simpleString() == "struct<a:bigint,b:string,c:date>"
    with pytest.raises(TypeError, match="column 'a'"):
        widest_fields([one, T.StructType().add("a", T.ArrayType(T.IntegerType()))])
