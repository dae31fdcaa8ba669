"""Splits of equal depth, and what a balanced source asks a database for."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.splits import split_of, split_points, split_predicates
from tidemark.sources import databases
from tidemark.sources.databases import JdbcSource
from workloads.extraction import QUERIES


def sizes(df, points):
    return {r["p"]: r["count"] for r in df.groupBy(split_of(df, "v", points).alias("p")).count().collect()}


def table(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


@pytest.mark.parametrize(
    "kind, make",
    [
        ("int", lambda n: n), ("bigint", lambda n: n**3), ("double", lambda n: 1.5**(n / 50)), ("decimal(20,3)", lambda n: Decimal(n * n) / 8),
        ("date", lambda n: date.fromordinal(700_000 + n * n // 1000)), ("timestamp_ntz", lambda n: datetime(2020, 1, 1 + n // 100, n % 24)),
        ("string", lambda n: f"key-{n}"), ("string", lambda n: f"{'ä' if n % 3 else 'common prefix of some length '}{n:05d}"),
        ("string", lambda n: chr(0x4E00 + n)),
    ],
)
def test_parts_have_equal_depth(spark, kind, make):
    df = table(spark, [make(n) for n in range(1000)], kind)
    points = split_points(df, "v", 8)
    got = sizes(df, points)
    assert points == sorted(set(points)) and len(got) == len(points) + 1 and 7 <= len(got) <= 11
    assert sum(got.values()) == 1000 and max(got.values()) <= 1.3 * 1000 / 8


@pytest.mark.parametrize("kind, heavy", [("int", 500), ("string", "m")])
def test_a_heavy_key_is_alone(spark, kind, heavy):
    rest = range(600) if kind == "int" else [f"{'az'[n % 2]}{n:03d}" for n in range(600)]
    df = table(spark, [*rest, *[heavy] * 900], kind)
    points = split_points(df, "v", 10)
    got = sizes(df, points)
    alone = {r["p"]: r["n"] for r in df.groupBy(split_of(df, "v", points).alias("p")).agg(F.count_distinct("v").alias("n")).collect()}
    big = max(got, key=got.get)
    assert alone[big] <= 1 + 1 and max(n for p, n in got.items() if p != big) <= 1.3 * 150


def test_nulls_count_in_the_first_part(spark):
    df = table(spark, [None] * 100 + list(range(900)), "int")
    got = sizes(df, split_points(df, "v", 5))
    assert set(got) == set(range(5)) and max(got.values()) <= 1.05 * 200
    many = table(spark, [None] * 500 + list(range(500)), "int")
    assert sizes(many, split_points(many, "v", 5))[0] == 500  # and no other rows


@pytest.mark.parametrize("values", [[], [None, None], [7], [7, 7, 7]])
def test_nothing_to_cut(spark, values):
    for kind in ("int", "string"):
        df = table(spark, [v if v is None or kind == "int" else str(v) for v in values], kind)
        assert split_points(df, "v", 4) == [] and split_points(df, "v", 1) == []
    assert split_predicates("v", []) == ["1 = 1"]


@pytest.mark.parametrize("first", [0, 2_097_152, 10**13])  # the cube of 2**21 is no bigint, that of 10**13 no decimal
def test_parts_of_large_keys_are_balanced(spark, tmp_path, first):
    lines = [(first + 7 * n, datetime(2020, 1, 1) + timedelta(hours=n)) for n in range(2000)]
    spark.createDataFrame(lines, "l_orderkey long, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {(r["split_col"], r["rows"], r["balanced"]) for r in QUERIES["split_bounds_balanced"].run(spark, str(tmp_path)).collect()}
    assert got == {(c, 2000, True) for c in ("even", "skewed", "text", "clustered", "time")}


@pytest.mark.parametrize("points", [["3"], ["3", "5", "9"]])
def test_every_row_meets_one_condition(spark, points):
    df = table(spark, [None, *range(12)], "int")
    parts = split_predicates("v", points)
    assert sum(df.filter(p).count() for p in parts) == 13
    assert all(df.filter(f"({a}) and ({b})").count() == 0 for a in parts for b in parts if a != b)


@pytest.mark.parametrize(
    "kind, value, column, literal",
    [
        ("mysql", "it's a\\b", "CAST(`k` AS BINARY)", "CAST('it''s a\\\\b' AS BINARY)"), ("postgresql", "it's", '"k" COLLATE "C"', "'it''s'"),
        ("mysql", 5, "`k`", "5"), ("mysql", datetime(2024, 1, 2, 3), "`k`", "CAST('2024-01-02 03:00:00' AS DATETIME)"),
        ("postgresql", date(2024, 1, 2), '"k"', "CAST('2024-01-02' AS DATE)"), ("postgresql", Decimal("1.50"), '"k"', "1.50"),
    ],
)
def test_a_balanced_source_reads_by_conditions(spark, monkeypatch, kind, value, column, literal):
    asked = {}
    keys = spark.createDataFrame([(value,)], ["k"])

    class Reader:
        def format(self, _):
            return self

        def options(self, **options):
            asked.setdefault("queries", []).append(options["dbtable"])
            return self

        def load(self):
            return self if len(asked["queries"]) == 1 else keys

        def first(self):
            return 1, 9

        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    monkeypatch.setattr(databases, "split_points", lambda df, name, splits: [value] if df is keys and (name, splits) == ("k", 4) else None)
    JdbcSource(kind, "jdbc:x", {"user": "u"}, balanced=True).extract(Session, "t", split_col="k", splits=4)
    q = "`" if kind == "mysql" else '"'
    assert asked["queries"][1] == f"(SELECT {q}k{q} FROM {q}t{q}) src" and asked["table"] == f"(SELECT * FROM {q}t{q}) src"
    assert asked["predicates"] == [f"{column} < {literal} OR {column} IS NULL", f"{column} >= {literal}"]
    assert asked["properties"]["user"] == "u" and "dbtable" not in asked["properties"]
