"""Source databases over JDBC, and file sources that stand in for them.

Both kinds answer the same call: the rows of a table, all or only those changed after a
cut-off, in one shape.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.cdc import cdc_filter
from tidemark.operators.splits import split_points, split_predicates

# Per kind of database the directory of its RAW files, the cast target of
# cut-offs and the identifier quote; then the read settings.
DIALECTS = {
    "mysql": {"directory": "MySQL", "cast": "DATETIME", "quote": "`"},
    "postgresql": {"directory": "PostgreSQL", "cast": "TIMESTAMP", "quote": '"'},
}
FETCH_SIZE = 10000
SPLITS = {"batch": 10, "stream": 2}
LOOKBACK_MINUTES = {"batch": 10, "stream": 5}


@dataclass(frozen=True)
class FileSource:
    """Tables as Parquet below one directory; Catalyst pushes the cut-off into the scan."""

    location: str
    suffix: str = ""
    directory: str = "Files"

    def extract(
        self,
        spark: SparkSession,
        table: str,
        change_cols: Sequence[str] = (),
        cutoff: str | None = None,
        split_col: str | None = None,
        splits: int = SPLITS["batch"],
    ) -> DataFrame:
        rows = spark.read.parquet(f"{self.location}/{table}{self.suffix}")
        return rows if cutoff is None else cdc_filter(rows, change_cols, cutoff)


@dataclass(frozen=True)
class JdbcSource:
    """Tables of one MySQL or PostgreSQL database. Credentials come in ``options``. With
    ``rows_per_split`` a table with a numeric split column is read in as many parts as its
    range of keys asks for, and no fewer than planned."""

    kind: str
    url: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    fetch_size: int = FETCH_SIZE
    rows_per_split: int | None = None
    balanced: bool = False

    def __post_init__(self) -> None:
        if self.kind.lower() not in DIALECTS:
            raise ValueError(f"unsupported source type: {self.kind}")

    @property
    def dialect(self) -> dict[str, str]:
        return DIALECTS[self.kind.lower()]

    @property
    def directory(self) -> str:
        return self.dialect["directory"]

    def quoted(self, name: str) -> str:
        q = self.dialect["quote"]
        return ".".join(q + part.replace(q, q + q) + q for part in name.split("."))

    def changed_rows(self, change_cols: Sequence[str], cutoff: str | None) -> str:
        """The WHERE clause of an extract, empty for a full one."""
        if cutoff is None:
            return ""
        limit = f"CAST('{cutoff}' AS {self.dialect['cast']})"
        return " WHERE " + " OR ".join(f"{self.quoted(c)} > {limit}" for c in change_cols)

    def ordered(self, name: str, kind: T.DataType) -> str:
        """A column as it is compared with split points: text by its bytes, which is how they are ordered."""
        column = self.quoted(name)
        if not isinstance(kind, T.StringType):
            return column
        return f"CAST({column} AS BINARY)" if self.kind.lower() == "mysql" else f'{column} COLLATE "C"'

    def literal(self, value: Any) -> str:
        """A split point as the database writes it."""
        if isinstance(value, datetime):
            return f"CAST('{value}' AS {self.dialect['cast']})"
        if isinstance(value, date):
            return f"CAST('{value}' AS DATE)"
        if not isinstance(value, str):
            return str(value)
        mysql = self.kind.lower() == "mysql"
        text = (value.replace("\\", "\\\\") if mysql else value).replace("'", "''")
        return f"CAST('{text}' AS BINARY)" if mysql else f"'{text}'"

    def read_options(self, subquery: str, **more: Any) -> dict[str, str]:
        """Reader options. The subquery is run by the database, so its filter and its
        aggregates are too: Spark's JDBC reader pushes filters but not MIN and MAX."""
        fixed = {
            "url": self.url,
            "dbtable": f"({subquery}) src",
            "fetchsize": self.fetch_size,
            "preferTimestampNTZ": "true",
            "zeroDateTimeBehavior": "convertToNull",
        }
        return {k: str(v) for k, v in {**fixed, **more, **self.options}.items()}

    def extract(
        self,
        spark: SparkSession,
        table: str,
        change_cols: Sequence[str] = (),
        cutoff: str | None = None,
        split_col: str | None = None,
        splits: int = SPLITS["batch"],
    ) -> DataFrame:
        """Rows of the table, read over ``splits`` connections when there is a split column.

        The bounds only place the strides: rows outside them and NULLs are read too. A ``balanced``
        source first reads the split column alone, in equal strides, and cuts it where parts have
        equal numbers of rows.
        """
        rows_of = f" FROM {self.quoted(table)}{self.changed_rows(change_cols, cutoff)}"
        ranged = {}
        if split_col:
            col = self.quoted(split_col)
            bounds = f"SELECT MIN({col}) AS min_val, MAX({col}) AS max_val{rows_of}"
            low, high = spark.read.format("jdbc").options(**self.read_options(bounds)).load().first()
            if self.rows_per_split and isinstance(low, (int, Decimal)):
                splits = max(splits, math.ceil((high - low + 1) / self.rows_per_split))
            ranged = split_options(split_col, low, high, splits)
        query = f"SELECT *{rows_of}"
        if ranged and self.balanced:
            keys = spark.read.format("jdbc").options(**self.read_options(f"SELECT {col}{rows_of}", **ranged)).load()
            options = self.read_options(query)
            url, source = options.pop("url"), options.pop("dbtable")
            ordered = self.ordered(split_col, keys.schema[split_col].dataType)
            literals = [self.literal(p) for p in split_points(keys, split_col, splits)]
            return spark.read.jdbc(url, source, predicates=split_predicates(ordered, literals), properties=options)
        return spark.read.format("jdbc").options(**self.read_options(query, **ranged)).load()


def split_options(split_col: str, low: Any, high: Any, splits: int) -> dict[str, str]:
    """Range options of a parallel read.

    Numeric bounds are rounded outwards to whole numbers, which is all Spark takes; dates and
    times stay as they are. Without bounds, as of an empty extract, the read is not split.
    """
    if low is None or high is None:
        return {}
    if isinstance(low, (int, float, Decimal)):
        low, high = math.floor(low), math.ceil(high)
    return {
        "partitionColumn": split_col,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(splits),
    }


def source_for(kind: str, location: str, **settings: Any) -> FileSource | JdbcSource:
    """Source by configured type; an unknown type is an error."""
    if kind.lower() == "parquet":
        return FileSource(location, **settings)
    return JdbcSource(kind, location, **settings)
