"""Change-data extraction: predicate, watermark, split bounds, stamping, appending."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import EPOCH, ntz, unreadable, zero_date_to_null

STAMP = "insert_timestamp"


def cdc_filter(df: DataFrame, change_cols: Sequence[str], cutoff: datetime | str | Column) -> DataFrame:
    """Rows where any change column is after the cut-off; NULL never qualifies a row by itself.

    The bare column stays on the left of each comparison, so the whole OR reaches the scan.
    """
    after = ntz(cutoff)
    return df.filter(reduce(or_, [F.col(c) > after for c in change_cols]))


def change_maxima(df: DataFrame, change_cols: Sequence[str]) -> DataFrame:
    """One row: the largest value of each change column."""
    return df.agg(*maxima(change_cols))


def maxima(change_cols: Sequence[str]) -> list[Column]:
    return [F.max(F.col(c).cast("timestamp_ntz")).alias(c) for c in change_cols]


def largest(*cols: Column) -> Column:
    """Largest of the values, NULLs ignored; a single one is allowed."""
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def new_watermark(df: DataFrame, change_cols: Sequence[str]) -> DataFrame:
    """One row, ``watermark``: the newest change over all change columns (NULL if none has any)."""
    return change_maxima(df, change_cols).select(largest(*[F.col(c) for c in change_cols]).alias("watermark"))


def split_bounds(df: DataFrame, split_col: str) -> DataFrame:
    """One row, ``min_val`` and ``max_val`` of the split column.

    Numeric bounds are whole numbers, 0 where there is no row. Date and time bounds keep
    their type and stay NULL.
    """
    kind = df.schema[split_col].dataType
    low, high = F.min(split_col), F.max(split_col)
    if isinstance(kind, T.NumericType):
        low, high = (F.coalesce(v.cast("bigint"), F.lit(0).cast("bigint")) for v in (low, high))
    return df.agg(low.alias("min_val"), high.alias("max_val"))


def stamp(df: DataFrame, load_ts: datetime | str | Column) -> DataFrame:
    """One load time for every row of the extract."""
    return df.withColumn(STAMP, ntz(load_ts))


def append_extract(raw: DataFrame, extract: DataFrame) -> DataFrame:
    """Bag append: rows read twice stay twice, columns new to either side are NULL in the other."""
    return raw.unionByName(extract, allowMissingColumns=True)


def raw_since(
    raw: DataFrame,
    last_run: datetime | str | Column | None,
    high: datetime | str | Column | None = None,
    also: Sequence[datetime] = (),
) -> DataFrame:
    """RAW rows stamped in ``(last_run, high]``; no last run means from the start of time. Rows of
    the stamps in ``also``, of loads that finished out of turn, come on top."""
    after = ntz(EPOCH) if last_run is None else F.coalesce(ntz(last_run), ntz(EPOCH))
    wanted = F.col(STAMP) > after
    rows = raw.filter(reduce(or_, [F.col(STAMP) == ntz(s) for s in sorted(set(also))], wanted))
    return rows if high is None else rows.filter(F.col(STAMP) <= ntz(high))


def raw_high_mark(raw: DataFrame, last_run: datetime | str | Column | None) -> DataFrame:
    """One row, ``insert_timestamp``: newest stamp after the last run, else the last run itself."""
    kept = F.lit(None).cast("timestamp_ntz") if last_run is None else ntz(last_run)
    return raw_since(raw, last_run).agg(F.coalesce(F.max(STAMP), kept).alias(STAMP))


def count_unreadable(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: for each text column how many of its values ``clean_zero_dates`` cannot read."""
    return df.agg(*[F.count_if(unreadable(c, zero_date_to_null(c))).alias(c) for c in cols])


def clean_zero_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns of a source with zero dates as timestamps."""
    return df.withColumns({c: zero_date_to_null(c) for c in cols})
