"""Splits of equal depth: where to cut a column so that each part of a parallel read has as many rows.

The cuts come from a quantile sketch of the column (``approx_percentile``), which is built in each task
and merged, so no row is shuffled. Texts are sketched by the number that their next bytes after the
prefix common to all of them make; where many texts agree in these too, the cuts within them are looked
for in the same way. A key that has more rows than a part should is given a part of its own.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ranks of the sketch are off by at most 1/ACCURACY of all rows.
ACCURACY = 10000
# Bytes of a text that make a number; the sketch keeps 53 bits of one.
_BYTES = 6


def split_points(df: DataFrame, split_col: str, splits: int, accuracy: int = ACCURACY) -> list[Any]:
    """Ascending values at which parts begin, the first part beginning before all of them.

    About ``splits`` parts of equal depth: fewer where there are fewer values, more where a value with
    many rows needs a part for itself. NULLs belong to the first part and count there. Text is ordered
    by its bytes.
    """
    total, some, low = df.agg(F.count(F.lit(1)), F.count(split_col), F.min(split_col)).first()
    if splits < 2 or not some:
        return []
    nulls = total - some
    shares = [(k * total / splits - nulls) / some for k in range(1, splits)]
    rows = df.select(F.col(split_col).alias("v")).filter(F.col("v").isNotNull())
    points = _points(rows, [s for s in shares if s > 0], accuracy)
    # NULLs that fill a part and more have it for themselves
    return sorted({*points, *([low] if shares[0] <= 0 else [])})


def _points(rows: DataFrame, shares: list[float], accuracy: int) -> list[Any]:
    """The values at these shares of all rows, but for the lowest value."""
    text = isinstance(rows.schema["v"].dataType, T.StringType)
    number, kind = F.col("v"), rows.schema["v"].dataType
    at = lambda m: F.lit(m) if isinstance(m, (int, float, Decimal)) else F.lit(str(m)).cast(kind)
    if text:
        low, high = rows.agg(F.min("v"), F.max("v")).first()
        if low == high:  # no row, or one value
            return []
        common = len(os.path.commonprefix([low.encode(), high.encode()]))
        tail = F.substring(F.col("v").cast("binary"), common + 1, _BYTES)
        number = F.conv(F.hex(F.rpad(tail, _BYTES, F.lit(b"\0"))), 16, 10).cast("long")
    if not shares:
        return []
    marks = rows.select(number.alias("n")).agg(F.percentile_approx("n", shares, accuracy)).first()[0] or []
    distinct = sorted(set(marks))
    if not distinct:
        return []
    # Each mark becomes the first value from it on. One that stands for several parts is closed by the
    # next value, so that what is heavy is alone.
    heavy = [m for m in distinct if marks.count(m) > 1]
    begins = [F.min(F.when(number >= at(m), F.col("v"))) for m in distinct]
    closes = [F.min(F.when(number > at(m), F.col("v"))) for m in heavy]
    low, *found = rows.agg(F.min("v"), *begins, *closes).first()
    points = [p for p in found if p is not None and p != low]
    for m in heavy if text else ():
        count = marks.count(m)
        points += _points(rows.filter(number == at(m)), [k / (count + 1) for k in range(1, count + 1)], accuracy)
    return points


def split_of(df: DataFrame, split_col: str, points: Sequence[Any]) -> Column:
    """Number of the part a value is in, from 0; NULLs are in the first one."""
    kind, number = df.schema[split_col].dataType, F.lit(0)
    for k, point in enumerate(points, 1):
        own = F.lit(point) if isinstance(point, (int, float, Decimal, str)) else F.lit(str(point)).cast(kind)
        number = F.when(F.col(split_col) >= own, k).otherwise(number)
    return number


def split_predicates(column: str, literals: Sequence[str]) -> list[str]:
    """One condition a part, in SQL: every row meets exactly one. ``column`` and the ``literals`` of the
    points are as the database writes them."""
    if not literals:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(literals, literals[1:])]
    return [f"{column} < {literals[0]} OR {column} IS NULL", *inner, f"{column} >= {literals[-1]}"]
