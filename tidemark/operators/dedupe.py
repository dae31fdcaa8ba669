"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def is_ordered(kind: T.DataType) -> bool:
    """Can values of the type be compared? Not if a map or variant is in them at any depth."""
    if isinstance(kind, T.StructType):
        return all(is_ordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return is_ordered(kind.elementType)
    return not isinstance(kind, _UNORDERED)


def newest_first(df: DataFrame, order_cols: Sequence[str], keys: Sequence[str] = ()) -> list[Column]:
    """A total order: the given columns, then every other column that can be compared.

    Rows equal in all of them are the same row, so the winner never depends on the run.
    """
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in order_cols and f.name not in keys and is_ordered(f.dataType)
    ]
    return [F.col(c).desc_nulls_last() for c in [*order_cols, *rest]]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the newest by ``order_cols``; NULL counts as a key value of its own.

    Spark turns ``rank = 1`` into a group limit on both sides of the shuffle: each input
    split sends at most one row per key, however many rows a hot key has.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first(df, order_cols, keys))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).select(*df.columns)
