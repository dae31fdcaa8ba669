"""Merge of a newest-row-per-key source into a target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FROM_SOURCE = "_from_source"
_FROM_TARGET = "_from_target"


def has_null_key(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: Sequence[str] = (),
    null_keys: str = "reject",
) -> DataFrame:
    """Target after the merge: matched rows take all source columns, other source rows are added.

    The source has one row per key, and so has a target that was made by merges. Target rows
    without a match stay as they are, and nothing is deleted. With ``newer_by`` a matched
    target row that is newer in those columns is kept. NULL keys never match: such source
    rows are left to ``rejected_rows``, or added when ``null_keys`` is ``"insert"``.

    Each side is read once. A side that was just reduced to its newest rows is already
    partitioned by the key and is not shuffled again.
    """
    old = target.withColumn(_FROM_TARGET, F.lit(True))
    merged = _overlay(old, _usable(source, keys, null_keys), keys, newer_by, "full_outer")
    return merged.drop(_FROM_TARGET, FROM_SOURCE)


def upsert_stored(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: Sequence[str] = (),
    null_keys: str = "reject",
) -> tuple[DataFrame, DataFrame]:
    """``upsert`` in two halves, for a stored target and a source small enough to broadcast.

    The first has the target rows, updated or not, where they lie: no shuffle. The second has
    the rows to add, found with another look at the key columns alone. Both say in a column
    whether the row is the source's.
    """
    source = _usable(source, keys, null_keys)
    on = list(keys)
    met = target.select(*on).join(source.select(*on), on, "left_semi")
    added = source.join(met, on, "left_anti").withColumn(FROM_SOURCE, F.lit(True))
    return _overlay(target, source, on, newer_by, "left_outer"), added


def _usable(source: DataFrame, keys: Sequence[str], null_keys: str) -> DataFrame:
    return source if inserts_null_keys(null_keys) else source.filter(~has_null_key(keys))


def inserts_null_keys(null_keys: str) -> bool:
    """The one rule for source rows with a NULL key, which match nothing: ``"reject"`` leaves
    them to ``rejected_rows``, ``"insert"`` adds them."""
    if null_keys not in ("reject", "insert"):
        raise ValueError(f"null_keys must be 'reject' or 'insert', not {null_keys!r}")
    return null_keys == "insert"


def rejected_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that a merge with ``null_keys="reject"`` leaves out: all with a NULL key."""
    return source.filter(has_null_key(keys))


def _overlay(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newer_by: Sequence[str], how: str
) -> DataFrame:
    """The joined sides, with the source's values where its row is new or wins."""
    # Literal marks tell the sides apart: any data column may be NULL on either of them.
    old = target.alias("old")
    new = source.withColumn(FROM_SOURCE, F.lit(True)).alias("new")
    same_key = reduce(and_, [_of("old", k) == _of("new", k) for k in keys])
    wins = _of("new", FROM_SOURCE).isNotNull()
    if newer_by:
        # NULL is older than any value; a missing target row is older than any row.
        older = F.struct(*[_of("old", c) for c in newer_by]) > F.struct(*[_of("new", c) for c in newer_by])
        present = _of("old", _FROM_TARGET).isNotNull() if how == "full_outer" else F.lit(True)
        wins &= ~(present & older)
    out = []
    for name in [*target.columns, *[c for c in source.columns if c not in target.columns]]:
        before = _of("old", name) if name in target.columns else F.lit(None)
        after = _of("new", name) if name in source.columns else before
        out.append(F.when(wins, after).otherwise(before).alias(name))
    return old.join(new, same_key, how).select(*out, wins.alias(FROM_SOURCE))


def _of(side: str, name: str) -> Column:
    return F.col(f"{side}.`{name}`")


def merge_matched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that update the target."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_semi")


def merge_inserts(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_keys: str = "reject"
) -> DataFrame:
    """Source rows that the merge adds to the target; ``null_keys`` is as for ``upsert``."""
    return _usable(source, keys, null_keys).join(target.select(*keys).distinct(), list(keys), "left_anti")


def merge_stats(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_keys: str = "reject"
) -> DataFrame:
    """One row: target rows updated, rows inserted, target rows kept, source rows rejected.

    ``null_keys`` is as for ``upsert``. Counted per key before the shuffle, so neither wide
    rows nor hot keys travel.
    """
    insert = inserts_null_keys(null_keys)
    sides = target.select(*keys, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        source.select(*keys, F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    per_key = sides.groupBy(*keys).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    met = (F.col("_old") > 0) & (F.col("_new") > 0) & ~has_null_key(keys)

    def total(name: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(name))), F.lit(0).cast("bigint"))

    usable = F.lit(insert) | ~has_null_key(keys)
    return per_key.agg(
        total("_old", met).alias("updated"),
        total("_new", ~met & usable).alias("inserted"),
        total("_old", ~met).alias("kept"),
        total("_new", ~usable).alias("rejected"),
    )
