"""Which keys differ between two copies of a table, found by checksums of buckets of keys.

Both copies are reduced to a count and two sums of row hashes for each bucket of keys, in any order of rows
and with partial sums before the shuffle, so what travels is one row a bucket and task. Only buckets
that differ are looked at again, cut into finer ones, and only the rows of fine buckets that still differ
are compared by key. Copies that agree are read once and never joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import widest

# Buckets into which each level cuts a bucket of the one above, and levels.
FAN, LEVELS = 1024, 2
MISSING_LEFT, MISSING_RIGHT, DIFFERENT = "missing_left", "missing_right", "different"


def _common(left: DataFrame, right: DataFrame, columns: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """Both sides with the compared columns only, and of each the type that holds the values of both:
    a copy may have wider types, or the same columns in another order."""
    names = list(columns) if columns is not None else [c for c in left.columns if c in right.columns]
    kinds = {}
    for c in names:
        kinds[c] = widest(left.schema[c].dataType, right.schema[c].dataType)
        if kinds[c] is None:
            raise TypeError(f"column {c!r} can't be compared: {left.schema[c].dataType} and {right.schema[c].dataType}")
    return tuple(df.select(*[F.col(c).cast(kinds[c]).alias(c) for c in names]) for df in (left, right))


def row_hash(columns: Sequence[str], seed: int = 0) -> Column:
    """Hash of a row in which NULL is a value and values do not run into each other."""
    return F.xxhash64(F.lit(seed), *[part for c in columns for part in (F.col(c).isNull(), F.col(c))])


def checksums(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, rows, sum_1, sum_2): the same for the same rows, in whatever order and however tasks cut
    them. Two copies of one row do not cancel each other."""
    sums = [F.sum(row_hash(columns, seed).cast("decimal(38,0)")).alias(f"sum_{seed}") for seed in (1, 2)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *sums)


def _differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups that are on one side only, or whose counts or sums differ; with what each side has."""
    named = [df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns]) for side, df in (("l", left), ("r", right))]
    same = reduce(and_, [F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in by])
    both = named[0].join(named[1], same, "full")
    changed = [~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}")) for c in ("rows", "sum_1", "sum_2")]
    return both.filter(changed[0] | changed[1] | changed[2])


def differing_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    fan: int = FAN,
    levels: int = LEVELS,
) -> DataFrame:
    """(keys, finding): the keys whose rows differ in any of the columns (those both sides have, unless
    named), or are on one side only, or more often on one than on the other.

    NULL is a key like any other. Rows count: a row that one side has twice makes its key differ.
    """
    if columns is not None:
        columns = [*keys, *[c for c in columns if c not in keys]]
    sides = _common(left, right, columns)
    names = sides[0].columns
    place = F.pmod(F.xxhash64(*[part for k in keys for part in (F.col(k).isNull(), F.col(k))]), F.lit(fan**levels))
    sides = [df.withColumn("_place", place) for df in sides]
    for level in range(levels):
        width = fan ** (levels - 1 - level)  # places in a bucket of this level
        bucket = F.floor(F.col("_place") / width).cast("long") if width > 1 else F.col("_place")
        found = _differing(*[checksums(df.withColumn("_bucket", bucket), ["_bucket"], names) for df in sides], by=["_bucket"])
        # At most ``fan`` buckets for each that differs on the level above; as a rule few of them differ.
        wanted = found.select(F.coalesce("l__bucket", "r__bucket").alias("_wanted"))
        sides = [df.join(wanted, bucket == F.col("_wanted"), "left_semi") for df in sides]
    found = _differing(*[checksums(df, keys, names) for df in sides], by=keys)
    finding = F.when(F.col("l_rows").isNull(), MISSING_LEFT).when(F.col("r_rows").isNull(), MISSING_RIGHT).otherwise(DIFFERENT)
    here = [F.when(F.col("l_rows").isNull(), F.col(f"r_{k}")).otherwise(F.col(f"l_{k}")).alias(k) for k in keys]
    return found.select(*here, finding.alias("finding"))
