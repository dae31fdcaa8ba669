"""Histories of rows: validity intervals from successive versions, and facts joined as of a time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe_latest

VALID_FROM, VALID_TO, CURRENT = "valid_from", "valid_to", "is_current"
# Time that rows of one key may share a task for in an as-of join.
WIDTH = "30 days"


def history(
    changes: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str] | None = None, order_cols: Sequence[str] = ()
) -> DataFrame:
    """(keys, columns, valid_from, valid_to, is_current): the versions of each key that its changes make.

    ``columns`` are what is followed, all others unless named. A change that changes none of them makes
    no version, whatever it brings. Of changes at one time the last by ``order_cols`` counts. An interval
    ends where the next begins; the current one has no end. Changes without a time or with a NULL
    key are in no history.
    """
    columns = list(columns) if columns is not None else [c for c in changes.columns if c not in [*keys, at]]
    timed = changes.filter(reduce(and_, [F.col(c).isNotNull() for c in [*keys, at]]))
    one = dedupe_latest(timed, [*keys, at], order_cols).select(*keys, F.col(at).alias(VALID_FROM), *columns)
    by_time = Window.partitionBy(*keys).orderBy(VALID_FROM)
    row = F.struct(*columns)
    # A struct is never NULL itself, so there is none before the first version only.
    before = F.lag(row).over(by_time)
    new = one.withColumn("_new", before.isNull() | ~before.eqNullSafe(row)).filter("_new").drop("_new")
    until = F.lead(VALID_FROM).over(by_time)
    return new.withColumn(VALID_TO, until).withColumn(CURRENT, F.col(VALID_TO).isNull())


def as_of(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str], width: str = WIDTH
) -> DataFrame:
    """The facts, each with the ``columns`` of the version of its key that was valid at its time, NULL before the
    first one, without a key or without a time.

    Not a join by ranges: facts and versions of a key and a stretch of time are sorted together, and a
    fact takes the last version before it. What was valid when a stretch begins comes from one row for each
    key and stretch. So a key with very many facts is shared by as many tasks as there are stretches,
    and each side is shuffled once.
    """
    span = F.expr(f"unix_micros(cast(timestamp'1970-01-01 00:00:00' + interval {width} as timestamp))")
    span = span - F.expr("unix_micros(cast(timestamp'1970-01-01 00:00:00' as timestamp))")
    stretch = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / span)
    version = F.struct(F.col(VALID_FROM).cast("timestamp_ntz").alias("since"), *columns).alias("_version")
    valid = reduce(and_, [F.col(c).isNotNull() for c in [*keys, at]])
    none = facts.filter(~valid).withColumns({c: F.lit(None).cast(versions.schema[c].dataType) for c in columns})
    starts = versions.select(*keys, F.col(VALID_FROM).cast("timestamp_ntz").alias("_at"), stretch(VALID_FROM).alias("_stretch"), version)
    given = facts.filter(valid).select(*keys, F.col(at).cast("timestamp_ntz").alias("_at"), stretch(at).alias("_stretch"), F.struct(*facts.columns).alias("_fact"))
    both = given.unionByName(starts, allowMissingColumns=True)

    # a version that begins with the fact is valid for it, so versions come first
    within = Window.partitionBy(*keys, "_stretch").orderBy("_at", F.col("_fact").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    own = both.withColumn("_own", F.last("_version", ignorenulls=True).over(within)).filter(F.col("_fact").isNotNull())

    newest = F.max(F.when(F.col("_version").isNotNull(), F.struct("_at", "_version")))
    ends = both.groupBy(*keys, "_stretch").agg(newest["_version"].alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).filter(F.col("_carried").isNotNull())
    carried = carried.select(*[F.col(c).alias(f"_{c}") for c in [*keys, "_stretch"]], "_carried")
    same = reduce(and_, [F.col(c) == F.col(f"_{c}") for c in [*keys, "_stretch"]])
    found = own.join(carried, same, "left").withColumn("_found", F.coalesce("_own", "_carried"))
    return found.select("_fact.*", *[F.col("_found")[c].alias(c) for c in columns]).unionByName(none)


def changed_columns(versions: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> Column:
    """Which of the columns a version changed, for versions of ``history``; none for the first one."""
    by_time = Window.partitionBy(*keys).orderBy(VALID_FROM)
    first = F.lag(VALID_FROM).over(by_time).isNull()
    differs = [F.when(~first & ~F.col(c).eqNullSafe(F.lag(c).over(by_time)), F.lit(c)) for c in columns]
    return F.array_compact(F.array(*differs))
