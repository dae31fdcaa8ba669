"""Reconciliation job: do source, RAW and staging have the same rows of a table?"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cdc import STAMP
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.reconcile import differing_keys
from tidemark.operators.upsert import has_null_key
from tidemark.sources.raw import raw_table, read_raw
from tidemark.sources.staging import StagingTable

SOURCE, RAW, STAGING = "source", "raw", "staging"


def reconcile_table(
    spark: SparkSession,
    source: DataFrame,
    raw: str,
    staging: StagingTable,
    keys: Sequence[str],
    change_cols: Sequence[str] = (),
    full_loaded_at: datetime | None = None,
) -> DataFrame:
    """(keys, left, right, finding): keys that differ between the source and the newest rows of RAW, and
    between these and staging. Rows that came after the extract are findings of the first kind; a
    merge that is due shows in the second one. Rows with a NULL key are in no staging table, and not compared.
    """
    rows = read_raw(spark, raw, since=full_loaded_at)
    newest = source.limit(0)
    if rows is not None:
        newest = dedupe_latest(raw_table(rows, full_loaded_at), keys, [STAMP, *change_cols])
        newest = newest.filter(~has_null_key(keys))
    staged = staging.read()
    staged = newest.limit(0) if staged is None else staged
    named = source.filter(~has_null_key(keys))
    parts = [
        differing_keys(named, newest, keys).select(*keys, F.lit(SOURCE).alias("left"), F.lit(RAW).alias("right"), "finding"),
        differing_keys(newest, staged, keys).select(*keys, F.lit(RAW).alias("left"), F.lit(STAGING).alias("right"), "finding"),
    ]
    return parts[0].unionByName(parts[1])
