"""Merge jobs: RAW into staging, for one table and for a schema."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cdc import raw_since
from tidemark.operators.config import KEY, advance_merge_watermark, merge_config, one_per_key
from tidemark.plans.pools import in_threads, use_pool
from tidemark.schemas import MERGE_STATE
from tidemark.sources.control import split_names
from tidemark.sources.raw import finished_loads, raw_table, read_raw
from tidemark.sources.staging import KEPT_STATES, MergeCounts, StagingTable
from tidemark.sources.storage import control_rows, update

# Fixed value: tables merged at a time.
MERGE_WORKERS = 5

MERGE_RESULT = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("insert_timestamp", T.TimestampNTZType()),
        T.StructField("error", T.StringType()),
    ]
)


def merge_table(
    spark: SparkSession,
    raw: str,
    staging: StagingTable,
    change_cols: Sequence[str] = (),
    full_loaded_at: datetime | None = None,
    null_keys: str = "reject",
    keep_states: int | None = KEPT_STATES,
) -> MergeCounts:
    """Merge the RAW rows of loads that have not been merged into the staging table, and then delete
    what none of its last ``keep_states`` states reads (None: delete nothing).

    These are the rows stamped after the last merge, and those of loads with older stamps that
    have finished since. A row of such a late load does not replace one of a newer load.
    """
    last, merged = staging.high_mark(), staging.merged_loads()
    # Listed before rows are read: what finishes in between is news to the next merge.
    loads = finished_loads(spark, raw, full_loaded_at)
    known = last is not None and merged is not None
    late = sorted({load.stamp for load in loads if known and load.stamp <= last and load.id not in merged})
    rows = read_raw(spark, raw, since=max(filter(None, [last, full_loaded_at]), default=None), also=late)
    if rows is None:
        return MergeCounts(0, 0, 0, None)
    fresh = raw_since(raw_table(rows, full_loaded_at), last, also=late)
    done = staging.merge(fresh, change_cols, bool(late), null_keys, [load.id for load in loads])
    if keep_states is not None and done.high_mark is not None:
        staging.vacuum(keep_states)
    return done


def merge_schema(
    spark: SparkSession,
    config: DataFrame,
    schema: str,
    kind: str,
    raw_root: str,
    staging_root: str,
    plan: DataFrame | None = None,
    workers: int = MERGE_WORKERS,
    control: str | None = None,
) -> DataFrame:
    """Merge every configured table of a schema; one that fails is reported, the others go on.

    Table names are normalised, and rows of one table that say the same count once. If they
    differ, in the key or in the spelling of the source, the table fails and is not touched:
    two merges must not write one table.

    ``raw_root`` is the directory of one source, as RAW paths have it. The load plan, if given,
    says which change columns order rows of one load, and where each RAW table starts. With
    ``control`` the merge state there, one mark per table, is advanced to what was merged;
    jobs of several schemas may share it.
    """
    tables = one_per_key(merge_config(config, schema, kind), KEY)
    if plan is None:
        tables = tables.withColumns(
            {"change_cols": F.array().cast("array<string>"), "full_loaded_at": F.lit(None).cast("timestamp_ntz")}
        )
    else:
        source = [F.col(c).alias("source_" + c.removesuffix("_name")) for c in KEY]
        planned = plan.select(*source, "change_cols", "full_loaded_at")
        tables = tables.join(planned, ["source_database", "source_table"], "left")

    def run(table: Row) -> tuple:
        name = (table["database_name"], table["table_name"])
        use_pool(spark, *name)
        try:
            if table["repeated"]:
                raise ValueError("the config names this table more than once, in different ways")
            keys = split_names(table["partition_col"])
            staging = StagingTable(spark, f"{staging_root}/{name[0]}/{name[1]}", keys)
            raw = f"{raw_root}/{table['source_database']}/{table['source_table']}"
            done = merge_table(spark, raw, staging, table["change_cols"] or (), table["full_loaded_at"])
            mark = max(filter(None, [done.high_mark, staging.high_mark()]), default=None)
            return (*name, "SUCCESS", done.updated, done.inserted, done.rejected, mark, None)
        except Exception as e:
            return (*name, "FAILED", None, None, None, None, str(e))

    results = control_rows(spark, in_threads(spark, run, tables.collect(), workers), MERGE_RESULT)
    if control is not None:
        merged = results.filter("status = 'SUCCESS'")
        update(spark, f"{control}/merge_state", MERGE_STATE, lambda state: advance_merge_watermark(state, merged))
    return results


