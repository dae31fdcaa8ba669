"""Load config, run state and the tables that steer the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import as_column, clean_text, normalise_name, quote_name
from tidemark.functions.timestamps import format_watermark, ntz, parse_watermark
from tidemark.operators.upsert import rejected_rows, upsert

KEY = ["database_name", "table_name"]

# The load types, and what a config row must state.
FULL, CDC = "full_load", "cdc_load"
REQUIRED = ["database_name", "table_name", "partition_col"]


def last_per_key(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The row of the highest sequence number per key, without that column."""
    rest = [c for c in df.columns if c not in keys and c != sequence]
    last = F.max_by(F.struct(*rest), F.col(sequence)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*").select(*[c for c in df.columns if c != sequence])


def one_per_key(df: DataFrame, keys: Sequence[str], sequence: str | None = None) -> DataFrame:
    """One row per key, NULL being a value, and in ``repeated`` whether rows of it disagreed.

    With ``sequence`` the row of the highest number counts, and nothing is in dispute.
    Without it the largest row stands for the key. At most two rows of a key travel.
    """
    rest = [c for c in df.columns if c not in keys and c != sequence]
    row = F.struct(*rest)
    if sequence:
        picked, repeated = F.max_by(row, F.col(sequence)), F.lit(False)
    else:
        picked, repeated = F.max(row), F.min(row) != F.max(row)
    best = df.groupBy(*keys).agg(picked.alias("_row"), repeated.alias("repeated"))
    return best.select(*keys, "_row.*", "repeated")


def seed_config(current: DataFrame, incoming: DataFrame, sequence: str) -> DataFrame:
    """Config after the seed: each incoming row replaces its key, the last line of a key wins.

    Lines have no order in a distributed read, so ``sequence`` carries it. Names compare
    stripped, as they are planned. Lines without a name are left to ``unnamed_lines``.
    """
    named = [df.withColumns({c: clean_text(c) for c in KEY}) for df in (current, incoming)]
    return upsert(named[0], last_per_key(named[1], KEY, sequence), KEY)


def unnamed_lines(incoming: DataFrame) -> DataFrame:
    """Lines of a seed that name no database or table, and so cannot be put into the config."""
    return rejected_rows(incoming.withColumns({c: clean_text(c) for c in KEY}), KEY)


def sync_config(config: DataFrame) -> DataFrame:
    """Merge config: table and key column of every load config row, stripped, blank as NULL."""
    return config.select(*[clean_text(c).alias(c) for c in [*KEY, "partition_col"]])


def merge_config(config: DataFrame, schema: str, kind: str) -> DataFrame:
    """Tables to merge for one schema, names in upper case, and as configured for their files.

    ``kind`` picks the rows: ``batch``, in any case, or the stream rows for all else.
    """
    wanted = "batch" if kind.lower() == "batch" else "stream"
    named = config.withColumns({c: clean_text(c) for c in KEY})
    return named.filter((F.col("kind") == wanted) & (F.col("database_name") == schema)).select(
        *[normalise_name(c).alias(c) for c in KEY],
        F.col("database_name").alias("source_database"),
        F.col("table_name").alias("source_table"),
        "partition_col",
    )


def merge_task_for(registry: DataFrame, databases: DataFrame) -> DataFrame:
    """Databases with the merge task registered for them, NULL where none is.

    Names compare without case; of several entries the one at the first position counts.
    """
    first = registry.groupBy(F.lower("database_name").alias("_name")).agg(
        F.min_by("task_name", "position").alias("task_name")
    )
    wanted = databases.withColumn("_name", F.lower("database_name"))
    return wanted.join(first, "_name", "left").drop("_name")


def merge_task(registry: DataFrame, database: str) -> str:
    """Merge task of one database; none is an error."""
    wanted = F.lower("database_name") == database.lower()
    found = registry.filter(wanted).agg(F.min_by("task_name", "position")).first()[0]
    if found is None:
        raise LookupError(f"no merge task for database {database!r}")
    return found


def invalid_config(config: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """Config rows with required fields that are missing or blank, and which those are. A blank
    load type is none of them: it means a full load."""
    missing = F.array_compact(F.array(*[F.when(clean_text(c).isNull(), F.lit(c)) for c in required]))
    return config.withColumn("missing", F.array_join(missing, ", ")).filter(F.col("missing") != "")


def repeated_config(config: DataFrame) -> DataFrame:
    """Keys with more than one config row; names compare stripped."""
    return config.groupBy(*[clean_text(c).alias(c) for c in KEY]).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def tables_per_database(config: DataFrame) -> DataFrame:
    return config.groupBy("database_name").agg(F.count(F.lit(1)).alias("tables"))


def ready(df: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of the databases whose extraction is complete."""
    done = status.filter(F.upper(clean_text("is_extraction_complete")) == "TRUE")
    return df.join(done.select("database_name").distinct(), "database_name", "left_semi")


def change_columns(*cols: Column | str) -> Column:
    """The change columns that are set, in order."""
    return F.array_compact(F.array(*[clean_text(c) for c in cols]))


def advance_source_watermark(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Run state after extracts that saw changes up to ``last_updated_on``.

    A watermark never goes back, and an extract without any change value leaves it alone.
    """
    return _advance(
        state,
        updates,
        KEY,
        "last_updated_on",
        parse_watermark,
        format_watermark,
    )


def advance_merge_watermark(state: DataFrame, updates: DataFrame) -> DataFrame:
    """Merge state after merges up to ``insert_timestamp``; no new rows leave it alone."""
    return _advance(
        state, updates, ["schema_name", "table_name"], "insert_timestamp", lambda c: c, lambda c: c
    )


def _advance(state: DataFrame, updates: DataFrame, keys: list[str], mark: str, read, write) -> DataFrame:
    """Per key the larger mark of state and updates. Both sides are reduced per key before
    they travel; other state columns come from the state."""
    kept = [c for c in state.columns if c not in [*keys, mark]]
    both = state.withColumn(mark, read(F.col(mark))).unionByName(
        updates.select(*keys, read(F.col(mark)).alias(mark), *[c for c in kept if c in updates.columns]),
        allowMissingColumns=True,
    )
    best = both.groupBy(*keys).agg(F.max(mark).alias(mark), *[F.max(c).alias(c) for c in kept])
    return best.withColumn(mark, write(F.col(mark))).select(*state.columns)


def catalogue_of(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, ordinal_position`` of the columns that the tables have."""
    rows = [(t, c, i) for t, df in tables.items() for i, c in enumerate(df.schema.fieldNames(), 1)]
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal_position int")


def column_list(catalogue: DataFrame) -> DataFrame:
    """Per table its quoted column names, in order. ``catalogue`` is as ``catalogue_of`` has it."""
    return _listed(catalogue, quote_name("column_name"), "column_list")


def update_pairs(catalogue: DataFrame) -> DataFrame:
    """Per table the assignments of an update of all columns."""
    name = quote_name("column_name")
    return _listed(catalogue, F.concat(F.lit("target."), name, F.lit(" = source."), name), "update_pairs")


def insert_values(catalogue: DataFrame) -> DataFrame:
    """Per table the values of an insert of all columns."""
    return _listed(catalogue, F.concat(F.lit("source."), quote_name("column_name")), "insert_values")


def _listed(catalogue: DataFrame, item: Column, alias: str) -> DataFrame:
    # A list has one entry per column of a table, so it is bounded by how wide tables are.
    entries = catalogue.select("table_name", "ordinal_position", item.alias("item"))
    ordered = F.expr("listagg(item, ', ') WITHIN GROUP (ORDER BY ordinal_position)")
    return entries.groupBy("table_name").agg(ordered.alias(alias))


def snapshot_name(table: Column | str, taken_at: Column) -> Column:
    """Name of a copy: table, and UTC time to the second."""
    clock = F.translate(F.substring(taken_at.cast("timestamp_ntz").cast("string"), 1, 19), " :", "--")
    return F.concat(as_column(table), F.lit("-backup-"), clock)


def expired_snapshots(manifest: DataFrame, now: datetime | str | Column, days: int) -> DataFrame:
    """Copies made strictly before ``days`` days ago."""
    return manifest.filter(F.col("created_at") < ntz(now) - F.expr(f"interval {int(days)} days"))

