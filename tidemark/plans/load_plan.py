"""What to load: one row per configured table, with how and from when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import clean_text, flag
from tidemark.functions.timestamps import cdc_cutoff, parse_watermark
from tidemark.operators.config import CDC, FULL, KEY, change_columns, one_per_key
from tidemark.sources.databases import LOOKBACK_MINUTES, SPLITS


def load_plan(
    config: DataFrame,
    state: DataFrame,
    kind: str = "batch",
    unknown: str = "report",
    sequence: str | None = None,
    splits: int | None = None,
) -> DataFrame:
    """Config joined with run state, and the action that follows: one row per table.

    Names are stripped first. Of several rows of a table the one with the highest
    ``sequence`` counts; without such a column, rows that say different things make the
    table an ERROR (``repeated_config``), as two loads of one table must not run at once.
    ``splits`` overrides the number of parallel reads of a split table.

    ``action`` is FULL, CDC, SKIPPED or ERROR, with a ``reason`` for the last two. A blank
    load type means a full load. ``unknown`` says what becomes of other load types:
    ``report`` keeps them as ERROR, ``drop`` leaves them out, ``raise`` fails the query.
    """
    if unknown not in ("report", "drop", "raise"):
        raise ValueError(f"unknown must be 'report', 'drop' or 'raise', not {unknown!r}")
    load_type = F.coalesce(clean_text("load_type"), F.lit(FULL))
    marks = state.select(*KEY, "last_updated_on", "full_loaded_at")
    named = one_per_key(config.withColumns({c: clean_text(c) for c in KEY}), KEY, sequence)
    known_state = marks.withColumns({c: clean_text(c) for c in KEY})
    planned = named.join(known_state, KEY, "left").select(
        "repeated",
        *KEY,
        load_type.alias("load_type"),
        change_columns("incremental_col1", "incremental_col2", "incremental_col3").alias("change_cols"),
        clean_text("partition_col").alias("merge_key"),
        F.when(flag("is_partitioned"), clean_text("partition_col")).alias("split_col"),
        F.when(flag("is_partitioned"), F.lit(splits or SPLITS[kind])).otherwise(F.lit(1)).alias("splits"),
        parse_watermark("last_updated_on").alias("last_updated_on"),
        (clean_text("last_updated_on").isNotNull() & parse_watermark("last_updated_on").isNull()).alias("unreadable"),
        "full_loaded_at",
    )
    known = F.col("load_type").isin(FULL, CDC) & ~F.col("repeated")
    if unknown == "drop":
        planned = planned.filter(F.col("load_type").isin(FULL, CDC))
    error = F.lit("unknown_load_type")
    if unknown == "raise":
        error = F.raise_error(F.concat(F.lit("unknown load type: "), F.col("load_type")))
    reason = (
        F.when(F.col("repeated"), F.lit("repeated_config"))
        .when(~known, error)
        .when(F.col("load_type") == FULL, F.lit(None))
        .when(F.col("unreadable"), F.lit("unreadable_watermark"))
        .when(F.col("last_updated_on").isNull(), F.lit("no_watermark"))
        .when(F.size("change_cols") == 0, F.lit("no_change_columns"))
    )
    action = (
        F.when(F.col("reason").isin("unknown_load_type", "repeated_config", "unreadable_watermark"), "ERROR")
        .when(F.col("reason").isNotNull(), "SKIPPED")
        .when(F.col("load_type") == FULL, "FULL")
        .otherwise("CDC")
    )
    cutoff = F.when(F.col("action") == "CDC", cdc_cutoff("last_updated_on", LOOKBACK_MINUTES[kind]))
    decided = planned.withColumn("reason", reason).withColumn("action", action).withColumn("cutoff", cutoff)
    return decided.drop("repeated", "unreadable")
