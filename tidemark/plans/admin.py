"""Jobs on the control tables: seed, sync, back up."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.config import seed_config, sync_config, unnamed_lines
from tidemark.schemas import LOAD_CONFIG, MERGE_CONFIG
from tidemark.sources.control import (
    damaged_lines,
    expire_snapshots,
    load_config,
    read_load_config_csv,
    snapshot_tables,
    split_names,
)
from tidemark.sources.storage import current_version, update, version_path

# Why a line is in ``rejected_config``.
UNNAMED, DAMAGED = "unnamed", "damaged"


def seed(spark: SparkSession, csv_path: str, control: str, sequence: str, kind: str = "stream") -> int:
    """Put the lines of a CSV file into the load config; returns the new version. Lines without a
    name, and lines that do not parse, as they are, go to ``rejected_config`` with the reason."""
    path = f"{control}/{kind}_config"
    lines = read_load_config_csv(spark, csv_path, sequence)
    damaged = damaged_lines(spark, csv_path, sequence).withColumn("reason", F.lit(DAMAGED))
    rejected = unnamed_lines(lines).withColumn("reason", F.lit(UNNAMED)).unionByName(damaged, allowMissingColumns=True)
    rejected.withColumn("kind", F.lit(kind)).write.mode("append").parquet(f"{control}/rejected_config")
    return update(spark, path, LOAD_CONFIG, lambda config: seed_config(config, lines, sequence))


def sync_all(spark: SparkSession, control: str) -> int:
    """Replace the merge config by what both load configs say; returns the new version. A sync that
    another one overtakes reads the load configs again, so an older reading never stays."""

    def synced(_: DataFrame) -> DataFrame:
        kinds = [
            sync_config(load_config(spark, f"{control}/{kind}_config")).withColumn("kind", F.lit(kind))
            for kind in ("batch", "stream")
        ]
        return kinds[0].unionByName(kinds[1])

    schema = T.StructType([*MERGE_CONFIG.fields, T.StructField("kind", T.StringType())])
    return update(spark, f"{control}/merge_config", schema, synced)


def backup(
    spark: SparkSession, tables: str, control: str, backups: str, taken_at: datetime, days: int
) -> int:
    """Copy the named control tables, then drop copies past retention; returns how many went."""
    frames = {}
    for name in split_names(tables):
        path = f"{control}/{name}"
        frames[name] = spark.read.parquet(version_path(path, current_version(spark, path)))
    snapshot_tables(spark, frames, backups, taken_at)
    return expire_snapshots(spark, backups, taken_at, days)
