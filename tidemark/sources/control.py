"""Control tables below one root: load config, run state, merge config, audit, snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import BLANKS, clean_text
from tidemark.functions.timestamps import ntz
from tidemark.operators.config import FULL, expired_snapshots, snapshot_name
from tidemark.schemas import AUDIT, LOAD_CONFIG, SNAPSHOT_MANIFEST
from tidemark.sources.storage import control_rows, delete, exists, read_current, update


# The text of a line that does not parse.
LINE = "_line"


def _cells(spark: SparkSession, path: str, sequence: str | None) -> DataFrame:
    """The lines of a CSV file by its header, and in LINE the whole line if it has not as many cells as the
    header, or its number is none."""
    names = spark.read.option("header", True).csv(path).columns
    kinds = [T.StructField(n, T.LongType() if n == sequence else T.StringType()) for n in names]
    reader = spark.read.schema(T.StructType([*kinds, T.StructField(LINE, T.StringType())])).option("header", True)
    cells = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).csv(path)
    # Cells are only counted where all of them are read, so the condition, which always holds, looks at each.
    return cells.filter(F.length(F.concat_ws("", *[F.col(n).cast("string") for n in names])) >= 0)


def damaged_lines(spark: SparkSession, path: str, sequence: str | None = None) -> DataFrame:
    """(damaged_line): the lines that ``read_load_config_csv`` leaves out because they do not parse, as they are."""
    return _cells(spark, path, sequence).filter(F.col(LINE).isNotNull()).select(F.col(LINE).alias("damaged_line"))


def read_load_config_csv(spark: SparkSession, path: str, sequence: str | None = None) -> DataFrame:
    """Load config from CSV with a header: all text, an empty cell is NULL.

    Columns go by name; one the file lacks is NULL, the load type then a full load.
    ``sequence`` names a further column that numbers the lines. Lines that do not parse are left to
    ``damaged_lines``: every line is in one of the two.
    """
    cells = _cells(spark, path, sequence).filter(F.col(LINE).isNull())
    absent = {c: F.lit(FULL if c == "load_type" else None).cast("string") for c in LOAD_CONFIG.fieldNames()}
    columns = [F.col(c) if c in cells.columns else v.alias(c) for c, v in absent.items()]
    return cells.select(*columns, *([F.col(sequence)] if sequence else []))


def load_config(spark: SparkSession, path: str, database: str | None = None) -> DataFrame:
    """Current load config, of one database or of all."""
    config = read_current(spark, path, LOAD_CONFIG)
    return config if database is None else config.filter(clean_text("database_name") == database.strip(BLANKS))


def append_audit(rows: DataFrame, path: str) -> None:
    rows.select(*AUDIT.fieldNames()).write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT).parquet(path)


def snapshot_tables(
    spark: SparkSession, tables: dict[str, DataFrame], root: str, taken_at: datetime | str
) -> DataFrame:
    """Copy tables to ``<root>/<table>-backup-<time>`` and record them in the manifest."""
    rows = []
    for name, df in tables.items():
        backup = spark.range(1).select(snapshot_name(F.lit(name), ntz(taken_at))).first()[0]
        df.write.mode("overwrite").parquet(f"{root}/{backup}")
        rows.append((name, backup, f"{root}/{backup}", datetime.fromisoformat(str(taken_at))))
    manifest = f"{root}/manifest"
    update(spark, manifest, SNAPSHOT_MANIFEST, lambda listed: listed.unionByName(control_rows(spark, rows, SNAPSHOT_MANIFEST)))
    return read_current(spark, manifest, SNAPSHOT_MANIFEST)


def expire_snapshots(spark: SparkSession, root: str, now: datetime | str, days: int) -> int:
    """Delete the copies past retention and drop them from the manifest; returns their number."""
    manifest = f"{root}/manifest"
    listed = read_current(spark, manifest, SNAPSHOT_MANIFEST)
    gone = expired_snapshots(listed, now, days)
    paths = [r["path"] for r in gone.select("path").collect()]
    for path in paths:
        if exists(spark, path):
            delete(spark, path)
    if paths:
        names = control_rows(spark, [(p,) for p in paths], T.StructType([T.StructField("path", T.StringType())]))
        update(spark, manifest, SNAPSHOT_MANIFEST, lambda newest: newest.join(names, "path", "left_anti"))
    return len(paths)


def split_names(text: str) -> Sequence[str]:
    """Names in a comma list."""
    return [name.strip() for name in text.split(",")]
