"""Paths on the session's file systems, and small tables kept as numbered versions."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Versions kept unless a caller says otherwise.
KEPT_VERSIONS = 10
# Times an update is applied again when other writers come first, and the longest wait before one in seconds.
UPDATE_ATTEMPTS, LONGEST_WAIT = 50, 2.0


class VersionTaken(RuntimeError):
    """Another writer has published the version this one was about to."""


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _locate(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(_conf(spark)), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _locate(spark, path)
    return fs.exists(where)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _locate(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> bool:
    fs, where = _locate(spark, path)
    return fs.delete(where, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """A file to a place that is free, whose folder is made if it is missing."""
    fs, old = _locate(spark, source)
    _, new = _locate(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, there as a whole or not at all."""
    fs, where = _locate(spark, path)
    aside = where.getParent().suffix(f"/_{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    fs.rename(aside, where)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _locate(spark, path)
    source = fs.open(where)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def control_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of the driver's own as a frame; by way of Arrow no Python worker is started."""
    columns = {name: [row[i] for row in rows] for i, name in enumerate(schema.fieldNames())}
    return spark.createDataFrame(pa.table(columns), schema).coalesce(1)


def version_path(path: str, version: int) -> str:
    return f"{path}/v={version:010d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all versions, whole or not, oldest first."""
    return [int(n[2:]) for n in child_names(spark, path) if n.startswith("v=")]


def current_version(spark: SparkSession, path: str) -> int | None:
    """Newest version whose write ended with its success marker."""
    newest_first = reversed(versions(spark, path))
    return next((v for v in newest_first if exists(spark, f"{version_path(path, v)}/_SUCCESS")), None)


def read_current(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newest complete version, or no rows before the first one."""
    version = current_version(spark, path)
    if version is None:
        return control_rows(spark, [], schema)
    return spark.read.schema(schema).parquet(version_path(path, version))


def publish(df: DataFrame, path: str, number: int | None = None, keep: int = KEPT_VERSIONS) -> int:
    """Write version ``number``, the next one by default. It is written aside and takes its
    name in one step, which fails if the version is there already: of two writers that start
    from one version, one gets ``VersionTaken`` and changes nothing. A crash leaves the version
    before as the newest. All but the last ``keep`` versions are removed."""
    spark = df.sparkSession
    number = number or (current_version(spark, path) or 0) + 1
    aside = f"{path}/_aside-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    taken = version_path(path, number)
    if exists(spark, taken) and not exists(spark, f"{taken}/_SUCCESS"):
        delete(spark, taken)  # what a write in place left unfinished
    # The name is also gone when so many versions have come since that this one was removed again.
    if (current_version(spark, path) or 0) >= number or not _take_name(spark, aside, taken):
        delete(spark, aside)
        raise VersionTaken(f"version {number} of {path} was published by another writer")
    for old in versions(spark, path):
        if old <= number - keep:
            delete(spark, version_path(path, old))
    return number


def update(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    change: Callable[[DataFrame], DataFrame],
    attempts: int = UPDATE_ATTEMPTS,
    keep: int = KEPT_VERSIONS,
) -> int:
    """Publish what ``change`` makes of the newest version, as the version right after it.

    If another writer publishes in between, the change is applied again to what that one left, so
    no update is lost however many writers share the table. ``change`` must read whatever else it
    depends on anew each time. Returns the number of the new version.
    """
    for left in reversed(range(attempts)):
        version = current_version(spark, path) or 0
        try:
            # The version that is read is fixed here: the change can't see a newer one than it is checked against.
            state = spark.read.schema(schema).parquet(version_path(path, version)) if version else control_rows(spark, [], schema)
            return publish(change(state), path, version + 1, keep)
        except Exception as e:
            # A version is removed once ``keep`` newer ones are there: then the read is out of date as well.
            outrun = isinstance(e, VersionTaken) or (current_version(spark, path) or 0) > version
            if not left or not outrun:
                raise
            time.sleep(random.uniform(0, LONGEST_WAIT) / (left + 1))
    raise ValueError("attempts must be at least 1")


def _take_name(spark: SparkSession, source: str, target: str) -> bool:
    """Give a directory its final name unless that is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(source), hadoop.Path(target)
    files = hadoop.FileContext.getFileContext(
        new.toUri() if new.toUri().getScheme() else hadoop.FileSystem.get(_conf(spark)).getUri(), _conf(spark)
    )
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(old, new, options)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or exists(spark, target):
            return False
        raise
    return True
