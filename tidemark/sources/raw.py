"""RAW files: stamped Parquet below ``<root>/<source>/<database>/<table>/`` by load date and hour."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone
from functools import reduce
from typing import Any, NamedTuple
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import LOAD_ZONE, load_partition, ntz
from tidemark.functions.types import widest_fields
from tidemark.operators.cdc import STAMP
from tidemark.sources.storage import child_names, delete, move, read_text, write_text

# The longest output file in rows, its codec, and the tries of a batch write.
MAX_ROWS_PER_FILE = 1000000
CODEC = "snappy"
WRITE_ATTEMPTS = 3

PARTITIONS = ["load_date", "load_hour"]
# Folder of the notes of columns; readers of files pass it over for its first letter.
SCHEMAS = "_schemas"
# Folders of the ledger of finished loads, and of loads that are being written.
LOADS, LANDING = "_loads", "_landing"
_STAMP_FORMAT = "%Y%m%dT%H%M%S.%f"


class Load(NamedTuple):
    """A finished load: its number, drawn anew for each, its stamp, and which note has its columns."""

    id: str
    stamp: datetime
    note: str


def raw_path(root: str, directory: str, database: str, table: str) -> str:
    return f"{root}/{directory}/{database}/{table}"


def write_mode(load_type: str) -> str:
    """A full load replaces, a change load adds."""
    return "overwrite" if load_type == "full_load" else "append"


def write_raw(stamped: DataFrame, path: str, load_ts: datetime | str, mode: str, zone: str = LOAD_ZONE) -> None:
    """Write one extract into the partition of its load time, and enter it in the ledger of loads.

    Overwrite is per partition: it replaces the hour being written and no other. An extract
    without rows makes no partition, so it changes nothing in either mode. Files are written
    aside, moved to their places under the load's number, and then the load is entered; readers
    that go by the ledger (``finished_loads``) so find a load when all of it is there, in whatever
    order loads finish.
    """
    taken = [c for c in PARTITIONS if c in stamped.columns]
    if taken:
        raise ValueError(f"columns {taken} name the RAW partitions: rename them in the extract")
    date, hour = load_partition(load_ts, zone)
    spark, number = stamped.sparkSession, uuid.uuid4().hex
    note = record_schema(spark, path, stamped.schema)
    aside = f"{path}/{LANDING}/{number}"
    (
        stamped.withColumns({"load_date": date, "load_hour": hour})
        .write.option("compression", CODEC)
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .partitionBy(*PARTITIONS)
        .parquet(aside)
    )
    files = _put_in_place(spark, path, aside, number, mode)
    stamp = datetime.fromisoformat(str(load_ts))
    entry = f"{stamp.strftime(_STAMP_FORMAT)}~{note[:16]}~{number}.json"
    write_text(spark, f"{path}/{LOADS}/{entry}", json.dumps({"stamp": str(stamp), "mode": mode, "files": files}))


def _put_in_place(spark: SparkSession, path: str, aside: str, number: str, mode: str) -> list[str]:
    """Move the files of a load to its hour; those that an overwrite replaces go after that, so a
    crash leaves rows twice rather than none."""
    moved = []
    try:
        for folder in _hours(spark, aside):
            before = [f"{path}/{folder}/{n}" for n in child_names(spark, f"{path}/{folder}")]
            names = [n for n in child_names(spark, f"{aside}/{folder}") if n.endswith(".parquet")]
            for k, name in enumerate(names):
                target = f"{folder}/part-{number}-{k:05d}.{CODEC}.parquet"
                move(spark, f"{aside}/{folder}/{name}", f"{path}/{target}")
                moved.append(target)
            for old in before if mode == "overwrite" else ():
                delete(spark, old)
    except Exception:
        for target in moved:
            delete(spark, f"{path}/{target}")
        raise
    finally:
        delete(spark, aside)
    return moved


def _hours(spark: SparkSession, path: str) -> list[str]:
    dates = [n for n in child_names(spark, path) if n.startswith("load_date=")]
    return [f"{d}/{h}" for d in dates for h in child_names(spark, f"{path}/{d}") if h.startswith("load_hour=")]


def finished_loads(spark: SparkSession, path: str, since: datetime | None = None) -> list[Load]:
    """The ledger: loads in order of their stamps, from ``since`` on. Names tell all, so nothing is
    opened. Files that landed before there was a ledger are in no load."""
    found = []
    for name in child_names(spark, f"{path}/{LOADS}"):
        if name.endswith(".json") and name.count("~") == 2:
            stamp, note, number = name.removesuffix(".json").split("~")
            found.append(Load(number, datetime.strptime(stamp, _STAMP_FORMAT), note))
    return [load for load in sorted(found, key=lambda load: load.stamp) if since is None or load.stamp >= since]


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> str:
    """Note the columns of a load beside the files, before they land, so that readers need not
    open every file to learn them; returns the note's name. Files that were there before the first
    note are opened once."""
    known = child_names(spark, f"{path}/{SCHEMAS}")
    notes = [schema]
    if not known and any(n.startswith("load_date=") for n in child_names(spark, path)):
        notes.append(_opened(spark, path, [path]).drop(*PARTITIONS).schema)
    for note in notes:
        text = _nullable(note).json()
        name = _note_name(note)
        if name not in known:
            write_text(spark, f"{path}/{SCHEMAS}/{name}", text)
    return _note_name(schema)


def _note_name(schema: T.StructType) -> str:
    return f"{hashlib.sha256(_nullable(schema).json().encode()).hexdigest()}.json"


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def _notes(spark: SparkSession, path: str) -> dict[str, T.StructType]:
    names = child_names(spark, f"{path}/{SCHEMAS}")
    return {n: T.StructType.fromJson(json.loads(read_text(spark, f"{path}/{SCHEMAS}/{n}"))) for n in names}


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """All columns of the loads so far; None without notes, or if loads disagree on a type."""
    fields: dict[str, T.StructField] = {}
    for note in _notes(spark, path).values():
        for f in note.fields:
            if fields.setdefault(f.name, f).dataType != f.dataType:
                return None
    return T.StructType(list(fields.values())) if fields else None


def _opened(spark: SparkSession, path: str, paths: list[str]) -> DataFrame:
    """Files with the columns of all of them, which takes a look at each."""
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*paths)


def write_with_retry(write: Callable[[], Any], attempts: int = WRITE_ATTEMPTS) -> Any:
    """Run a whole write again when it fails, on top of Spark's own retries of its tasks."""
    for left in reversed(range(attempts)):
        try:
            return write()
        except Exception:
            if not left:
                raise


def read_raw(
    spark: SparkSession,
    path: str,
    since: datetime | str | None = None,
    zone: str = LOAD_ZONE,
    also: Sequence[datetime] = (),
) -> DataFrame | None:
    """RAW rows with their load date and hour as text; None where no file qualifies.

    ``since`` names a stamp below which nothing is wanted: directories of earlier load hours
    are neither listed nor opened, but for the hours of the stamps in ``also``. Columns are those
    that any load noted; where there are no notes, those of the files that are read. Where loads
    differ in the type of a column, it has the narrowest type that holds the values of all.
    """
    parts = [f"{path}/{n}" for n in child_names(spark, path) if n.startswith("load_date=")]
    if since is not None:
        local = _local(since, zone)
        first = f"{path}/load_date={local.date()}"
        hours = child_names(spark, first) if first in parts else []
        wanted = [f"{first}/{n}" for n in hours if n >= f"load_hour={local.hour:02d}"]
        later = [p for p in parts if p > first]
        places = {(_local(s, zone).date(), _local(s, zone).hour) for s in also}
        single = {f"{path}/load_date={date}/load_hour={hour:02d}" for date, hour in places if f"{path}/load_date={date}" not in later}
        single = sorted(p for p in single - set(wanted) if p.rsplit("/", 1)[1] in child_names(spark, p.rsplit("/", 1)[0]))
        parts = single + wanted + later
    if not parts:
        return None
    schema = noted_schema(spark, path)
    if schema is not None:
        rows = _read_as(spark, path, schema, parts)
    elif child_names(spark, f"{path}/{SCHEMAS}"):
        rows = _read_widened(spark, path, parts)
    else:
        rows = _opened(spark, path, parts)
    return rows.withColumns(
        {
            "load_date": F.col("load_date").cast("string"),
            "load_hour": F.lpad(F.col("load_hour").cast("string"), 2, "0"),
        }
    )


def _local(at: datetime | str, zone: str) -> datetime:
    return datetime.fromisoformat(str(at)).replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone))


def _read_as(spark: SparkSession, path: str, schema: T.StructType, places: Sequence[str]) -> DataFrame:
    columns = T.StructType(schema.fields + [T.StructField(p, T.StringType()) for p in PARTITIONS])
    return spark.read.schema(columns).option("basePath", path).parquet(*places)


def _read_widened(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """Loads that differ in types: one read for each note of columns, cast to the widest types. A file's
    name has its load, and the ledger the load's note. A folder whose files all have one note is
    read as a folder. Files from before the ledger are opened to learn their columns."""
    notes = _notes(spark, path)
    by_load = {load.id: next(n for n in notes if n.startswith(load.note)) for load in finished_loads(spark, path)}
    places: dict[str | None, list[str]] = {}
    for part in parts:
        folders = [part] if "/load_hour=" in part else [f"{part}/{h}" for h in child_names(spark, part)]
        for folder in folders:
            files: dict[str | None, list[str]] = {}
            for name in child_names(spark, folder):
                load = name.split("-")[1] if name.startswith("part-") else None
                files.setdefault(by_load.get(load), []).append(f"{folder}/{name}")
            for note, own in files.items():
                places.setdefault(note, []).extend([folder] if len(files) == 1 else own)
    widest = widest_fields(list(notes.values()))
    reads = []
    for note, own in places.items():
        rows = _opened(spark, path, own) if note is None else _read_as(spark, path, notes[note], own)
        kinds = {f.name: f.dataType for f in widest.fields}
        columns = [F.col(n).cast(kind) if n in rows.columns else F.lit(None).cast(kind) for n, kind in kinds.items()]
        reads.append(rows.select(*[c.alias(n) for c, n in zip(columns, kinds)], *[F.col(p).cast("string") for p in PARTITIONS]))
    return reduce(DataFrame.unionByName, reads)


def raw_table(raw: DataFrame, full_loaded_at: datetime | str | None) -> DataFrame:
    """The RAW table: what the last full load wrote and all change loads after it.

    A full load replaces the whole table while its files replace one hour only, so the
    table is the files from that load on; no second copy is written.
    """
    rows = raw if full_loaded_at is None else raw.filter(F.col(STAMP) >= ntz(full_loaded_at))
    return rows.drop(*PARTITIONS)
