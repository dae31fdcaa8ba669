"""Staging tables: one row per key, rewritten bucket by bucket.

Rows lie in hash buckets of their key. A merge writes only the buckets its increment
touches, below a directory of its own, and then publishes which directory each bucket is
read from, together with the merge's high mark. The table and its watermark so change in
one step: a crash before it leaves both as they were, and the merge is simply run again.
Of two writers that start from one state only one can publish; the other fails and may run
again. Buckets double in number when they have grown past twice their planned size.

What a merge does to a row depends on the row alone, never on the size of the load: columns
of the table that the load lacks are NULL in its rows, whichever plan is taken. A column whose type
has grown in the load grows in the table, which is then written anew once.

Beside its high mark a state names the loads that have been merged, so that one which finishes late,
under an older stamp, is not taken for merged.
"""

from __future__ import annotations

import json
import random
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import widest_fields
from tidemark.operators.cdc import STAMP
from tidemark.operators.dedupe import dedupe_latest
from tidemark.operators.upsert import FROM_SOURCE, has_null_key, inserts_null_keys, rejected_rows, upsert_stored
from tidemark.sources.storage import (
    child_names,
    control_rows,
    current_version,
    delete,
    publish,
    read_text,
    version_path,
    versions,
    write_text,
)

BUCKET, MERGE = "_bucket", "_merge"
BUCKET_BYTES = 512 * 1024 * 1024
MIN_BUCKETS, MAX_BUCKETS = 8, 1 << 20
MAX_TASKS = 65536
# States of a table that can be read while further merges run, where jobs delete what older ones read.
KEPT_STATES = 3
MAX_ROWS_PER_FILE = 10_000_000
_UNKNOWN_SIZE = 1 << 60
# Low bits of a merge's number, drawn anew for each attempt.
_ATTEMPT_BITS = 20

_CURRENT = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("merge", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("columns", T.StringType()),
        T.StructField("high_mark", T.TimestampNTZType()),
        T.StructField("loads", T.LongType()),
    ]
)


@dataclass(frozen=True)
class MergeCounts:
    updated: int = 0
    inserted: int = 0
    rejected: int = 0
    high_mark: datetime | None = None


def planned_bytes(df: DataFrame) -> int | None:
    """Size Catalyst plans with; for files it comes from their lengths. None if not known."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _UNKNOWN_SIZE else None


def broadcast_limit(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row, by the hash with which ``repartition(n, *keys)`` spreads rows: if ``n``
    is a multiple of the buckets, every task then has rows of one bucket only."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


class StagingTable:
    """A staging table at a path.

    ``buckets`` overrides the number its first load suggests, ``bucket_bytes`` is the size
    they are planned for. An increment of up to ``broadcast_bytes`` (Spark's limit unless
    set) is merged without a shuffle of the table.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        buckets: int | None = None,
        bucket_bytes: int = BUCKET_BYTES,
        max_buckets: int = MAX_BUCKETS,
        broadcast_bytes: int | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self._wanted_buckets = buckets
        self._bucket_bytes, self._max_buckets = bucket_bytes, max_buckets
        self._broadcast_bytes = broadcast_bytes
        self._seen: tuple[int, list[Row]] | None = None
        self._data = f"{self.path}/data"
        self._state = f"{self.path}/current"

    def _merge_path(self, number: int) -> str:
        # The directory name becomes a partition column when read; tables have columns like "v".
        return f"{self._data}/{MERGE}={number:020d}"

    def _entries(self) -> tuple[int, list[Row]]:
        """The published state and its number. States do not change, so each is read once."""
        version = current_version(self.spark, self._state) or 0
        if self._seen is None or self._seen[0] != version:
            state = self.spark.read.schema(_CURRENT).parquet(version_path(self._state, version)) if version else None
            self._seen = version, [] if state is None else state.collect()
        return self._seen

    def high_mark(self) -> datetime | None:
        """Stamp up to which RAW rows have been merged."""
        return max((e["high_mark"] for e in self._entries()[1]), default=None)

    def merged_loads(self) -> set[str] | None:
        """Numbers of the loads that have been merged; None if that was not noted."""
        noted = self._loads_noted(self._entries()[1])
        return None if noted is None else set(json.loads(read_text(self.spark, self._loads_path(noted))))

    def _loads_path(self, number: int) -> str:
        return f"{self.path}/loads/{number:020d}.json"

    @staticmethod
    def _loads_noted(entries: Sequence[Row]) -> int | None:
        return max((e["loads"] for e in entries if e["loads"] is not None), default=None)

    def read(self) -> DataFrame | None:
        """All rows; None before the first merge."""
        _, entries = self._entries()
        return self._rows(entries).drop(BUCKET) if entries else None

    def version(self) -> int:
        """Number of the published state, 0 before the first merge."""
        return self._entries()[0]

    def changes(self, since: int, until: int | None = None) -> DataFrame | None:
        """(keys, old, new): the rows that merges after state ``since`` changed, as they were and as they
        are, the one NULL for rows that came, the other for rows that went; None without a state.

        Only buckets that were written in between are read. Rows that differ in the load stamp alone
        have not changed. Both states must not have been vacuumed. Rows with a NULL key, where they
        are inserted, match no other, so those of written buckets go and come again.
        """
        until = self.version() if until is None else until
        after, before = ([] if n == 0 else self._state_at(n) for n in (until, since))
        if not after:
            return None
        if before and before[0]["buckets"] == after[0]["buckets"] and before[0]["columns"] == after[0]["columns"]:
            kept = {(e["bucket"], e["merge"]) for e in before} & {(e["bucket"], e["merge"]) for e in after}
            before, after = ([e for e in side if (e["bucket"], e["merge"]) not in kept] for side in (before, after))
        columns = _columns(self._state_at(until))
        image = F.struct(*columns.fieldNames())
        empty = self.spark.createDataFrame([], columns)
        sides = []
        for name, entries in (("old", before), ("new", after)):
            rows = _as_stored(self._rows(entries).drop(BUCKET), columns) if entries else empty
            sides.append(rows.select(*self.keys, image.alias(name)))
        both = sides[0].join(sides[1], self.keys, "full")
        said = [F.struct(*[F.col(side)[c] for c in columns.fieldNames() if c != STAMP]) for side in ("old", "new")]
        same = F.col("old").isNotNull() & F.col("new").isNotNull() & said[0].eqNullSafe(said[1])
        return both.filter(~same)

    def _state_at(self, version: int) -> list[Row]:
        return self.spark.read.schema(_CURRENT).parquet(version_path(self._state, version)).collect()

    def rejects(self) -> DataFrame | None:
        """Rows that merges left out for a NULL key, each at least once; None if there are none."""
        paths = [f"{self.path}/rejects/{n}" for n in child_names(self.spark, f"{self.path}/rejects")]
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def _rows(self, entries: Sequence[Row]) -> DataFrame:
        """Rows of the buckets. A merge of which every bucket is wanted is read as one
        directory; at most there is one path per bucket."""
        wanted: dict[int, list[str]] = {}
        for e in entries:
            wanted.setdefault(e["merge"], []).append(f"{BUCKET}={e['bucket']}")
        paths = []
        for merge, parts in wanted.items():
            base = self._merge_path(merge)
            whole = len(parts) == sum(n.startswith(BUCKET) for n in child_names(self.spark, base))
            paths += [base] if whole else [f"{base}/{part}" for part in parts]
        columns = _columns(entries).add(BUCKET, T.IntegerType())
        files = self.spark.read.schema(columns).option("basePath", self._data).parquet(*paths)
        return files.select(*columns.fieldNames())

    def merge(
        self,
        rows: DataFrame,
        change_cols: Sequence[str] = (),
        keep_newer: bool = False,
        null_keys: str = "reject",
        loads: Sequence[str] | None = None,
    ) -> MergeCounts:
        """Merge the newest row per key of ``rows``, which carry a load stamp, into the table.

        Newest is by stamp, then by change columns. The newest load wins over the table, or,
        with ``keep_newer``, only where the row of the table is not newer by the same order.
        ``null_keys`` is as for ``upsert``; rejected rows are written aside. ``loads`` are the
        numbers of all loads that have been merged once this is done, noted in the same step.
        """
        reject = not inserts_null_keys(null_keys)
        published, entries = self._entries()
        version = published + 1
        number = version << _ATTEMPT_BITS | random.getrandbits(_ATTEMPT_BITS)
        buckets = self._grown_buckets(entries) if entries else self._first_buckets(rows)
        order = [STAMP, *change_cols]

        columns = widest_fields([_columns(entries), rows.schema])
        widened = any(columns[f.name].dataType != f.dataType for f in _columns(entries).fields)
        rows = _as_stored(rows, columns)
        newest = dedupe_latest(rows, self.keys, order)
        # Taken while the rows pass by; both hold when a task is run twice. The one row that
        # is left of a NULL key tells whether any was there.
        seen = Observation()
        increment = newest.observe(
            seen,
            F.max(has_null_key(self.keys)).alias("null_keys"),
            F.max(STAMP).cast("string").alias("high"),
        ).withColumn(BUCKET, bucket_of(self.keys, buckets))
        if reject:
            increment = increment.filter(~has_null_key(self.keys))
        if entries:
            newer_by = order if keep_newer else []
            counts, touched, buckets = self._rewrite(number, increment, entries, buckets, newer_by, null_keys, widened)
        else:
            first = increment.withColumn(FROM_SOURCE, F.lit(True))
            # Where the tasks of a shuffle are a multiple of the buckets, the newest rows lie by
            # bucket already.
            if self._shuffle_tasks() % buckets:
                first = self._by_bucket(first, buckets)
            counts, touched = self._write(number, first, 0)
        high = seen.get["high"]
        if high is None:
            return MergeCounts()
        rejected = self._write_rejects(number, rows) if reject and seen.get["null_keys"] else 0
        if not touched:  # nothing was written, so nothing was widened
            columns, widened = _columns(entries), False
        kept = entries if entries and entries[0]["buckets"] == buckets and not widened else []
        noted = self._loads_noted(entries)
        if loads is not None:
            noted = number
            write_text(self.spark, self._loads_path(number), json.dumps(sorted(loads)))
        self._publish(version, number, entries, kept, touched, buckets, columns, high, noted)
        return MergeCounts(*counts, rejected, datetime.fromisoformat(high))

    def _write_rejects(self, number: int, rows: DataFrame) -> int:
        """Only loads that have NULL keys are read a second time for them."""
        seen = Observation()
        target = f"{self.path}/rejects/{MERGE}={number:020d}"
        out = rejected_rows(rows, self.keys).observe(seen, F.count(F.lit(1)).alias("rows"))
        out.write.mode("overwrite").parquet(target)
        return seen.get["rows"]

    def _rewrite(
        self,
        number: int,
        increment: DataFrame,
        entries: Sequence[Row],
        buckets: int,
        newer_by: Sequence[str],
        null_keys: str,
        widened: bool,
    ) -> tuple[tuple[int, int], set[int], int]:
        """Store the increment, then write the buckets it touches anew, or all if their number or
        the type of a column changes; returns that number too.

        The increment is read several times and its size decides how, so it is made once.
        """
        landing = version_path(f"{self.path}/increment", number)
        seen = Observation()
        observed = increment.observe(seen, F.collect_set(BUCKET).alias("touched"))  # at most all buckets
        observed.write.mode("overwrite").parquet(landing)
        stored = self.spark.read.schema(increment.schema).parquet(landing)
        touched = set(seen.get["touched"])
        if not touched:
            buckets = entries[0]["buckets"]
        anew = bool(touched) and (widened or entries[0]["buckets"] != buckets)
        old = entries if anew else [e for e in entries if e["bucket"] in touched]
        if anew:
            # Buckets split, or keys of another type fall into other ones, so all are written.
            rows = _as_stored(self._rows(old).drop(BUCKET), increment.drop(BUCKET).schema)
            target = rows.withColumn(BUCKET, bucket_of(self.keys, buckets))
            merged, before = self._merge_by_bucket(target, stored, newer_by, buckets), target.count()
        elif not touched or not old:
            merged, before = self._by_bucket(stored.withColumn(FROM_SOURCE, F.lit(True)), buckets), 0
        else:
            target = self._rows(old)
            before = target.count()  # from the footers
            size = planned_bytes(stored)
            limit = broadcast_limit(self.spark) if self._broadcast_bytes is None else self._broadcast_bytes
            if size is not None and size <= limit:
                # The table is not shuffled: a task reads a few of its buckets and writes them
                # again. Only the new rows are brought together by bucket.
                kept, added = upsert_stored(target, stored, self.keys, newer_by, null_keys)
                merged = kept.unionByName(added.repartition(BUCKET), allowMissingColumns=True)
            else:
                merged = self._merge_by_bucket(target, stored, newer_by, buckets)
        counts, written = self._write(number, merged, before)
        delete(self.spark, landing)
        return counts, written, buckets

    def _merge_by_bucket(
        self, target: DataFrame, increment: DataFrame, newer_by: Sequence[str], buckets: int
    ) -> DataFrame:
        """One shuffle of both sides by bucket and one sort, which serve the choice of the
        winner and the partitioned write alike. Keys are unique on each side."""
        both = target.withColumn(FROM_SOURCE, F.lit(False)).unionByName(
            increment.withColumn(FROM_SOURCE, F.lit(True)), allowMissingColumns=True
        )
        # A row with a NULL key has no match, so it gets a number that none shares.
        alone = F.when(has_null_key(self.keys), F.monotonically_increasing_id())
        placed = self._by_bucket(both, buckets).withColumn("_alone", alone)
        order = [*newer_by, FROM_SOURCE]
        return dedupe_latest(placed, [BUCKET, *self.keys, "_alone"], order).drop("_alone")

    def _by_bucket(self, df: DataFrame, buckets: int) -> DataFrame:
        """Rows shuffled so that a task has rows of one bucket; buckets that have grown, or are
        few for a large load, are shared by several tasks."""
        shares = (planned_bytes(df) or 0) // (buckets * self._bucket_bytes)
        return df.repartition(buckets * max(1, min(shares, MAX_TASKS // buckets)), *self.keys)

    def _write(self, number: int, merged: DataFrame, before: int) -> tuple[tuple[int, int], set[int]]:
        """Write buckets; returns rows updated and inserted, and which buckets there are."""
        done = Observation()
        total, from_source = F.count(F.lit(1)), F.count_if(F.col(FROM_SOURCE))
        target = self._merge_path(number)
        (
            merged.observe(done, total.alias("total"), from_source.alias("from_source"))
            .drop(FROM_SOURCE)
            .write.mode("overwrite")
            .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
            .partitionBy(BUCKET)
            .parquet(target)
        )
        inserted = done.get["total"] - before
        written = {int(n.split("=")[1]) for n in child_names(self.spark, target) if n.startswith(BUCKET)}
        return (done.get["from_source"] - inserted, inserted), written

    def _shuffle_tasks(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _first_buckets(self, rows: DataFrame) -> int:
        """Buckets of about half a gigabyte by the size of the first load, unless set, and if
        possible a number that divides the tasks of a shuffle."""
        if self._wanted_buckets:
            return self._wanted_buckets
        by_size = (planned_bytes(rows) or 0) // self._bucket_bytes
        wanted = min(self._max_buckets, max(MIN_BUCKETS, by_size))
        even = max(n for n in range(1, wanted + 1) if self._shuffle_tasks() % n == 0)
        return even if even * 2 >= wanted else wanted

    def _grown_buckets(self, entries: Sequence[Row]) -> int:
        """The table's number of buckets, doubled as often as their mean size asks for."""
        buckets = entries[0]["buckets"]
        size = planned_bytes(self._rows(entries)) or 0
        while size > 2 * buckets * self._bucket_bytes and 2 * buckets <= self._max_buckets:
            buckets *= 2
        return buckets

    def _publish(
        self,
        version: int,
        number: int,
        entries: Sequence[Row],
        kept: Sequence[Row],
        touched: set[int],
        buckets: int,
        columns: T.StructType,
        high: str,
        loads: int | None,
    ) -> None:
        mark = max([datetime.fromisoformat(high), *[e["high_mark"] for e in entries]])
        merge_of = {e["bucket"]: e["merge"] for e in kept} | dict.fromkeys(touched, number)
        rows = [(bucket, merge, buckets, columns.json(), mark, loads) for bucket, merge in merge_of.items()]
        publish(control_rows(self.spark, rows, _CURRENT), self._state, version)

    def vacuum(self, keep: int = 2) -> int:
        """Delete bucket directories that none of the last ``keep`` published states reads;
        returns how many. Readers of older states must be done."""
        newest = current_version(self.spark, self._state) or 0
        recent = [n for n in versions(self.spark, self._state) if newest - keep < n <= newest]
        if not recent:
            return 0
        states = self.spark.read.schema(_CURRENT).parquet(*[version_path(self._state, n) for n in recent])
        rows = states.select("merge", "bucket", "loads").collect()
        used = {(r["merge"], r["bucket"]) for r in rows}
        noted = {f"{r['loads']:020d}.json" for r in rows if r["loads"] is not None}
        for name in child_names(self.spark, f"{self.path}/loads"):
            if name not in noted and name[:1].isdigit() and int(name.split(".")[0]) >> _ATTEMPT_BITS <= newest:
                delete(self.spark, f"{self.path}/loads/{name}")
        gone = 0
        for merge in [int(n.split("=")[1]) for n in child_names(self.spark, self._data)]:
            base = self._merge_path(merge)
            parts = [n for n in child_names(self.spark, base) if n.startswith(BUCKET)]
            done = merge >> _ATTEMPT_BITS <= newest  # later ones may be under way
            old = [n for n in parts if done and (merge, int(n.split("=")[1])) not in used]
            for part in old if len(old) < len(parts) else [""]:
                delete(self.spark, f"{base}/{part}".rstrip("/"))
            gone += len(old)
        return gone


def _columns(entries: Sequence[Row]) -> T.StructType:
    """Columns of the table; files of older merges may lack the later ones, which read NULL."""
    return T.StructType.fromJson(json.loads(entries[0]["columns"])) if entries else T.StructType()


def _as_stored(rows: DataFrame, columns: T.StructType) -> DataFrame:
    """Rows with all the columns, of these types, and NULL in those they lack."""
    own = {f.name: f.dataType for f in rows.schema.fields}
    stored = {f.name: f.dataType for f in columns.fields}
    cast = {name: F.col(name).cast(kind) for name, kind in stored.items() if name in own and own[name] != kind}
    absent = {name: F.lit(None).cast(kind) for name, kind in stored.items() if name not in own}
    return rows.withColumns({**cast, **absent})
