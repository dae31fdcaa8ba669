"""Near-real-time forms: merge of RAW files as they land, replays removed, running newest row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timestamps import EPOCH, ntz
from tidemark.operators.dedupe import dedupe_latest
from tidemark.sources.raw import PARTITIONS, noted_schema
from tidemark.sources.staging import KEPT_STATES, StagingTable
from tidemark.sources.storage import (
    child_names,
    current_version,
    delete,
    exists,
    publish,
    read_text,
    version_path,
    write_text,
)

# Column with the micro-batch an update is from.
BATCH = "batch"
# Of a de-duplicated stream: the folders of first copies and of rows set aside, of late rows, and of notes of event times.
KIND, KEPT, SEEN, LATE, MARKS = "_kind", "kept", "seen", "late", "_marks"

_DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_disk_state(spark: SparkSession) -> None:
    """Keep stream state in RocksDB, on disk beside the executors and not on their heaps, and
    checkpoint only what a batch changed."""
    for name, value in _DISK_STATE.items():
        spark.conf.set(name, value)


def raw_stream(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_files: int | None = None
) -> DataFrame:
    """RAW files of one table as a stream, in the order they land. Without a schema it has the
    columns of all loads so far, so a run takes up the columns that have come since the last."""
    schema = schema or noted_schema(spark, path)
    if schema is None:
        raise ValueError(f"no columns are noted for {path}: give a schema")
    columns = T.StructType(schema.fields + [T.StructField(p, T.StringType()) for p in PARTITIONS])
    reader = spark.readStream.schema(columns)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).drop(*PARTITIONS)


def stream_merge(
    rows: DataFrame, staging: StagingTable, checkpoint: str, change_cols: Sequence[str] = (), keep_states: int | None = KEPT_STATES
) -> StreamingQuery:
    """Merge each micro-batch into the staging table, and delete what none of its last ``keep_states``
    states reads (None: nothing); stops when all files are in.

    The checkpoint tracks files, so no row is passed over for its stamp, and the newer row
    always wins, so a batch that runs twice changes nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        staging.merge(batch, change_cols, keep_newer=True)
        if keep_states is not None:
            staging.vacuum(keep_states)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_dedupe(
    rows: DataFrame, keys: Sequence[str], ts: str, delay: str = "10 minutes", salts: int = 64
) -> DataFrame:
    """First copy of each key; a copy may come up to ``delay`` after it, in event time.

    State is dropped once the delay has passed. Rows later than that are not in the output:
    ``run_deduped`` keeps those that were never seen. The
    copies of a hot key are first reduced to one per salt, over as many tasks; a key without
    copies costs the same for any number. ``salts=1`` leaves that pass out.
    """
    timed = rows.withColumn("_event_time", F.col(ts).cast("timestamp")).withWatermark("_event_time", delay)
    if salts > 1:
        salted = timed.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        timed = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def stream_latest(rows: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Newest row per key as running state; each update replaces the row of its key."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def run_to_files(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append the stream's rows to Parquet until all input is in."""
    (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_deduped(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    path: str,
    checkpoint: str,
    delay: str = "10 minutes",
    salts: int = 64,
) -> int:
    """Run ``stream_dedupe`` until all input is in and lose no key; returns how many rows were kept as late.

    Each micro-batch writes, in one job below its own number, the first copies and beside them the
    rows that are so old that the stream may have dropped them: those up to its watermark, which is
    the newest event time of the batches before less the delay. A batch that runs again replaces what
    it wrote. After the run those that may have been dropped are compared by key with what was kept,
    and of keys that are in neither output the newest row becomes a late one. What is compared is on
    disk until that has been published, so a crash at any point only repeats work.

    NULL keys are a key like any other, as they are to the stream. ``read_deduped`` reads both outputs.
    """
    spark = rows.sparkSession
    kept = stream_dedupe(rows, keys, ts, delay, salts).withColumn(KIND, F.lit(KEPT))
    both = kept.unionByName(rows.withColumn(KIND, F.lit(SEEN)))
    seen_ts = F.when(F.col(KIND) == SEEN, F.col(ts).cast("timestamp_ntz"))

    def write(batch: DataFrame, number: int) -> None:
        up_to = _watermark(spark, path, number, delay)
        # Rows without an event time never reach the stream's state.
        old = F.lit(True) if up_to is None else F.col(ts).isNull() | (F.col(ts).cast("timestamp_ntz") <= ntz(up_to))
        newest = Observation()
        marked = batch.observe(newest, F.max(seen_ts).cast("string").alias("newest"))
        marked.filter((F.col(KIND) == KEPT) | old).write.mode("overwrite").partitionBy(KIND).parquet(f"{path}/{BATCH}={number}")
        note = f"{path}/{MARKS}/{number:010d}"
        delete(spark, note)  # of an earlier attempt
        write_text(spark, note, newest.get["newest"] or "")

    query = both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    # Whatever an earlier run left unsettled is settled first, so it never waits for more than one run.
    late = settle_late(spark, path, keys, ts)
    query.start().awaitTermination()
    return late + settle_late(spark, path, keys, ts)


def _watermark(spark: SparkSession, path: str, number: int, delay: str) -> datetime | None:
    """Event time up to which the stream may drop rows in this batch, a second later for its
    rounding; None if it is not known for a lack of notes."""
    marks = {n: read_text(spark, f"{path}/{MARKS}/{n}") for n in child_names(spark, f"{path}/{MARKS}") if n < f"{number:010d}"}
    if len(marks) < number:
        return None
    newest = max((datetime.fromisoformat(m) for m in marks.values() if m), default=None)
    start = ntz(EPOCH)  # where a stream's watermark begins
    behind = start if newest is None else F.greatest(start, ntz(newest) - F.expr(f"interval {delay}"))
    return spark.range(1).select((behind + F.expr("interval 1 second")).alias("w")).first()["w"]


def settle_late(spark: SparkSession, path: str, keys: Sequence[str], ts: str) -> int:
    """Publish the rows of dropped keys among those that micro-batches set aside, and forget the
    rest; returns how many there are. It may be run again at any time: what a crashed attempt
    published under the same number is replaced, what others published counts as kept."""
    batches = [n for n in child_names(spark, path) if n.startswith(f"{BATCH}=")]
    pending = [n for n in batches if f"{KIND}={SEEN}" in child_names(spark, f"{path}/{n}")]
    if not pending:
        return 0
    own = f"{LATE}={max(int(n.split('=')[1]) for n in pending):010d}"
    candidates = spark.read.option("mergeSchema", "true").parquet(*[f"{path}/{n}/{KIND}={SEEN}" for n in pending])
    done = [f"{path}/{n}/{KIND}={KEPT}" for n in batches if f"{KIND}={KEPT}" in child_names(spark, f"{path}/{n}")]
    done += [f"{path}/{n}" for n in child_names(spark, path) if n.startswith(f"{LATE}=") and n != own]
    lost = candidates
    if done:
        # Read by key alone; only the side of the candidates, which are few, is wide.
        before = spark.read.schema(candidates.select(*keys).schema).parquet(*done).toDF(*[f"_kept_{k}" for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_kept_{k}")) for k in keys])
        lost = candidates.join(before, same, "left_anti")
    dedupe_latest(lost, keys, [ts]).write.mode("overwrite").parquet(f"{path}/{own}")
    for n in pending:
        delete(spark, f"{path}/{n}/{KIND}={SEEN}")
    return spark.read.schema(candidates.schema).parquet(f"{path}/{own}").count()  # from the footers


def read_deduped(spark: SparkSession, path: str) -> DataFrame | None:
    """Each key once, with ``late`` telling whether its row came too late for the stream; None before
    the first batch. Rows set aside and not yet settled are not in it."""
    names = child_names(spark, path)
    on_time = [f"{path}/{n}/{KIND}={KEPT}" for n in names if n.startswith(f"{BATCH}=")]
    on_time = [p for p in on_time if exists(spark, p)]
    late = [f"{path}/{n}" for n in names if n.startswith(f"{LATE}=")]
    parts = [
        spark.read.option("mergeSchema", "true").parquet(*places).withColumn("late", F.lit(is_late))
        for places, is_late in ((on_time, False), (late, True)) if places
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def run_updates(rows: DataFrame, path: str, checkpoint: str, keys: Sequence[str]) -> None:
    """Write the updates of each micro-batch below ``path`` until all input is in, and then put
    them into one state, so what is kept does not grow with the number of batches."""
    spark = rows.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/updates/{BATCH}={number}")

    (
        rows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    pending = child_names(spark, f"{path}/updates")
    if pending:
        publish(_last_updates(spark, path, keys), f"{path}/state", keep=2)
        for name in pending:
            delete(spark, f"{path}/updates/{name}")


def read_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """State after all updates: per key the row of its last batch."""
    return _last_updates(spark, path, keys).drop(BATCH)


def _last_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    version = current_version(spark, f"{path}/state")
    parts = [] if version is None else [spark.read.parquet(version_path(f"{path}/state", version))]
    if child_names(spark, f"{path}/updates"):
        parts.append(spark.read.parquet(f"{path}/updates"))
    return dedupe_latest(reduce(DataFrame.unionByName, parts), keys, [BATCH])
