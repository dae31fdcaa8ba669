"""Ingest jobs: one table, and all configured tables of a database."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cdc import maxima, stamp
from tidemark.operators.config import advance_source_watermark
from tidemark.plans.load_plan import load_plan
from tidemark.plans.pools import in_threads, use_pool
from tidemark.schemas import AUDIT, RUN_STATE
from tidemark.sources.control import append_audit, load_config
from tidemark.sources.databases import FileSource, JdbcSource
from tidemark.sources.raw import WRITE_ATTEMPTS, raw_path, write_mode, write_raw, write_with_retry
from tidemark.sources.storage import control_rows, read_current, update

# Fixed value: the layer these jobs report for.
LAYER = "RAW"


@dataclass(frozen=True)
class TableResult:
    database_name: str
    table_name: str
    status: str
    row_count: int = 0
    last_updated_on: str | None = None
    full_loaded_at: datetime | None = None
    error: str | None = None


def ingest_table(
    spark: SparkSession,
    plan: Row,
    source: FileSource | JdbcSource,
    root: str,
    load_ts: datetime,
    attempts: int = WRITE_ATTEMPTS,
) -> TableResult:
    """Extract one table as planned, stamp it and land it in RAW.

    The source is read once: row count and newest change are taken while the rows are
    written, so the watermark can only cover rows that landed.
    """
    name = (plan["database_name"], plan["table_name"])
    if plan["action"] not in ("FULL", "CDC"):
        status = "ERROR" if plan["action"] == "ERROR" else "SKIPPED"
        return TableResult(*name, status, error=plan["reason"])
    cutoff = plan["cutoff"].strftime("%Y-%m-%d %H:%M:%S") if plan["action"] == "CDC" else None
    change_cols = plan["change_cols"]
    extract = source.extract(
        spark, plan["table_name"], change_cols, cutoff, plan["split_col"], plan["splits"]
    )

    def write() -> dict:
        seen = Observation()
        newest = [m.cast("string").alias(f"newest_{i}") for i, m in enumerate(maxima(change_cols))]
        rows = stamp(extract, load_ts).observe(seen, F.count(F.lit(1)).alias("rows"), *newest)
        target = raw_path(root, source.directory, *name)
        write_raw(rows, target, load_ts, write_mode(plan["load_type"]))
        return seen.get

    seen = write_with_retry(write, attempts)
    marks = [seen[f"newest_{i}"] for i in range(len(change_cols))]
    newest = max((datetime.fromisoformat(m) for m in marks if m), default=None)
    loaded_in_full = plan["action"] == "FULL" and seen["rows"] > 0
    return TableResult(
        *name,
        "SUCCESS",
        seen["rows"],
        None if newest is None else str(newest),
        load_ts if loaded_in_full else None,
    )


def ingest_database(
    spark: SparkSession,
    database: str,
    source: FileSource | JdbcSource,
    root: str,
    control: str,
    load_ts: datetime,
    kind: str = "batch",
    workers: int = 4,
    splits: int | None = None,
) -> list[TableResult]:
    """Load every configured table of a database, ``workers`` at a time, each in a scheduler
    pool of its own: under ``spark.scheduler.mode=FAIR`` small tables don't wait for large ones.

    State and audit are written for what was done, also when a table fails; the first
    failure is raised after that. The state is advanced from whatever it is by then, so jobs of
    several databases, or two of one, may share a control folder.
    """
    state = read_current(spark, f"{control}/state", RUN_STATE)
    config = load_config(spark, f"{control}/{kind}_config", database)
    plans = load_plan(config, state, kind, splits=splits).collect()
    attempts = WRITE_ATTEMPTS if kind == "batch" else 1
    errors: list[Exception] = []

    def run(plan: Row) -> TableResult:
        use_pool(spark, plan["database_name"], plan["table_name"])
        try:
            return ingest_table(spark, plan, source, root, load_ts, attempts)
        except Exception as e:
            errors.append(e)
            return TableResult(plan["database_name"], plan["table_name"], "FAILED", error=str(e))

    results = in_threads(spark, run, plans, workers)
    update(spark, f"{control}/state", RUN_STATE, lambda newest: advance_state(spark, newest, results))
    append_audit(audit_rows(spark, results, load_ts), f"{control}/audit")
    if errors:
        raise errors[0]
    return results


def advance_state(spark: SparkSession, state: DataFrame, results: Sequence[TableResult]) -> DataFrame:
    """Run state after the loads that brought rows."""
    brought = [asdict(r) for r in results if r.row_count]
    rows = [tuple(r[c] for c in RUN_STATE.fieldNames()) for r in brought]
    updates = control_rows(spark, rows, RUN_STATE)
    # A table without change columns has a state row only for the stamp of its full load.
    return advance_source_watermark(state, updates).select(*RUN_STATE.fieldNames())


def audit_rows(spark: SparkSession, results: Sequence[TableResult], at: datetime) -> DataFrame:
    rows = [
        (r.database_name, r.table_name, LAYER, r.status, r.row_count, at, r.error) for r in results
    ]
    return control_rows(spark, rows, AUDIT)
