"""Session helpers: a local session for tests and benches, and scratch locations."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; clusters bring their own session. Its shared folder
    goes with the process."""
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", folder)
        .config("spark.scheduler.mode", "FAIR")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a session whose executors are this process may do without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return tempfile.gettempdir()


def work_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared root that no other run uses."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"
