"""Several tables at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def use_pool(spark: SparkSession, *name: str | None) -> None:
    """Run the jobs of this thread in the scheduler pool of a table."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", ".".join(n or "" for n in name))


def in_threads(spark: SparkSession, run: Callable[[Any], Any], items: Iterable[Any], workers: int) -> list[Any]:
    """Results in order; the threads keep the local properties of the caller."""
    with ThreadPoolExecutor(workers) as threads:
        return list(threads.map(inheritable_thread_target(spark)(run), items))
