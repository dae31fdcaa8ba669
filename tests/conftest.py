from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from check import database  # noqa: E402
from tidemark.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def db():
    return database(SF)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def get(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=str)

    return get


@pytest.fixture
def setting(spark):
    """Set session settings for one test."""
    before = {}

    def change(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
