"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import CORE, entry, oracle_sql, queries
from check import compare
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, SF, name) == ""


def test_every_query_has_sql():
    assert CORE <= set(oracle_sql()) and CORE <= set(queries())


def test_entry_is_the_flagship(spark):
    df = entry(spark)
    assert df.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]
    assert df.count() > 0
