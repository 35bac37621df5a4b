"""Every registered query against its SQL oracle."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from conftest import SF_DIR
from testbed import all_queries


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    assert sql is not None, "every query here can be said in SQL"
    assert difference(df, duck, sql) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
