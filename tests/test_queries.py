"""Every named query against its SQL, and the contract of the entry module."""

from __future__ import annotations

import pytest
from conftest import DATA

import __spark_entry__ as entry_module
from headway.queries import QUERIES, SQL
from tools.compare import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_sql(spark, con, name):
    assert differences(spark, con, name, DATA) == []


def test_entry_runs(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "avg_bikes" in df.columns


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())
