"""Every registered query with SQL gives what the SQL gives; the others run."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, data, con, name):
    assert compare(entry.queries()[name](spark, data), SQL[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs(spark, data, name):
    assert entry.queries()[name](spark, data).limit(1).count() == 1


def test_entry(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and found.columns[:2] == ["id", "label"] and "wide" in found.columns
