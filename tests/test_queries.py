"""Every registered query against its SQL in DuckDB, and its plan."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert len(df.columns) == len(set(df.columns))
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 15
