"""Every registered query against its SQL, and the contract of the entry file."""

import pytest

import __spark_entry__ as entry_file
from oracle import compare, connect

QUERIES = entry_file.queries()
SQL = entry_file.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_names():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry_file.entry(spark)
    assert df.columns == ["match_id", "player", "slot", "n", "forme", "win_mean"]
    assert df.count() > 0


# name resolution scores its last names in Arrow batches; everything else stays in the JVM
USES_PYTHON = {"join_3"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert compare(df, con, SQL[name]) is None
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in USES_PYTHON:
        assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
