"""Every registered query against its SQL twin on the smallest tables, and its plan."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    got = rows_of(df.columns, df.collect())
    if name in SQL:
        cur = con.execute(SQL[name])
        columns = [d[0] for d in cur.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, cur.fetchall())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_all_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
