"""Every registered query against its SQL, on the given tables and on a copy of them with hot keys."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, connect, spark_rows, sql_rows
from workload.oracle import ORACLE
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def hot_keys(tmp_path_factory):
    """A third of the events at one place and copies of one event; a third of orders and items under one key."""
    folder = str(tmp_path_factory.mktemp("hot"))
    con = duckdb.connect()
    changed = {
        "events": f"""SELECT * REPLACE (CASE WHEN event_id % 3 = 1 THEN 7 ELSE user_id END AS user_id)
            FROM '{SMALL}/events.parquet' UNION ALL
            SELECT e.* FROM '{SMALL}/events.parquet' e, range(500) WHERE event_id = 77""",
        "orders": f"""SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 3 ELSE o_custkey END AS o_custkey)
            FROM '{SMALL}/orders.parquet'""",
        "lineitem": f"""SELECT * REPLACE (CASE WHEN l_linenumber % 3 = 1 THEN 5 ELSE l_orderkey END AS l_orderkey,
            CASE WHEN l_linenumber % 3 = 1 THEN 5 ELSE l_partkey END AS l_partkey) FROM '{SMALL}/lineitem.parquet'""",
    }
    for t in TABLES:
        sql = changed.get(t, f"SELECT * FROM '{SMALL}/{t}.parquet'")
        con.execute(f"COPY ({sql}) TO '{folder}/{t}.parquet'")
    return folder


def test_every_query_has_sql():
    """The text operators can be left out and have tests of their own."""
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["place", "value"] and rows.count() == 5


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = spark_rows(entry.queries()[name](spark, SMALL))
    assert got == sql_rows(connect(SMALL), entry.oracle_sql()[name])


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_with_hot_keys(spark, hot_keys, name):
    got = spark_rows(entry.queries()[name](spark, hot_keys))
    assert got == sql_rows(connect(hot_keys), entry.oracle_sql()[name])
