"""The registered queries that have SQL, value by value."""

import duckdb
import pytest

from cirrolake.llm.queries import ORACLE, QUERIES
from compare import spark_rows, sql_rows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_substring_dedup", "op13_merkle"])
def test_query(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(con, ORACLE[name])
