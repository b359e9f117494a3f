"""The queries that SQL can express, against DuckDB on the small tables."""

import os

import pytest

from labflow.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in os.listdir(SF):
        con.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{table}'")
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    want = [dict(zip(names, row)) for row in result.fetchall()]
    got = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
    assert got and sorted(got[0]) == sorted(names)
    key = sorted(names)
    assert sorted(([r[c] for c in key] for r in got), key=repr) == sorted(([r[c] for c in key] for r in want), key=repr)
