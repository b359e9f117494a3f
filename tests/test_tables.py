"""The registered queries against DuckDB on the small tables; whole runs on real folders are in ``test_jobs``."""

import os

import pytest

from labflow.plans.table_queries import QUERIES
from labflow.plans.table_sql import SQL

SF = "/root/testdata/sf0.001"
JOBS = {
    "ingest_job",
    "ingest_log",
    "ingest_append_job",
    "lake_with_report",
    "audit_lines",
    "stream_job",
    "deletion_job",
    "deletion_log",
    "deletion_rejects",
    "deletion_files_kept",
    "export_job",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - JOBS))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = [tuple(row[names.index(c)] for c in columns) for row in result.fetchall()]
    assert got and sorted(got, key=repr) == sorted(want, key=repr)
