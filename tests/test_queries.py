"""Every registered query against its SQL counterpart, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from queries import QUERIES
from tools.check_oracles import rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = db.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "ano_mes"
    assert set(entry.oracle_sql()) <= set(entry.queries())


# Queries that only build a plan; the others write tables on the way.
LAZY = [n for n in QUERIES if not n.startswith(("layers_", "stream_", "incremental_", "clustered_", "partition", "ingest_", "analyzed", "append", "sql_access", "gold_by_deltas", "gold_clustered", "report_from", "compacted_", "upsert_by_bloom", "fingerprint_diff"))]


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    text = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text
