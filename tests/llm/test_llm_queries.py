"""The registered queries against their SQL, and the pipeline stage by stage."""

import os

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from tools.check_oracles import rows_of

import __spark_entry__ as entry
from stratalake.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, name):
    db = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    df = entry.queries()[name](spark, SF_DIR)
    result = db.execute(queries.SQL[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_registered():
    found = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in found) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, None, None), (None, "no id", "en", "x", 5), (9002, "", "en", None, 0)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.filter("doc_id < 3"))
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), "stage")
        if name != "packing":
            assert docs.columns == before.columns
            assert docs.filter("doc_id is null").count() == 1
            seen.append(docs.count())
            assert seen[-1] <= seen[-2]
    once = docs.groupBy("doc_id", "start").count().filter("count > 1 and doc_id is not null")
    assert once.count() == 0
    assert docs.select(F.sum("length")).first()[0] > 0
    empty = before.filter("doc_id = -1")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_texts_that_share_an_id(spark):
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    rows = [(1, words(30, "a"), "en"), (1, words(30, "b"), "en"), (1, words(30, "b"), "de"), (1, "", "en"), (2, words(30, "c"), "en"), (3, words(30, "c"), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted([rows[0], rows[2], rows[3], rows[4]])


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 100
