import os

import duckdb
import pytest

import corpus_pipeline
from loglake.llm import decontaminate, near_dup, queries
from loglake.session import staged

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert sorted(tuple(map(str, (r[c] for c in columns))) for r in df.collect()) == sorted(
        tuple(str(r[names.index(c)]) for c in columns) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_runs_on_the_whole_table(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = df.count()
    assert rows == n if name.split("_")[0] in ("op4", "op6", "op7", "op9", "op10", "op13") else rows > 0


def test_pipeline_stages_on_odd_rows(spark, odd_docs):
    docs = odd_docs.withColumn("n_chars", odd_docs["doc_id"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, SF_DIR), "odd")
        assert after.columns == docs.columns and after.count() <= docs.count(), name
        docs = after
    assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in odd_docs.collect()}


def test_pipeline_stages_on_empty_tables(spark, no_docs):
    docs = no_docs.withColumn("n_chars", no_docs["doc_id"])
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), "empty")
        assert docs.count() == 0, name
    assert docs.columns == ["doc_id", "samples"]


def test_last_stage_on_odd_rows(spark, odd_docs):
    out = corpus_pipeline.STAGES[-1][1](spark, odd_docs, SF_DIR)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r.doc_id) for r in odd_docs.collect())


def test_pipeline_keeps_one_of_each_group_and_no_benchmark(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").join(out.select("doc_id"), "doc_id")
    assert 0 < out.count() == docs.count() < spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert decontaminate.contaminated(docs, items).count() == 0
    assert near_dup.near_duplicates(docs).filter("not kept").count() <= 0.01 * docs.count()
