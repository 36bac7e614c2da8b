import importlib

import duckdb
import pytest

import corpus_pipeline
import __spark_entry__ as entry
from rosterflow.llm import queries
from rosterflow.llm.common import staged
from tests.conftest import SF
from tests.llm.helpers import documents
from tests.oracle_compare import rows_of_duck, rows_of_spark


def test_names():
    names = [k for k in queries.QUERIES if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 11))
    assert set(queries.QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_stages_filter_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, SF), f"test-{name}")
        assert out.columns == docs.columns
        left = {r.doc_id for r in out.select("doc_id").collect()}
        assert left < ids or name == "language" and left <= ids
        assert len(left) == out.count() and len(left) > 0.8 * len(ids)
        docs, ids = out, left
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in last} == ids
    again = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, last))


def test_stages_take_clashing_columns(spark):
    docs = documents(spark).withColumnRenamed("kept", "language").withColumnRenamed("score", "quality_score").withColumnRenamed("row", "Leak")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        stage(spark, docs, SF).collect()
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_import_errors_are_not_swallowed():
    assert importlib.import_module("corpus_pipeline") is corpus_pipeline


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    assert rows_of_spark(queries.QUERIES[key](spark, SF)) == rows_of_duck(con, queries.ORACLE_SQL[key])
