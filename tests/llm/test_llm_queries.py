"""The registered queries over the small test tables, and the pipeline."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from lookback.llm.registry import ORACLES, QUERIES, piece_model_path
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_contract_serves_all():
    assert QUERIES.items() <= contract.queries().items()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert "pipeline" in contract.queries() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    only_spark, only_sql, got, want = compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR)
    assert got == want
    assert not only_spark and not only_sql


def test_mix_takes_any_source_in_spark_and_sql(spark, edge_docs, folder):
    rows = [(200 + i, "some words here " * (i + 1), "en", s, 1) for i, s in enumerate(["odd", "a20240101123456789", "", "b7"])]
    plain = edge_docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id IS NOT NULL").distinct()
    docs = plain.unionByName(spark.createDataFrame(rows, plain.schema))
    docs.write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    name = "op6_source_mix"
    only_spark, only_sql, got, want = compare(spark, con, QUERIES[name], ORACLES[name], folder)
    assert got == want and not only_spark and not only_sql


@pytest.mark.skipif(not os.path.exists(piece_model_path()), reason="no piece model here")
def test_pipeline_runs_its_stages_and_keeps_the_columns(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for rows in (docs, docs.limit(0)):
        left = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, left, SF_DIR)
            assert left.columns == docs.columns
        coded = corpus_pipeline.STAGES[-1][1](spark, left, SF_DIR)
        assert coded.count() == left.count()
