"""The registered queries on the small tables, the pipeline's stages, and what may not depend on this subpackage."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from check_oracle import connect, rows_of
from lapidar.llm.oracle import ORACLE
from lapidar.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    connection = connect(SF)
    assert rows_of(QUERIES[name](spark, SF).toArrow()) == rows_of(connection.sql(ORACLE[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_a_row_for_each_document_or_page(spark, name):
    of, key = {"op1": ("pages", "page_id"), "op12": ("embeddings", "vec_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    rows = QUERIES[name](spark, SF)
    there = duckdb.sql(f"SELECT count(DISTINCT {key}) FROM '{SF}/{of}.parquet'").fetchall()[0][0]
    assert rows.select(key).distinct().count() == there


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, SF), "stage")
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= ids and now, name
        ids = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids


def test_nothing_else_imports_the_subpackage():
    root = Path(corpus_pipeline.__file__).parent
    for path in (root / "lapidar").rglob("*.py"):
        if "llm" not in path.parts:
            assert "lapidar.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
