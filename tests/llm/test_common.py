"""Columns that are named like those the operators add."""

from __future__ import annotations

import pytest

from lapidar.llm import exact_dedup, mixing, order_minhash
from lapidar.llm.common import FILE, ROW, located, own_columns

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, _metadata string, _llm_file string, _LLM_row int, _llm_copies int, `_llm_copy` int, `a.b` string, set_aside_0 int, text_ string"  # noqa: E501


def frame(spark):
    rows = [(i, f"text {i % 3} of some words " * 6, "en", f"s{i % 2}", 9, "m", "f", i, 5, 6, "dot", 7, "x") for i in range(12)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("read", [True, False])
@pytest.mark.parametrize("stage", [exact_dedup.deduplicated, order_minhash.deduplicated, mixing.mixture])
def test_columns_with_clashing_names_come_back(spark, tmp_path, stage, read):
    docs = frame(spark)
    if read:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    out = stage(spark, docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and {tuple(r) for r in rows} <= {tuple(r) for r in docs.collect()}
    if stage is exact_dedup.deduplicated:
        assert sorted(r["doc_id"] for r in rows) == [0, 1, 2]


def test_places_are_unique(spark):
    placed = located(frame(spark).repartition(3))
    assert placed.select(FILE, ROW).distinct().count() == 12
    assert placed.select(own_columns(placed)).columns == frame(spark).columns
