"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql
from check_oracle import compare, connect
from lapidar.registry.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, SF, oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry(spark).columns == ["nome_categoria", "receita"] and entry(spark).count() == 7
