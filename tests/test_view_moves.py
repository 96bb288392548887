"""What the view and its checks no longer move or hold: unread dimensions, hash texts, whole views at once."""

from conftest import rows
from pyspark.sql import functions as F
from test_star_rows import _star

from lapidar.plans.dashboard_checks import VIEW_CATEGORIES, VIEW_LINES, qa_dashboard
from lapidar.plans.sales import VIEW_COLUMNS, sales_star_view


def _text_star(spark):
    fact, dims = _star(spark)
    hashed = fact.withColumn("id_item", F.md5(F.col("id_item").cast("string"))).withColumn("data_pedido", F.to_timestamp("data_pedido"))
    return hashed, dims


def test_asked_columns_of_the_view_are_those_of_the_whole(spark):
    fact, dims = _text_star(spark)
    view = sales_star_view(fact, dims)
    assert view.columns == list(VIEW_COLUMNS) and view.count() > fact.count()
    for columns in (VIEW_LINES, VIEW_CATEGORIES, ("nome_loja",), ("id_item", "nome_vendedor", "cidade_cliente")):
        assert rows(sales_star_view(fact, dims, *columns)) == rows(view.select(*columns))
    single = {n: d.filter("data_inicio_vigencia < '2024-01-02' AND registro_ativo OR NOT registro_ativo") for n, d in dims.items()}
    plans = [sales_star_view(fact, single, *c)._jdf.queryExecution().optimizedPlan().toString().count("Join") for c in (VIEW_LINES, VIEW_CATEGORIES)]
    assert plans == [0, 1]


def test_dashboard_checks_say_the_same_of_the_columns_they_read(spark):
    fact, dims = _text_star(spark)
    whole = qa_dashboard(fact, sales_star_view(fact, dims))
    short = qa_dashboard(fact, sales_star_view(fact, dims, *VIEW_CATEGORIES), sales_star_view(fact, dims, *VIEW_LINES))
    assert rows(short) == rows(whole)
    assert {r["verificacao"] for r in whole.filter("NOT passou").collect()} == {"1_linhas_da_view", "8_id_item_unico"}
    assert "Expand" not in short._jdf.queryExecution().optimizedPlan().toString()
    empty = qa_dashboard(fact.limit(0), sales_star_view(fact.limit(0), dims))
    assert [r[1:3] for r in rows(empty)] == [(0.0, 0.0)] * 8


def test_hash_keys_of_the_view_meet_as_bytes(spark):
    fact, dims = _text_star(spark)
    plan = sales_star_view(fact, dims)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("unhex") >= 6
    # a key that a dimension has in another type is compared as it is
    numbers = {n: d.withColumn("sk_loja", F.lit(1).cast("bigint")) if n == "dim_lojas" else d for n, d in dims.items()}
    assert sales_star_view(fact.withColumn("sk_loja", F.lit("1")), numbers).filter("nome_loja IS NULL").count() == 0
