"""The view's rows without joins of dimensions that nobody reads."""

from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from lapidar.plans import jobs
from lapidar.plans.dashboard_checks import view_fact_revenue
from lapidar.plans.sales import sales_star_view, star_rows

T = [datetime(2024, 1, d) for d in range(1, 5)]


def _star(spark):
    active = "data_inicio_vigencia timestamp, data_fim_vigencia timestamp, registro_ativo boolean"
    dims = {}
    for name, dim in jobs.DIMENSIONS.items():
        versions = [("a", T[0], None, True), ("b", T[0], T[1], False), ("b", T[1], None, True), (None, T[0], None, True)]
        if name in ("dim_clientes", "dim_produtos"):
            versions += [("a", T[1], None, True), (None, T[1], None, True)]
        df = spark.createDataFrame(versions, f"{dim.surrogate} string, {active}")
        dims[name] = df.withColumns({c: F.lit("1") for c in dim.tracked})
    found = [(i, i, None if i % 7 == 0 else "abz"[i % 3], "abz"[i % 2], "Concluido" if i % 4 else "Pendente") for i in range(30)]
    fact = spark.createDataFrame(found, "id_item int, id_pedido int, sk_cliente string, sk_produto string, status_pedido string")
    more = {"sk_loja": "a", "sk_vendedor": "b", "sk_metodo": "a", "valor_total_item": "2.50", "valor_total_pago_pedido": "1", "data_pedido": "2024-01-01", "quantidade": "1", "preco_unitario": "1"}
    return fact.withColumns({c: F.lit(v) for c, v in more.items()}).withColumn("valor_total_item", F.col("valor_total_item").cast("decimal(10,2)")), dims


def test_star_rows_come_as_often_as_in_the_view(spark):
    fact, dims = _star(spark)
    wanted = ("id_item", "status_pedido")
    short, view = star_rows(fact, dims, *wanted), sales_star_view(fact, dims)
    assert rows(short) == rows(view, *wanted) and short.count() > fact.count()
    text = fact.withColumn("id_item", F.md5(F.col("id_item").cast("string")))
    revenue = [rows(view_fact_revenue(text, v)) for v in (star_rows(text, dims, *wanted), sales_star_view(text, dims))]
    assert revenue[0] == revenue[1] != [(None,)]
    single = {n: d.filter("data_inicio_vigencia < '2024-01-02' AND registro_ativo OR NOT registro_ativo") for n, d in dims.items()}
    assert "Join" not in star_rows(fact, single, *wanted)._jdf.queryExecution().optimizedPlan().toString()
