from conftest import rows

from lapidar.plans.sales import FACT
from lapidar.sources.landing import landing_path
from lapidar.sources.schemas import raw_schema
from lapidar.streaming.streams import stream_bronze, stream_fact, stream_silver_upsert
from test_fact import dims

BATCHES = iter(f"2024-06-{d:02d} 00:00:00" for d in range(1, 29))


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def land(spark, root, table, data):
    """One more file in the landing folder of a table."""
    df = spark.createDataFrame(data, raw_schema(table))
    df.coalesce(1).write.mode("append").option("header", True).csv(landing_path(root, table))


def clock():
    return next(BATCHES)


def test_files_reach_bronze_once_and_silver_keeps_the_latest(spark, lake, tmp_path):
    root, marks = str(tmp_path / "landing"), str(tmp_path / "marks")

    def both():
        run(stream_bronze(lake, root, "metodos_pagamento", marks))
        run(stream_silver_upsert(lake, "metodos_pagamento", marks, clock=clock))

    land(spark, root, "metodos_pagamento", [("1", "PIX"), ("2", "Boleto")])
    both()
    both()
    assert lake.read("bronze", "metodos_pagamento").count() == 2
    stamped = rows(lake.read("silver", "metodos_pagamento"), "id_metodo", "_silver_processed_at")
    land(spark, root, "metodos_pagamento", [("2", "Cartão"), ("3", "Vale"), ("1", "PIX")])
    both()
    assert lake.read("bronze", "metodos_pagamento").count() == 5
    silver = lake.read("silver", "metodos_pagamento")
    assert rows(silver, "id_metodo", "tipo_pagamento") == [(1, "PIX"), (2, "Cartão"), (3, "Vale")]
    assert rows(silver, "id_metodo", "_silver_processed_at")[0] == stamped[0]


def test_fact_stream_replays_to_the_same_rows(spark, lake, tmp_path):
    root, marks = str(tmp_path / "landing"), str(tmp_path / "marks")
    for name, df in dims(spark).items():
        lake.publish(df, "gold", name)
    day = "2024-05-10 00:00:00"

    def all_tables(orders, items, payments, folder):
        land(spark, root, "pedidos", orders)
        land(spark, root, "itens_pedido", items)
        land(spark, root, "pagamentos_pedido", payments)
        for table in ("pedidos", "itens_pedido", "pagamentos_pedido"):
            run(stream_bronze(lake, root, table, marks))
        run(stream_fact(lake, f"{marks}/{folder}", clock=clock))

    all_tables([("1", "1", "1", "1", day, "Pendente")], [("1", "1", "1", "2", "5.00")], [("1", "1", "1", "10.00", day)], "a")
    assert rows(lake.read("gold", FACT), "id_item", "status_pedido") == [(1, "Pendente")]
    all_tables([("2", "1", "1", "1", day, "Concluído")], [("2", "1", "1", "1", "1.00")], [("2", "1", "2", "1.00", day)], "a")
    result = rows(lake.read("gold", FACT), "id_item", "id_pedido", "valor_total_pago_pedido")
    assert [r[:2] for r in result] == [(1, 1), (2, 1)] and {str(r[2]) for r in result} == {"11.00"}
    # a stream without checkpoint sees every bronze row again
    run(stream_fact(lake, f"{marks}/b", clock=clock))
    assert rows(lake.read("gold", FACT), "id_item", "id_pedido", "valor_total_pago_pedido") == result
