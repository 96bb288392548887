from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lapidar.operators.dedup import latest_per_key, newest_first
from lapidar.operators.merge import changed_rows, upsert
from lapidar.operators.rules import Rule, apply_table_rule, quality_discard_report, table_rules
from lapidar.operators.typing import cast_loss_report, typed_cast
from lapidar.plans.jobs import load_silver, merge_silver
from lapidar.plans.silver import silver_build
from lapidar.sources.schemas import (
    COLUMNS,
    GOLD_INPUTS,
    PROCESSING_ORDER,
    primary_key,
    raw_schema,
    table_schema,
)

RAW = "id_metodo string, tipo_pagamento string, _ingestion_timestamp string, _source_file string"


def bronze(spark, data):
    df = spark.createDataFrame(data, RAW).withColumn("_source_table", F.lit("metodos_pagamento"))
    return df.withColumn("_ingestion_timestamp", F.col("_ingestion_timestamp").cast("timestamp"))


def test_schemas_cover_ten_tables(spark):  # types are parsed by a session
    assert set(PROCESSING_ORDER) == set(COLUMNS) and len(COLUMNS) == 10
    assert len(GOLD_INPUTS) == 9 and "enderecos" not in GOLD_INPUTS
    assert primary_key("itens_pedido") == "id_item"
    assert {f.dataType.simpleString() for f in raw_schema("pedidos")} == {"string"}
    assert table_schema("itens_pedido", {"id_item": "bigint"})["id_item"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError, match="unknown table"):
        table_schema("estoque")


def test_latest_row_wins_and_ties_are_decided(spark):
    data = [
        ("1", "velho", "2024-01-01", "a"),
        ("1", "novo", "2024-01-02", "a"),
        ("2", "x", "2024-01-01", "a"),
        ("2", "y", "2024-01-01", "b"),
        ("3", "p", "2024-01-01", "a"),
        ("3", "q", "2024-01-01", "a"),
    ]
    for order in (data, data[::-1]):
        df = bronze(spark, order)
        latest = latest_per_key(df, "id_metodo", newest_first(df, "_ingestion_timestamp", "_source_file"))
        assert rows(latest, "id_metodo", "tipo_pagamento") == [("1", "novo"), ("2", "y"), ("3", "q")]


def test_spellings_of_one_key_are_one_key(spark):
    df = bronze(
        spark,
        [
            ("1", "a", "2024-01-01", "f"),
            ("1.0", "b", "2024-01-02", "f"),
            (" 1", "c", "2024-01-03", "f"),
            ("x", "d", "2024-01-01", "f"),
            (None, "e", "2024-01-01", "f"),
        ],
    )
    built = silver_build(df, "metodos_pagamento", "2024-02-01")
    assert rows(built, "id_metodo", "tipo_pagamento", "_silver_processed_at") == [
        (1, "c", datetime(2024, 2, 1))
    ]


def test_cast_loss_counts_only_lost_values(spark):
    raw = spark.createDataFrame(
        [("1.0", "12.345"), ("abc", ""), (" ", "x"), (None, "123456789.12"), ("12345678901", None)],
        "id_produto string, preco_base string",
    )
    schema = table_schema("produtos")
    wanted = type(schema)([schema["id_produto"], schema["preco_base"]])
    assert rows(cast_loss_report(raw, wanted)) == [
        ("id_produto", "bigint", 1),
        ("preco_base", "decimal(10,2)", 2),
    ]
    assert typed_cast(raw, wanted).columns == ["id_produto", "preco_base"]


def test_rules(spark):
    orders = spark.createDataFrame(
        [(1, "Concluído"), (2, "Pendente"), (3, "Cancelado"), (4, "Devolvido"), (5, None)],
        "id_pedido int, status_pedido string",
    )
    assert rows(apply_table_rule(orders, "pedidos"), "id_pedido") == [(1,), (2,), (3,)]
    items = spark.createDataFrame(
        [(1, 1, 1.0), (2, 0, 1.0), (3, 1, -1.0), (4, None, 1.0)],
        "id_item int, quantidade int, preco_unitario double",
    )
    assert rows(apply_table_rule(items, "itens_pedido"), "id_item") == [(1,)]
    shops = spark.createDataFrame([(1, " sp ")], "id_loja int, estado_loja string")
    assert rows(apply_table_rule(shops, "lojas"), "estado_loja") == [("SP",)]
    plain = spark.createDataFrame([(1, None)], "id_categoria int, nome_categoria string")
    assert apply_table_rule(plain, "categorias").count() == 1
    assert set(table_rules()) == {
        "clientes", "pedidos", "itens_pedido", "pagamentos_pedido", "lojas", "enderecos",
    }
    assert isinstance(table_rules()["lojas"], Rule)


def test_discard_report_counts_every_row_once(spark):
    df = spark.createDataFrame(
        [(1, "Concluído"), (None, "Concluído"), (2, None), (3, "Devolvido")],
        "id_pedido int, status_pedido string",
    )
    report = quality_discard_report(df, "pedidos", "id_pedido").first().asDict()
    assert report == {
        "tabela": "pedidos", "lidas": 4, "sem_chave": 1, "contra_regra": 2, "validas": 1, "descartadas": 3,
    }


def test_upsert_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([("B", 2), ("c", 3)], "v string, k int")
    assert rows(upsert(target, source, "k")) == [(1, "a"), (2, "B"), (3, "c")]


def test_changed_rows_is_null_safe_and_respects_age(spark):
    target = spark.createDataFrame(
        [(1, None, 1), (2, "b", 1), (3, "c", 1), (4, None, 1), (5, "e", 5)], "k int, v string, age int"
    )
    source = spark.createDataFrame(
        [(1, "a", 2), (2, None, 2), (3, "c", 2), (4, None, 2), (5, "old", 4), (6, "new", 1)],
        "k int, v string, age int",
    )
    assert rows(changed_rows(target, source, "k", ["v"], ["age"]), "k") == [(1,), (2,), (6,)]


def test_silver_load_twice_changes_nothing(spark, lake):
    lake.append(bronze(spark, [("1", "a", "2024-01-01", "f"), ("2", "b", "2024-01-01", "f")]), "bronze", "metodos_pagamento")
    assert load_silver(lake, "metodos_pagamento", "2024-02-01").gravadas == 2
    assert load_silver(lake, "metodos_pagamento", "2024-02-02").gravadas == 0
    # the same content again, with a later ingestion time
    lake.append(bronze(spark, [("1", "a", "2024-01-02", "g"), ("2", "B", "2024-01-02", "g")]), "bronze", "metodos_pagamento")
    assert load_silver(lake, "metodos_pagamento", "2024-02-03").gravadas == 1
    assert rows(lake.read("silver", "metodos_pagamento"), "id_metodo", "tipo_pagamento", "_silver_processed_at") == [
        (1, "a", datetime(2024, 2, 1)),
        (2, "B", datetime(2024, 2, 3)),
    ]


ORDER = "id_pedido string, id_cliente string, id_loja string, id_vendedor string, data_pedido string, status_pedido string"


def orders_batch(spark, data, when):
    df = spark.createDataFrame([(k, "1", "1", "1", "2024-01-01", s) for k, s in data], ORDER)
    return df.select(
        "*",
        F.lit(when).cast("timestamp").alias("_ingestion_timestamp"),
        F.lit("f").alias("_source_file"),
        F.lit("pedidos").alias("_source_table"),
    )


def test_bad_newest_version_keeps_the_earlier_silver_row(spark, lake):
    merge_silver(lake, orders_batch(spark, [("1", "Pendente")], "2024-01-01"), "pedidos", "2024-02-01")
    merge_silver(lake, orders_batch(spark, [("1", "Perdido")], "2024-01-02"), "pedidos", "2024-02-02")
    assert rows(lake.read("silver", "pedidos"), "id_pedido", "status_pedido") == [(1, "Pendente")]


def test_only_touched_key_ranges_are_rewritten_and_old_batches_do_not_win(spark, lake):
    far = "50000000"
    merge_silver(lake, orders_batch(spark, [("1", "Pendente"), (far, "Pendente")], "2024-01-02"), "pedidos", "2024-02-01")
    assert lake.parts("silver", "pedidos") == ["k0", "k2"]
    before = set(lake.read("silver", "pedidos", ["k2"]).inputFiles())
    assert merge_silver(lake, orders_batch(spark, [("1", "Concluído"), ("2", "Pendente")], "2024-01-03"), "pedidos", "2024-02-02").gravadas == 2
    assert set(lake.read("silver", "pedidos", ["k2"]).inputFiles()) == before
    # a replayed older batch
    assert merge_silver(lake, orders_batch(spark, [("1", "Cancelado")], "2024-01-01"), "pedidos", "2024-02-03").gravadas == 0
    assert rows(lake.read("silver", "pedidos"), "id_pedido", "status_pedido") == [
        (1, "Concluído"), (2, "Pendente"), (int(far), "Pendente"),
    ]


def test_new_key_range_is_added(spark, lake):
    merge_silver(lake, orders_batch(spark, [("1", "Pendente")], "2024-01-01"), "pedidos", "2024-02-01")
    assert merge_silver(lake, orders_batch(spark, [("90000000", "Pendente")], "2024-01-02"), "pedidos", "2024-02-02").gravadas == 1
    assert lake.read("silver", "pedidos").count() == 2
