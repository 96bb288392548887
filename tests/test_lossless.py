"""Loads lose and double nothing: moved rows, equal or late batch times, wide keys, line breaks, hot keys."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_fact import DAY, dims

from lapidar.operators.checks import fact_quality
from lapidar.operators.skew import hot_keys, salted_join
from lapidar.plans import jobs
from lapidar.plans.jobs import load_bronze, load_dimension, load_fact, load_silver, merge_silver, near_keys
from lapidar.plans.sales import FACT
from lapidar.sources.landing import write_landing
from lapidar.sources.schemas import raw_schema, table_schema
from lapidar.streaming.streams import stream_bronze

METHOD = "metodos_pagamento"


def raw(spark, table, data, when):
    df = spark.createDataFrame([tuple(map(str, r)) for r in data], raw_schema(table))
    return df.select(
        "*", F.lit(when).cast("timestamp").alias("_ingestion_timestamp"), F.lit("f").alias("_source_file"), F.lit(table).alias("_source_table")
    )


def orders_items_payments(spark, lake, when, orders=(), items=(), payments=()):
    for table, data in zip(jobs.FACT_SOURCES, (orders, items, payments), strict=True):
        if data:
            merge_silver(lake, raw(spark, table, data, when), table, when)


def test_moved_items_and_payments_rebuild_the_orders_they_left(spark, lake):
    for name, df in dims(spark).items():
        lake.publish(df, "gold", name)
    order = lambda k: (k, 1, 1, 1, DAY, "Concluído")
    orders_items_payments(
        spark, lake, "2024-06-01 00:00:00", [order(1), order(2)],
        [(10, 1, 1, 1, "5.00"), (11, 1, 1, 1, "7.00"), (12, 2, 1, 1, "9.00")], [(1, 1, 1, "12.00", DAY), (2, 2, 1, "9.00", DAY)],
    )
    load_fact(lake, "2024-06-01 00:00:00")
    orders_items_payments(
        spark, lake, "2024-06-02 00:00:00", (), [(11, 2, 1, 1, "7.00")], [(1, 2, 1, "12.00", DAY)]
    )
    assert load_fact(lake, "2024-06-02 00:00:00") == 2
    fact = rows(lake.read("gold", FACT), "id_item", "id_pedido", "valor_total_pago_pedido")
    assert fact == [(10, 1, None), (11, 2, Decimal("21.00")), (12, 2, Decimal("21.00"))]
    assert load_fact(lake, "2024-06-03 00:00:00") == 0


def test_every_dimension_load_keeps_the_versions_it_closed(spark, lake):
    for when, name in (("2024-01-01", "a"), ("2024-02-01", "b"), ("2024-03-01", "c")):
        merge_silver(lake, raw(spark, METHOD, [(1, name)], when), METHOD, when)
        load_dimension(lake, "dim_metodos_pagamento", when)
    versions = rows(lake.read("gold", "dim_metodos_pagamento"), "tipo_pagamento", "registro_ativo")
    assert versions == [("a", False), ("b", False), ("c", True)]
    merge_silver(lake, raw(spark, METHOD, [(1, "d")], "2024-04-01"), METHOD, "2024-04-01")
    for when in ("2024-03-01", "2024-02-15"):
        with pytest.raises(ValueError, match="not later"):
            load_dimension(lake, "dim_metodos_pagamento", when)
    assert rows(lake.read("gold", "dim_metodos_pagamento"), "tipo_pagamento", "registro_ativo") == versions


def land(spark, root, data):
    write_landing(spark.createDataFrame(data, raw_schema(METHOD)), root, METHOD)


def test_bronze_batches_of_jobs_and_streams_stand_side_by_side(spark, lake, tmp_path):
    root, other, marks = (str(tmp_path / n) for n in ("landing", "other", "marks"))
    land(spark, root, [("1", "PIX")])
    land(spark, other, [("2", "Boleto")])
    assert load_bronze(lake, root, METHOD, "2024-01-01").linhas == 1
    for _ in range(2):
        stream_bronze(lake, other, METHOD, marks).awaitTermination()
    land(spark, root, [("3", "Vale"), ("4", "Troca")])
    assert load_bronze(lake, root, METHOD, "2024-01-02").linhas == 2
    assert [r[0] for r in rows(lake.read("bronze", METHOD), "id_metodo")] == ["1", "2", "3", "4"]


def test_bronze_batch_is_replaced_until_silver_has_it(spark, lake, tmp_path):
    root = str(tmp_path / "landing")
    land(spark, root, [("1", "PIX")])
    for _ in range(2):
        assert load_bronze(lake, root, METHOD, "2024-01-02").linhas == 1
    assert lake.read("bronze", METHOD).count() == 1
    assert load_silver(lake, METHOD, "2024-01-02").gravadas == 1
    assert load_bronze(lake, root, METHOD, "2024-01-02") is None
    assert lake.read("bronze", METHOD).count() == 1


def test_keys_above_31_bits_stay(spark, lake):
    wide = 2**31 + 1
    merge_silver(lake, raw(spark, "pedidos", [(wide, wide, 1, 1, DAY, "Pendente")], "2024-01-01"), "pedidos", "2024-01-01")
    assert rows(lake.read("silver", "pedidos"), "id_pedido", "id_cliente") == [(wide, wide)]
    assert table_schema("itens_pedido")["id_item"].dataType.simpleString() == "bigint"


def test_line_breaks_fail_the_landing_write(spark, tmp_path):
    for text in ("a\nb", "a\rb"):
        with pytest.raises(Exception, match="line break"):
            land(spark, str(tmp_path / "landing"), [("1", text)])


def test_null_totals_are_reported(spark):
    fact = spark.createDataFrame(
        [(1, None, "c", "p"), (2, Decimal("1.00"), "c", "p")], "id_item int, valor_total_item decimal(10,2), sk_cliente string, sk_produto string"
    )
    assert rows(fact_quality(fact).filter("verificacao = 'valor_total_item_positivo'"), "medida", "passou") == [(1, False)]


def test_near_keys_name_at_most_so_many_ranges_and_hold_for_every_key(spark, monkeypatch):
    monkeypatch.setattr(jobs, "NEAR_RANGES", 5)
    keys = spark.range(0, 40).select((F.col("id") * F.col("id") * 3_000_000).alias("k"))
    near = near_keys(keys, "k")
    assert str(near).count(">=") == 5
    assert keys.filter(near).count() == 40
    assert spark.range(1).select((F.col("id") + 10**12).alias("k")).filter(near).count() == 0


def test_a_key_below_a_thousandth_of_the_rows_is_spread(spark):
    facts = spark.range(0, 60_000).select(F.when(F.col("id") < 40, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("i"))
    hot = hot_keys(facts, "k", rows=10)
    assert hot == {7: 4}
    right = spark.createDataFrame([(7, "seven"), (50, "fifty")], "k long, v string")
    joined = salted_join(facts, right, "k", "i", hot)
    assert joined.count() == 41 and joined.filter("k = 7").select("i").distinct().count() == 40


def test_errors_are_reported_in_full(spark):
    def fail(_):
        raise RuntimeError("x" * 5000)

    assert len(jobs.run_tables(spark, "s", ["t"], fail).first()["detalhe"]) > 5000
