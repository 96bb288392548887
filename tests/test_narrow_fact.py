"""What the fact's loads no longer move: surrogates that are their keys' hashes, and rows that stay."""

from datetime import datetime
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from lapidar.operators.facts import odd_keys, point_in_time_join
from lapidar.operators.key_bitmaps import key_bitmaps, with_key_in
from lapidar.plans import jobs, sales
from lapidar.session import SHUFFLE_CLEANUP, apply_settings

BEGIN = datetime(1900, 1, 1)
D = [datetime(2024, 1, d) for d in range(1, 30)]


def products(spark):
    """1, 2 and 9 follow each other from the beginning on; all others have to be looked up."""
    versions = [(1, BEGIN, None), (2, BEGIN, D[3]), (2, D[3], D[5]), (2, D[5], None), (3, BEGIN, D[3]), (3, D[4], None), (4, D[2], None),
                (5, BEGIN, D[4]), (5, D[3], None), (6, BEGIN, D[3]), (8, BEGIN, None), (8, BEGIN, None), (9, BEGIN, D[3]), (9, D[3], D[3]), (9, D[3], None),
                (10, None, None), (11, datetime(1800, 1, 1), None), (12, D[5], D[3]), (12, BEGIN, D[5]), (12, D[3], None)]
    dim = spark.createDataFrame(versions, "id_produto long, data_inicio_vigencia timestamp, data_fim_vigencia timestamp")
    own = F.md5(F.col("id_produto").cast("string"))
    more = spark.createDataFrame([(7, BEGIN, None)], dim.schema).withColumn("sk_produto", F.lit("other"))
    return dim.withColumn("sk_produto", own).unionByName(more)


def test_keys_that_are_not_looked_up_give_the_point_in_time_join(spark):
    dim = products(spark)
    times = [None, datetime(1850, 1, 1), BEGIN, *D[1:8]]
    facts = spark.createDataFrame([(k, t) for k in [*range(1, 14), None] for t in times], "id_produto long, data_pedido timestamp")
    odd = odd_keys(facts, dim, "id_produto", "sk_produto")
    assert [r[0] for r in rows(odd, "id_produto")] == [10, 11, 12, 13, 3, 4, 5, 6, 7, 8]
    assert [r[0] for r in rows(odd.filter("_versions IS NULL"), "id_produto")] == [13]
    assert odd_keys(facts.filter("id_produto IN (1, 2, 9)"), dim, "id_produto", "sk_produto") is None
    found = sales._resolved(sales._met(facts.withColumn("k", F.col("id_produto")), "dim_produtos", odd), "dim_produtos")
    texts = sales.restored(found, ["sk_produto"])
    sk = F.coalesce("sk_produto", F.md5(F.col("id_produto").cast("string")))
    expected = point_in_time_join(facts, dim, "id_produto", "data_pedido", "sk_produto")
    assert rows(texts.select("k", "data_pedido", sk)) == rows(expected.select("id_produto", "data_pedido", "sk_produto"))


def test_bitmaps_are_semi_and_anti_joins(spark):
    some = [0, 1, 7, 8, 32767, 32768, 32769, -1, -32768, 2**40, None, 7]
    keys = spark.createDataFrame([(k,) for k in some], "k long")
    asked = spark.createDataFrame([(k, i) for i, k in enumerate([*some, 2, 9, 32766, 65536, -2, 2**40 + 1, -(2**40)])], "k long, i int")
    for wanted, how in ((True, "left_semi"), (False, "left_anti")):
        assert rows(with_key_in(asked, "k", key_bitmaps(keys, "k"), wanted)) == rows(asked.join(keys, "k", how))


def _sources(spark, lake, orders):
    stamp = F.lit("2024-02-01").cast("timestamp")
    parts = {
        "pedidos": spark.createDataFrame([(k, 1, 1, 1, D[m], "Concluido") for k, m in orders], "id_pedido long, id_cliente long, id_loja long, id_vendedor long, data_pedido timestamp, status_pedido string"),
        "itens_pedido": spark.createDataFrame([(10 * k + i, k, i, i, Decimal("2.50")) for k, _ in orders for i in (1, 2, 3)], "id_item long, id_pedido long, id_produto long, quantidade int, preco_unitario decimal(10,2)"),
        "pagamentos_pedido": spark.createDataFrame([(k, k, 1, Decimal("5.00"), D[0]) for k, _ in orders], "id_pagamento long, id_pedido long, id_metodo long, valor_pago decimal(10,2), data_pagamento timestamp"),
    }
    for name, df in parts.items():
        lake.publish(df.withColumn("_silver_processed_at", stamp), "silver", name)


def test_rows_that_stay_are_not_shuffled_and_many_files_become_few(spark, lake, monkeypatch):
    """The same fact by bitmaps, by lists of keys, and with the month's files gathered."""
    for name, dim in jobs.DIMENSIONS.items():
        one = spark.createDataFrame([(1, BEGIN, None)], f"{dim.key} long, data_inicio_vigencia timestamp, data_fim_vigencia timestamp")
        lake.publish(one.withColumn(dim.surrogate, F.md5(F.col(dim.key).cast("string"))), "gold", name)
    orders = [(k, k % 3) for k in range(1, 400)]
    _sources(spark, lake, orders)
    stamp = "2024-03-01 00:00:00"
    jobs.merge_fact(lake, spark.createDataFrame([], "id_pedido long"), stamp)
    expected = rows(lake.read("gold", jobs.FACT))
    assert len(expected) == 3 * len(orders)
    gathered, plain = [], type(lake).gathered
    monkeypatch.setattr(type(lake), "gathered", lambda self, df, *a: gathered.append(df) or plain(self, df, *a))
    some = spark.createDataFrame([(k,) for k in range(100, 200)], "id_pedido long")
    monkeypatch.setattr(jobs, "FEW_ORDERS", 10)
    for files, bitmap_bytes, moves in ((8, 1, 1), (8, 4096, 2), (0, 1, 2)):
        monkeypatch.setattr(jobs, "BITMAP_BYTES", bitmap_bytes)
        monkeypatch.setattr(jobs, "FILES_PER_PART", files)
        gathered.clear()
        assert jobs.merge_fact(lake, some, stamp) == 100
        assert len(gathered) == moves and rows(lake.read("gold", jobs.FACT)) == expected


def test_shuffle_files_go_with_their_job(spark):
    assert apply_settings(spark).conf.get(SHUFFLE_CLEANUP) == "true"
