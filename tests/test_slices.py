"""Large loads and views go in slices, one after the other, with the same rows; none holds its whole input."""

from conftest import rows
from pyspark.sql import functions as F
from test_view_moves import _text_star

from lapidar.plans import jobs
from lapidar.plans.sales import sales_star_view
from lapidar.sources.lake import Lake
from lapidar.sources.landing import landing_path, read_landing, write_landing
from lapidar.streaming import streams

DAY = "2024-01-05 00:00:00"


def _audited(df, table="itens_pedido"):
    return df.withColumns({"_ingestion_timestamp": F.lit(DAY).cast("timestamp"), "_source_file": F.lit("f"), "_source_table": F.lit(table)})


def _items(spark, ids, price):
    raw = [(F.md5(F.col("id").cast("string")), "id_item"), (F.col("id") % 7, "id_pedido"), (F.lit("1"), "id_produto"), (F.lit("2"), "quantidade"), (F.lit(price), "preco_unitario")]
    return _audited(spark.range(*ids).select(*[c.cast("string").alias(n) for c, n in raw]))


def test_silver_compares_in_slices(spark, lake, monkeypatch):
    found, key_types = [], {"id_item": "string"}
    for most in (jobs.SLICE_ROWS, 20):
        monkeypatch.setattr(jobs, "SLICE_ROWS", most)
        here = Lake(spark, f"{lake.root}/{most}")
        batches = [_items(spark, (0, 60), "1.50"), _items(spark, (0, 60), "1.50"), _items(spark, (40, 120), "2.50"), _items(spark, (0, 60), "-1")]
        told = [jobs.merge_silver(here, b, "itens_pedido", DAY, key_types) for b in batches]
        notes = here.read("silver", jobs.CHANGED).distinct()
        found.append((told, rows(here.read("silver", "itens_pedido")), rows(notes)))
        assert not here._glob(f"{here.root}/{jobs.WORK}/*")
    assert found[0] == found[1]
    assert [r.gravadas for r in found[0][0]] == [60, 0, 80, 0] and len(found[0][1]) == 120


def test_fact_is_written_in_slices_that_show_together(spark, lake, monkeypatch):
    orders = spark.range(40).select(F.when(F.col("id") != 9, F.col("id")).alias("id_pedido"), *[(F.col("id") % n).alias(c) for n, c in ((5, "id_cliente"), (3, "id_loja"), (2, "id_vendedor"))],
                                    F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2024-01-20").cast("timestamp")).alias("data_pedido"), F.lit("Pendente").alias("status_pedido"))
    items = spark.range(130).select(F.col("id").alias("id_item"), F.when(F.col("id") % 11 != 0, F.col("id") % 43).alias("id_pedido"), (F.col("id") % 4).alias("id_produto"), F.lit(2).alias("quantidade"), F.lit("1.5").cast("decimal(10,2)").alias("preco_unitario"))
    payments = spark.range(50).select(F.col("id").alias("id_pagamento"), (F.col("id") % 30).alias("id_pedido"), (F.col("id") % 2).alias("id_metodo"), F.lit("3").cast("decimal(10,2)").alias("valor_pago"))
    versions = [F.lit("1900-01-01").cast("timestamp").alias("data_inicio_vigencia"), F.lit(None).cast("timestamp").alias("data_fim_vigencia"), F.lit(True).alias("registro_ativo")]
    dims = {n: spark.range(4).select(F.md5(F.col("id").cast("string")).alias(d.surrogate), F.col("id").alias(d.key), *versions) for n, d in jobs.DIMENSIONS.items()}
    found = []
    for most in (jobs.SLICE_ROWS, 25):
        monkeypatch.setattr(jobs, "SLICE_ROWS", most)
        here = Lake(spark, f"{lake.root}/{most}")
        jobs.publish_fact(here, orders, items, payments, dims, DAY)
        assert here.version("gold", jobs.FACT) == 1
        jobs.publish_fact(here, orders.filter("id_pedido < 5"), items, payments, dims, DAY, None, ["m202401"])
        assert here.version("gold", jobs.FACT) == 2 and here.parts("gold", jobs.FACT) == ["m202401", "m202402"]
        found.append(rows(here.read("gold", jobs.FACT)))
    assert found[0] == found[1] and found[0]
    # a load that dies between its slices leaves nothing visible
    begun = Lake(spark, f"{lake.root}/begun")
    begun.publish_parts(orders, "gold", jobs.FACT, F.lit("m"), [], more=1, last=False)
    assert not begun.exists("gold", jobs.FACT)


def test_view_of_a_large_fact_is_written_by_months(spark, lake, monkeypatch):
    fact, dims = _text_star(spark)
    fact = fact.withColumn("data_pedido", F.expr("CASE WHEN id_pedido % 5 <> 0 THEN add_months(data_pedido, id_pedido % 4) END").cast("timestamp"))
    lake.publish_parts(fact, "gold", jobs.FACT, jobs.month_label("data_pedido"), [])
    calls, to = [], Lake(spark, f"{lake.root}/view")

    def view(df):
        calls.append(df)
        return sales_star_view(df, dims)

    whole = rows(jobs.shown(lake, view, to, "vw"))
    assert len(calls) == 1 and not to.exists("gold", "vw")
    monkeypatch.setattr(jobs, "SHOWN_BYTES", 1)
    assert rows(jobs.shown(lake, view, to, "vw")) == whole and len(calls) == 6
    assert whole == rows(sales_star_view(fact, dims))


def test_stream_holds_no_batch(spark, lake, monkeypatch):
    for table in jobs.FACT_SOURCES:
        empty = _audited(spark.createDataFrame([], streams.raw_schema(table)), table)
        lake.append(_items(spark, (0, 3), "1") if table == "itens_pedido" else empty, "bronze", table)
    levels = []
    monkeypatch.setattr(streams, "merge_silver", lambda lake, df, *a: levels.append((df.count(), spark.sparkContext._jsc.getPersistentRDDs().size())))
    monkeypatch.setattr(streams, "merge_fact", lambda lake, ids, ts: levels.append((ids.count(), 0)))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    streams.stream_fact(lake, f"{lake.root}/checkpoints", {"id_item": "string"}, lambda: DAY).awaitTermination()
    assert levels == [(0, before), (3, before), (0, before), (3, 0)]


def test_landing_files_are_compressed(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted", b'), (2, None)], "id_categoria long, nome_categoria string")
    write_landing(df, str(tmp_path), "categorias")
    files = spark.read.format("binaryFile").load(landing_path(str(tmp_path), "categorias")).select("path").collect()
    assert files and all(f["path"].endswith(".gz") for f in files)
    assert rows(read_landing(spark, str(tmp_path), "categorias")) == [("1", 'a "quoted", b'), ("2", None)]
