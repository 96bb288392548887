"""Hand-over between layers: batches out of order or stamped alike, losses in reports, quarantine, late keys."""

import json
from pathlib import Path

import pytest
from conftest import rows
from test_fact import DAY, dims
from test_lossless import METHOD, land, raw

from lapidar.operators.control import taken_batches
from lapidar.plans import jobs
from lapidar.plans.jobs import PENDING, load_bronze, load_dimension, load_fact, load_silver, merge_silver, quarantine_of, run_layer
from lapidar.plans.sales import FACT
from lapidar.sources.landing import landing_path
from lapidar.sources.schemas import KEY_BUCKETS
from lapidar.streaming.streams import stream_bronze, stream_silver_upsert


def order(key, client=1, day=DAY, status="Concluído"):
    return (key, client, 1, 1, day, status)


def bronze(spark, lake, table, data, when, label):
    lake.append(raw(spark, table, data, when), "bronze", table, label)


def publish_dims(spark, lake):
    for name, df in dims(spark).items():
        lake.publish(df, "gold", name)


def test_batches_committed_out_of_order_all_reach_silver(spark, lake, tmp_path):
    root, other, marks = (str(tmp_path / n) for n in ("landing", "other", "marks"))
    land(spark, root, [("1", "PIX")])
    land(spark, other, [("2", "Boleto")])
    assert load_bronze(lake, root, METHOD, "2030-01-01").linhas == 1
    assert load_silver(lake, METHOD, "2030-01-01").gravadas == 1
    stream_bronze(lake, other, METHOD, marks).awaitTermination()  # stamped now, before 2030
    land(spark, root, [("3", "Vale")])
    assert load_bronze(lake, root, METHOD, "2024-01-01").linhas == 1
    report = load_silver(lake, METHOD, "2030-01-02")
    assert (report.recebidas, report.gravadas) == (2, 2)
    assert rows(lake.read("silver", METHOD), "id_metodo", "tipo_pagamento") == [(1, "PIX"), (2, "Boleto"), (3, "Vale")]
    assert load_silver(lake, METHOD, "2030-01-03").recebidas == 0
    assert taken_batches(lake, f"silver_{METHOD}") == set(lake.batches("bronze", METHOD))


def test_a_late_batch_with_older_rows_changes_no_newer_ones(spark, lake):
    bronze(spark, lake, METHOD, [(1, "new")], "2024-02-01", "b2")
    load_silver(lake, METHOD, "2024-02-01")
    bronze(spark, lake, METHOD, [(1, "old"), (2, "late")], "2024-01-01", "b1")
    assert load_silver(lake, METHOD, "2024-02-02").gravadas == 1
    assert rows(lake.read("silver", METHOD), "id_metodo", "tipo_pagamento") == [(1, "new"), (2, "late")]


def _items(keys, price="5.00"):
    return [(f"i{k}", 1, 1, 1, price) for k in keys]


def test_a_batch_of_few_text_keys_rewrites_their_buckets_only(spark, lake):
    kinds, table = {"id_item": "string"}, "itens_pedido"
    bronze(spark, lake, table, _items(range(600)), "2024-01-01", "b1")
    assert load_silver(lake, table, "2024-01-01", kinds).gravadas == 600
    before = set(lake.read("silver", table).inputFiles())
    bronze(spark, lake, table, _items([3, 4], "6.00") + _items([5, 900]), "2024-01-02", "b2")
    assert load_silver(lake, table, "2024-01-02", kinds).gravadas == 3  # item 5 is as it was
    silver = lake.read("silver", table)
    assert len(before - set(silver.inputFiles())) <= 4 * len(before) / KEY_BUCKETS + 1
    assert silver.count() == silver.select("id_item").distinct().count() == 601
    assert rows(silver.filter("preco_unitario = 6"), "id_item") == [("i3",), ("i4",)]


def test_a_table_in_another_layout_is_split_by_the_next_change(spark, lake):
    kinds, table = {"id_item": "string"}, "itens_pedido"
    bronze(spark, lake, table, _items(range(20)), "2024-01-01", "b1")
    load_silver(lake, table, "2024-01-01", kinds)
    lake.publish(lake.read("silver", table), "silver", table)
    assert lake.parts("silver", table) == [""]
    bronze(spark, lake, table, _items([0], "7.00") + _items([30]), "2024-01-02", "b2")
    assert load_silver(lake, table, "2024-01-02", kinds).gravadas == 2
    silver = lake.read("silver", table)
    assert silver.count() == silver.select("id_item").distinct().count() == 21
    assert rows(silver.filter("preco_unitario = 7"), "id_item") == [("i0",)]
    assert all(label.startswith(f"h{KEY_BUCKETS}_") for label in lake.parts("silver", table))


def test_silver_loads_of_the_same_time_reach_the_fact(spark, lake):
    publish_dims(spark, lake)
    same = "2024-07-01 00:00:00"
    for key in (1, 2):
        bronze(spark, lake, "pedidos", [order(key)], f"2024-06-0{key}", f"b{key}")
        bronze(spark, lake, "itens_pedido", [(10 + key, key, 1, 1, "5.00")], f"2024-06-0{key}", f"b{key}")
        bronze(spark, lake, "pagamentos_pedido", [(key, key, 1, "5.00", DAY)], f"2024-06-0{key}", f"b{key}")
        for table in jobs.FACT_SOURCES:
            assert load_silver(lake, table, same).gravadas == 1
        assert load_fact(lake, same) == 1
    assert [r[0] for r in rows(lake.read("gold", FACT), "id_pedido")] == [1, 2]
    # one stamped before the fact's mark
    bronze(spark, lake, "itens_pedido", [(13, 1, 1, 2, "6.00")], "2024-06-03", "b3")
    load_silver(lake, "itens_pedido", "2024-01-01 00:00:00")
    assert load_fact(lake, same) == 1 and lake.read("gold", FACT).count() == 3
    assert load_fact(lake, same) == 0


def test_notes_of_a_silver_write_that_died_wait_for_the_next(spark, lake, monkeypatch):
    publish_dims(spark, lake)
    when = "2024-07-01 00:00:00"
    for table, data in zip(jobs.FACT_SOURCES, ([order(1)], [(11, 1, 1, 1, "5.00")], [(1, 1, 1, "5.00", DAY)]), strict=True):
        bronze(spark, lake, table, data, "2024-06-01", "b1")
        load_silver(lake, table, when)
    load_fact(lake, when)
    bronze(spark, lake, "itens_pedido", [(12, 1, 1, 1, "7.00")], "2024-06-02", "b2")

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(type(lake), "publish_parts", crash)
        with pytest.raises(RuntimeError):
            load_silver(lake, "itens_pedido", when)
    assert load_fact(lake, when) == 0  # the noted order has nothing new yet
    load_silver(lake, "itens_pedido", when)
    assert load_fact(lake, when) == 1 and lake.read("gold", FACT).count() == 2


def test_silver_reports_what_it_lost(spark, lake):
    data = [
        (1, 1, 1, 1, DAY, "Concluído"), ("x2", 1, 1, 1, DAY, "Concluído"), (3, "abc", 1, 1, "02/01/2024", "Pendente"),
        (4, 1, 1, 1, DAY, "Perdido"), (5, " ", 1, 1, DAY, "Pendente"), (5, " ", 1, 1, DAY, "Pendente"),
    ]
    bronze(spark, lake, "pedidos", data, "2024-01-01", "b1")
    detail = {r["tabela"]: r["detalhe"] for r in run_layer(lake, "silver", "2024-01-02", tables=["pedidos"]).collect()}
    first = {"recebidas": 6, "lidas": 5, "sem_chave": 1, "contra_regra": 1, "validas": 3, "gravadas": 3, "perdidos": {"id_pedido": 1, "id_cliente": 1, "data_pedido": 1}}
    assert json.loads(detail["pedidos"]) == first
    bronze(spark, lake, "pedidos", [(1, 1, 1, 1, DAY, "Concluído"), (6, 1, "y", 1, DAY, "Pendente"), (7, 1, 1, 1, DAY, "?")], "2024-01-03", "b2")
    report = load_silver(lake, "pedidos", "2024-01-04")
    assert (report.recebidas, report.lidas, report.contra_regra, report.validas, report.gravadas, report.perdidos) == (3, 3, 1, 2, 1, {"id_loja": 1})
    # nothing valid
    bronze(spark, lake, "pedidos", [("z", 1, 1, 1, DAY, "?")], "2024-01-05", "b3")
    report = load_silver(lake, "pedidos", "2024-01-06")
    assert (report.lidas, report.sem_chave, report.validas, report.gravadas) == (1, 1, 0, 0)


def test_the_stream_reports_lost_values_in_its_progress(spark, lake, tmp_path):
    bronze(spark, lake, "pedidos", [(1, 1, 1, 1, DAY, "Pendente"), (2, "abc", 1, 1, "never", "Pendente")], "2024-01-01", "b1")
    query = stream_silver_upsert(lake, "pedidos", str(tmp_path / "marks"))
    query.awaitTermination()
    seen = [p["observedMetrics"]["silver_pedidos"] for p in query.recentProgress if p["numInputRows"]]
    assert [(s["recebidas"], s["id_cliente"], s["data_pedido"], s["id_loja"]) for s in seen] == [(2, 1, 1, 0)]


def landed(tmp_path, text, name="part-0.csv"):
    folder = Path(landing_path(str(tmp_path / "landing"), METHOD))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(tmp_path / "landing")


def test_malformed_rows_go_to_quarantine(spark, lake, tmp_path):
    root = landed(tmp_path, 'id_metodo,tipo_pagamento\n1,PIX\n2,Boleto,extra,cols\n3\n4,"a,b"\n5,\n')
    for _ in range(2):
        report = load_bronze(lake, root, METHOD, "2024-01-01")
        assert (report.linhas, report.em_quarentena) == (3, 2)
    assert rows(lake.read("bronze", METHOD), "id_metodo", "tipo_pagamento") == [("1", "PIX"), ("4", "a,b"), ("5", None)]
    bad = lake.read("bronze", quarantine_of(METHOD))
    assert rows(bad, "_linha_invalida", "_source_table") == [("2,Boleto,extra,cols", METHOD), ("3", METHOD)]
    assert all(r["_source_file"].endswith("part-0.csv") for r in bad.collect())
    detail = run_layer(lake, "bronze", "2024-01-02", root, tables=[METHOD]).first()["detalhe"]
    assert json.loads(detail) == {"linhas": 3, "em_quarentena": 2}
    # once mended and run again, the batch has no quarantine
    landed(tmp_path, "id_metodo,tipo_pagamento\n1,PIX\n")
    assert load_bronze(lake, root, METHOD, "2024-01-02").em_quarentena == 0
    assert lake.read("bronze", quarantine_of(METHOD)).count() == 2


def test_quarantine_is_made_whole_after_a_crash(spark, lake, tmp_path, monkeypatch):
    root = landed(tmp_path, "id_metodo,tipo_pagamento\n1,PIX\n3\n")

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(jobs, "append_quarantine", crash)
        with pytest.raises(RuntimeError):
            load_bronze(lake, root, METHOD, "2024-01-01")
    load_silver(lake, METHOD, "2024-01-01")
    assert load_bronze(lake, root, METHOD, "2024-01-01") is None
    assert lake.read("bronze", quarantine_of(METHOD)).count() == 1


def test_streams_quarantine_too(spark, lake, tmp_path):
    root = landed(tmp_path, "id_metodo,tipo_pagamento\n1,PIX\n2\n")
    landed(tmp_path, "id_metodo,tipo_pagamento\n7,Vale,x\n8,Troca\n", "part-1.csv")
    for _ in range(2):
        stream_bronze(lake, root, METHOD, str(tmp_path / "marks"), files_per_batch=1).awaitTermination()
    assert [r[0] for r in rows(lake.read("bronze", METHOD), "id_metodo")] == ["1", "8"]
    assert [r[0] for r in rows(lake.read("bronze", quarantine_of(METHOD)), "_linha_invalida")] == ["2", "7,Vale,x"]
    assert len(lake.batches("bronze", METHOD)) == 2


def test_an_order_before_its_client_gets_its_key_and_only_its_month_is_rewritten(spark, lake):
    clients = lambda keys: [(k, f"n{k}", f"c{k}", f"e{k}", "2020-01-01") for k in keys]

    def load(name, table, data, when):
        merge_silver(lake, raw(spark, table, data, when), table, when)
        return load_dimension(lake, name, when) if name else None

    others = {n: df for n, df in dims(spark).items() if n != "dim_clientes"}
    for name, df in others.items():
        lake.publish(df, "gold", name)
    first = "2024-01-01 00:00:00"
    load(None, "enderecos", [(1, 1, "SP", "a")], first)
    load("dim_clientes", "clientes", clients([1]), first)
    months = ["2024-05-05 00:00:00", "2024-06-05 00:00:00", "2024-06-06 00:00:00", "2024-07-05 00:00:00"]
    load(None, "pedidos", [order(1, 1, months[0]), order(2, 9, months[1]), order(3, 1, months[2]), order(4, 8, months[3])], first)
    load(None, "itens_pedido", [(10 + k, k, 1, 1, "5.00") for k in (1, 2, 3, 4)], first)
    load(None, "pagamentos_pedido", [(k, k, 1, "5.00", DAY) for k in (1, 2, 3, 4)], first)
    assert load_fact(lake, "2024-08-01 00:00:00") == 4
    missing = lambda: [r[0] for r in rows(lake.read("gold", FACT).filter("sk_cliente IS NULL"), "id_pedido")]
    assert missing() == [2, 4]
    assert rows(lake.read("gold", PENDING).filter("dimensao = 'dim_clientes'"), "id_pedido", "chave") == [(2, "9"), (4, "8")]
    assert load_fact(lake, "2024-08-02 00:00:00") == 0
    load("dim_clientes", "clientes", clients([1, 9]), "2024-08-03 00:00:00")
    before = {p: f for f in lake.read("gold", FACT).inputFiles() for p in f.split("/") if p.startswith("_part=")}
    assert load_fact(lake, "2024-08-04 00:00:00") == 1
    assert missing() == [4]
    after = {p: f for f in lake.read("gold", FACT).inputFiles() for p in f.split("/") if p.startswith("_part=")}
    assert {p for p in after if after[p] != before[p]} == {"_part=m202406"}
    assert rows(lake.read("gold", PENDING).filter("dimensao = 'dim_clientes'"), "id_pedido", "chave") == [(4, "8")]
    assert load_fact(lake, "2024-08-05 00:00:00") == 0
