from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lapidar.operators import checks
from lapidar.operators.checks import IntegrityError, require_passed
from lapidar.operators.scd2 import open_versions
from lapidar.plans import kpis
from lapidar.plans.dashboard_checks import qa_dashboard
from lapidar.plans.sales import gold_row_counts, run_sql_script


@pytest.fixture(scope="module")
def dim(spark):
    df = spark.createDataFrame([(1, "Ana", "SP"), (2, "Bruno", "RJ")], "id_cliente bigint, nome_cliente string, cidade string")
    return open_versions(df.withColumn("sk_cliente", F.md5(F.col("id_cliente").cast("string"))), "2024-01-01", "2024-01-01")


def failed(report):
    return {r["verificacao"] for r in report.filter("not passou").collect()}


def test_sound_dimension_passes(dim):
    report = checks.initial_load(dim, "dim", "id_cliente", "sk_cliente")
    assert failed(report) == set() and report.count() == 10
    require_passed(report)
    assert checks.single_active(dim, "id_cliente").first().passou


@pytest.mark.parametrize(
    "fault, names",
    [
        (lambda d: d.union(d.filter("id_cliente = 1")), {"unicidade_registro_ativo_por_chave"}),
        (lambda d: d.withColumn("data_fim_vigencia", F.current_timestamp()), {"ativos_sem_data_fim"}),
        (lambda d: d.withColumn("registro_ativo", F.lit(False)), {"inativos_com_data_fim"}),
        (lambda d: d.withColumn("registro_ativo", F.lit(None).cast("boolean")), {"sem_nulos_em_registro_ativo"}),
        (lambda d: d.drop("data_fim_vigencia"), {"colunas_scd2_presentes"}),
        (lambda d: d.limit(0), {"tabela_nao_vazia"}),
    ],
)
def test_faults_are_found(dim, fault, names):
    report = checks.dimension_scd2(fault(dim), "dim", "id_cliente")
    assert failed(report) == names
    with pytest.raises(IntegrityError, match=sorted(names)[0]):
        require_passed(report)


def test_surrogate_key_result_is_returned(dim):
    assert failed(checks.surrogate_key_check(dim.union(dim), "dim", "sk_cliente")) == {"sk_duplicadas"}
    nulls = dim.withColumn("sk_cliente", F.lit(None).cast("string"))
    assert failed(checks.surrogate_key_check(nulls, "dim", "sk_cliente")) == {"sk_nulas", "sk_duplicadas"}


SALES = (
    "id_pedido int, id_item int, sk_cliente string, sk_produto string, data_pedido timestamp, status_pedido string, "
    "valor_total_item decimal(21,2), nome_categoria string, tipo_pagamento string"
)


@pytest.fixture(scope="module")
def sales(spark):
    may, june = datetime(2024, 5, 3), datetime(2024, 6, 3)
    return spark.createDataFrame(
        [
            (1, 1, "c1", "p1", may, "Concluído", Decimal("10.00"), "Casa", "PIX"),
            (1, 2, "c1", "p2", may, "Concluído", Decimal("30.00"), "Jardim", "PIX"),
            (2, 3, "c2", "p1", june, "Concluído", Decimal("20.00"), "Casa", "Boleto"),
            (3, 4, "c1", "p3", june, "Pendente", Decimal("99.00"), "Casa", "PIX"),
            (4, 5, "c1", "p3", june, "Concluído", Decimal("40.00"), None, None),
        ],
        SALES,
    )


def test_kpis(sales):
    assert kpis.total_revenue(sales).first()[0] == Decimal("100.00")
    assert kpis.total_orders(sales).first()[0] == 4
    assert kpis.average_ticket(sales).first()[0] == pytest.approx(100 / 3)
    assert kpis.unique_clients(sales).first()[0] == 2
    assert kpis.gross_revenue(sales).first()[0] == Decimal("199.00")
    assert kpis.items_per_order(sales).first()[0] == 1.25
    assert [tuple(r) for r in kpis.revenue_by_category(sales).collect()] == [
        (None, Decimal("40.00")), ("Casa", Decimal("30.00")), ("Jardim", Decimal("30.00"))]
    assert [r.receita for r in kpis.monthly_revenue(sales).collect()] == [Decimal("40.00"), Decimal("60.00")]
    assert [round(r.participacao_acumulada, 2) for r in kpis.category_pareto(sales).collect()] == [0.4, 0.7, 1.0]
    shares = {(r.mes.month, r.tipo_pagamento): r.participacao for r in kpis.orders_by_method_and_month(sales).collect()}
    assert shares[(5, "PIX")] == 1.0 and shares[(6, "PIX")] == pytest.approx(1 / 3)


def test_kpis_of_nothing_are_zero(sales):
    none = sales.filter("id_pedido > 100")
    assert kpis.total_revenue(none).first()[0] == 0
    assert kpis.average_ticket(none).first()[0] == 0.0
    assert kpis.items_per_order(none).first()[0] == 0.0
    pending = sales.filter("status_pedido = 'Pendente'")
    assert kpis.average_ticket(pending).first()[0] == 0.0


def test_fact_quality(sales):
    assert failed(checks.fact_quality(sales)) == set()
    assert failed(checks.fact_quality(sales.union(sales))) == {"id_item_unico"}
    bad = sales.withColumns({"valor_total_item": F.lit(0), "sk_cliente": F.lit(None), "sk_produto": F.lit(None)})
    assert failed(checks.fact_quality(bad)) == {
        "valor_total_item_positivo", "sk_cliente_preenchida", "sk_produto_preenchida"}
    assert failed(checks.fact_quality(sales.limit(0))) == {"tabela_nao_vazia"}


def test_dashboard_reconciliation(sales):
    assert failed(qa_dashboard(sales, sales)) == set()
    repeated = sales.union(sales.filter("id_item = 1"))
    assert failed(qa_dashboard(sales, repeated)) == {"1_linhas_da_view", "5_ticket_medio", "8_id_item_unico"}
    dearer = sales.withColumn("valor_total_item", F.col("valor_total_item") + 1)
    assert failed(qa_dashboard(sales, dearer)) == {"2_receita_total", "5_ticket_medio"}
    gone = sales.filter(~F.col("sk_cliente").eqNullSafe(sales.agg(F.min("sk_cliente")).first()[0]))
    assert "4_clientes_unicos" in failed(qa_dashboard(sales, gone))
    pending = sales.filter("status_pedido = 'Pendente'")
    assert failed(qa_dashboard(pending, pending)) == set()


def test_duplicates_nulls_counts(spark, sales):
    assert rows(checks.duplicate_keys(sales, "id_pedido")) == [(1, 2)]
    nulls = {r.coluna: r.nulos for r in checks.null_counts(sales).collect()}
    assert nulls["nome_categoria"] == 1 and nulls["id_item"] == 0 and len(nulls) == 9
    assert rows(checks.distinct_counts(sales, ["id_pedido", "id_item"])) == [("id_item", 5), ("id_pedido", 4)]


def test_sql_script(spark, sales):
    sales.createOrReplaceTempView("vendas_teste")
    script = """
    -- a comment; with a semicolon
    CREATE OR REPLACE TEMP VIEW a AS SELECT * FROM vendas_teste;
      -- another
    CREATE OR REPLACE TEMP VIEW b AS
    SELECT * FROM a WHERE id_pedido = 1;
    """
    assert run_sql_script(spark, script) == 2
    assert rows(gold_row_counts(spark, ["a", "b"])) == [("a", 5), ("b", 2)]
