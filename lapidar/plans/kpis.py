"""KPIs and trends over the fact or the sales view.

Every function takes the frame that has the columns it reads. Measures that use no
dimension attribute read the fact itself: the view adds exactly one match per fact row,
so its joins would change nothing (``checks.qa_dashboard`` verifies that).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapidar.functions.expressions import month_start, ratio
from lapidar.operators.rules import COMPLETED


def completed(sales: DataFrame) -> DataFrame:
    """Only completed orders count as revenue."""
    return sales.filter(F.col("status_pedido") == COMPLETED)


def _revenue() -> Column:
    return F.coalesce(F.sum("valor_total_item"), F.lit(0)).cast("decimal(38,2)")


def total_revenue(sales: DataFrame) -> DataFrame:
    return completed(sales).agg(_revenue().alias("receita_total"))


def total_orders(sales: DataFrame) -> DataFrame:
    return sales.agg(F.countDistinct("id_pedido").alias("total_pedidos"))


def average_ticket(sales: DataFrame) -> DataFrame:
    """Completed revenue per completed order; 0 when there is none."""
    return completed(sales).agg(
        ratio(F.sum("valor_total_item"), F.countDistinct("id_pedido")).alias("ticket_medio")
    )


def unique_clients(fact: DataFrame) -> DataFrame:
    return fact.agg(F.countDistinct("sk_cliente").alias("clientes_unicos"))


def revenue_by_category(sales: DataFrame) -> DataFrame:
    """Completed revenue per category, largest first; no category is a group of its own."""
    return (
        completed(sales)
        .groupBy("nome_categoria")
        .agg(_revenue().alias("receita"))
        .orderBy(F.desc("receita"), "nome_categoria")
    )


def monthly_revenue(sales: DataFrame) -> DataFrame:
    return (
        completed(sales)
        .groupBy(month_start("data_pedido").alias("mes"))
        .agg(_revenue().alias("receita"))
        .orderBy("mes")
    )


def gross_revenue(fact: DataFrame) -> DataFrame:
    """All order states."""
    return fact.agg(_revenue().alias("faturamento_bruto"))


def items_per_order(fact: DataFrame) -> DataFrame:
    return fact.agg(
        ratio(F.count(F.lit(1)), F.countDistinct("id_pedido")).alias("itens_por_pedido")
    )


def orders_by_method_and_month(sales: DataFrame) -> DataFrame:
    """Distinct orders per month and payment method with the method's share of the month.

    The window runs over the grouped rows: one per month and method.
    """
    per_method = sales.groupBy(month_start("data_pedido").alias("mes"), "tipo_pagamento").agg(
        F.countDistinct("id_pedido").alias("pedidos")
    )
    month = F.sum("pedidos").over(Window.partitionBy("mes"))
    return per_method.withColumn("participacao", ratio(F.col("pedidos"), month)).orderBy(
        "mes", "tipo_pagamento"
    )


def category_pareto(sales: DataFrame) -> DataFrame:
    """Categories by completed revenue with their share and running share of the total.

    The unpartitioned window sees one row per category, not the sales.
    """
    ranked = Window.orderBy(F.desc("receita"), F.asc_nulls_last("nome_categoria"))
    running = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("receita").over(everything)
    return (
        completed(sales)
        .groupBy("nome_categoria")
        .agg(_revenue().alias("receita"))
        .select(
            "nome_categoria",
            "receita",
            ratio(F.col("receita"), total).alias("participacao"),
            ratio(F.sum("receita").over(running), total).alias("participacao_acumulada"),
        )
        .orderBy(F.desc("receita"), F.asc_nulls_last("nome_categoria"))
    )
