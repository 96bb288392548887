"""Reconciliation of the KPIs against the fact they are computed from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapidar.functions.expressions import month_start, ratio
from lapidar.functions.hashes import shortened
from lapidar.operators.rules import COMPLETED
from lapidar.plans import kpis

# Fixed value: money differences up to one cent are accepted.
TOLERANCE = 0.01


def view_fact_revenue(fact: DataFrame, view: DataFrame) -> DataFrame:
    """Completed revenue as the fact's amounts, selected through the view's item keys.

    Of the view, id_item and status_pedido are read: ``star_rows`` will do.
    """
    lines = shortened(kpis.completed(view).select("id_item"), ["id_item"])
    amounts = shortened(fact.select("id_item", "valor_total_item"), ["id_item"])
    return amounts.join(lines, "id_item").agg(
        F.coalesce(F.sum("valor_total_item"), F.lit(0)).cast("decimal(38,2)").alias("receita_direta")
    )


# What ``qa_dashboard`` reads of the view, all of it from the fact, and what of it by category.
VIEW_LINES = ("id_pedido", "id_item", "data_pedido", "status_pedido", "valor_total_item")
VIEW_CATEGORIES = ("nome_categoria", "status_pedido", "valor_total_item")


def qa_dashboard(fact: DataFrame, view: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Eight checks, one row each.

    The view is read by category (``VIEW_CATEGORIES``), and as ``lines`` (``VIEW_LINES``, by default
    the view itself) by order, by month and by item; the fact by order, by client and by item. No
    row moves for more than one of these, with its key and what is summed by it; an order's rows
    are one before they move.
    """
    lines = view if lines is None else lines
    done, rows = F.col("status_pedido") == COMPLETED, F.count(F.lit(1))
    amount = F.when(done, F.col("valor_total_item"))
    total = lambda column: F.coalesce(F.sum(column), F.lit(0))

    def by_order(df: DataFrame, end: str = "") -> DataFrame:
        each = df.groupBy("id_pedido").agg(
            rows.alias("linhas"), F.count_if(done).alias("concluidas"), F.sum(amount).alias("receita")
        )
        return each.agg(
            F.coalesce(F.sum("linhas"), F.lit(0)).alias(f"linhas{end}"),
            total("receita").alias(f"receita{end}"),
            F.count("id_pedido").alias(f"pedidos{end}"),
            F.count(F.when(F.col("concluidas") > 0, F.col("id_pedido"))).alias(f"concluidos{end}"),
        )

    def summed_by(df: DataFrame, group: Column, name: str) -> DataFrame:
        return df.groupBy(group.alias("grupo")).agg(F.sum(amount).alias("receita")).agg(total("receita").alias(name))

    clients = shortened(fact.select("sk_cliente"), ["sk_cliente"]).agg(F.countDistinct("sk_cliente").alias("clientes"))
    items = shortened(lines, ["id_item"]).groupBy("id_item").agg(F.count_if(done).alias("concluidas"))
    # the clients' keys are hashes already; as numbers they need no sort
    client = F.when(F.col("sk_cliente").isNotNull(), F.xxhash64("sk_cliente"))
    amounts = shortened(fact, ["id_item"]).groupBy("id_item").agg(F.sum("valor_total_item").alias("valor"), F.min(client).alias("cliente"))
    of_items = items.join(amounts, "id_item", "left").agg(
        F.count("id_item").alias("itens"),
        F.coalesce(F.sum(F.col("valor") * F.col("concluidas")), F.lit(0)).alias("direta"),
        F.countDistinct("cliente").alias("clientes_view"),
    )
    frames = [
        by_order(lines),
        summed_by(view, F.col("nome_categoria"), "por_categoria"),
        summed_by(lines, month_start("data_pedido"), "por_mes"),
        by_order(fact, "_fato"),
        clients,
        of_items,
    ]
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    # frames of one row, side by side
    all_ = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    pairs = {
        "1_linhas_da_view": (F.col("linhas"), F.col("linhas_fato")),
        "2_receita_total": (F.col("receita"), F.col("direta")),
        "3_total_pedidos": (F.col("pedidos"), F.col("pedidos_fato")),
        # the view does not show the clients' keys: they are those of its items
        "4_clientes_unicos": (F.col("clientes_view"), F.col("clientes")),
        "5_ticket_medio": (
            ratio(F.col("receita"), F.col("concluidos")),
            ratio(F.col("receita_fato"), F.col("concluidos_fato")),
        ),
        "6_soma_das_categorias": (F.col("por_categoria"), F.col("receita")),
        "7_soma_dos_meses": (F.col("por_mes"), F.col("receita")),
        "8_id_item_unico": (F.col("linhas"), F.col("itens")),
    }
    checks = [
        F.struct(F.lit(n).alias("verificacao"), a.cast("double").alias("obtido"), b.cast("double").alias("esperado"))
        for n, (a, b) in pairs.items()
    ]
    return (
        all_.select(F.explode(F.array(*checks)).alias("c"))
        .select("c.*")
        .withColumn("passou", F.coalesce(F.abs(F.col("obtido") - F.col("esperado")) <= TOLERANCE, F.lit(False)))
    )
