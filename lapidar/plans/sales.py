"""The sales fact, its denormalised view and the named views of the gold layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lapidar.functions.expressions import at, surrogate_key
from lapidar.functions.hashes import restored, shortened
from lapidar.operators.checks import row_counts
from lapidar.operators.facts import (
    FACT_HASHES,
    fact_projection,
    items_of_orders,
    odd_keys,
    valid_version,
    with_item_total,
    with_payments,
)
from lapidar.operators.ingest import processed_at
from lapidar.operators.scd2 import BEGINNING, active_only
from lapidar.plans.dimensions import DIMENSIONS

FACT = "fato_vendas"
VIEW = "vw_vendas_detalhadas"

# Dimensions whose key stands on the order; the method stands on its payments, the product on the item.
_ORDER_DIMENSIONS = ("dim_clientes", "dim_lojas", "dim_vendedores")


def build_fact(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    dims: Mapping[str, DataFrame],
    batch_ts: str,
    hot_orders: Sequence = (),
) -> DataFrame:
    """One row per order item with the surrogate keys valid at the order date; runs the jobs of ``odd_keys_of``."""
    odd = odd_keys_of(orders, items, payments, dims)
    return full_fact(short_fact(orders, items, payments, odd, hot_orders), batch_ts)


def odd_keys_of(
    orders: DataFrame, items: DataFrame, payments: DataFrame, dims: Mapping[str, DataFrame]
) -> dict[str, DataFrame | None]:
    """Of each dimension, the keys of these rows whose surrogates have to be looked up (``facts.odd_keys``)."""
    holder = {"dim_produtos": items, "dim_metodos_pagamento": payments}

    def of(name: str) -> DataFrame | None:
        dim = DIMENSIONS[name]
        return odd_keys(holder.get(name, orders), dims[name], dim.key, dim.surrogate)

    with ThreadPoolExecutor(len(dims)) as pool:
        return dict(zip(dims, pool.map(of, dims)))


def short_fact(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    odd: Mapping[str, DataFrame | None],
    hot_orders: Sequence = (),
) -> DataFrame:
    """The fact's rows before ``full_fact``: surrogate keys that are hashes of their keys are still keys.

    Orders and items move once, by the order's key, and leave order by order. Only ``odd`` keys are
    joined, and Spark broadcasts them where they are few: four of the five dimension keys are
    properties of the order and resolved there, items choose their product's version when they know
    the order's date. ``hot_orders``, from ``skew.hot_keys`` over the items, are spread in the join
    of items and orders.
    """
    enriched = orders.select(
        "id_pedido", "id_cliente", "id_loja", "id_vendedor", "data_pedido", "status_pedido"
    )
    for name in _ORDER_DIMENSIONS:
        enriched = _resolved(_met(enriched, name, odd[name]), name)
    method = "dim_metodos_pagamento"
    enriched = _resolved(_met(with_payments(enriched, payments), method, odd[method]), method)

    narrow = items.select("id_pedido", "id_item", "id_produto", "quantidade", "preco_unitario")
    narrow = _met(shortened(narrow, ["id_item"]), "dim_produtos", odd["dim_produtos"])
    rows = _resolved(items_of_orders(narrow, enriched, hot_orders), "dim_produtos")
    # what the items of an order have in common stands side by side, so that it compresses
    of_item = ("id_item", "id_produto", "sk_produto", "quantidade", "preco_unitario")
    return rows.select(*[c for c in rows.columns if c not in of_item], *[c for c in of_item if c in rows.columns])


def full_fact(short: DataFrame, batch_ts: str) -> DataFrame:
    """The fact's own columns of ``short_fact``: texts, hashes and the items' totals."""
    texts = restored(short, [c for c in FACT_HASHES if c in short.columns])
    found = {}
    for dim in DIMENSIONS.values():
        own, looked_up = surrogate_key(dim.key), dim.surrogate in texts.columns
        if not looked_up or isinstance(texts.schema[dim.surrogate].dataType, StringType):
            found[dim.surrogate] = F.coalesce(dim.surrogate, own) if looked_up else own
    rows = with_item_total(texts.withColumns(found))
    return processed_at(fact_projection(rows), "_gold_processed_at", batch_ts)


def _met(rows: DataFrame, name: str, odd: DataFrame | None) -> DataFrame:
    """Rows with the validity spans of an odd key, which loses its place to them."""
    if odd is None:
        return rows
    dim = DIMENSIONS[name]
    met = rows.join(odd.withColumnRenamed(dim.key, "_odd"), F.col(dim.key) == F.col("_odd"), "left")
    return met.withColumn(dim.key, F.when(F.col("_odd").isNull(), F.col(dim.key))).drop("_odd")


def _resolved(rows: DataFrame, name: str) -> DataFrame:
    """Rows that know their order's date: keys without a version then are null, odd ones are surrogate keys."""
    dim = DIMENSIONS[name]
    if "_versions" in rows.columns:
        rows = valid_version(rows, "data_pedido", dim.surrogate)
    begun = F.col("data_pedido").cast("timestamp") >= at(BEGINNING)
    return rows.withColumn(dim.key, F.when(begun, F.col(dim.key)))


def sales_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Item amounts with order date and state, for measures that need no other order column."""
    lines = items.select("id_pedido", "id_produto", "quantidade", "preco_unitario")
    heads = orders.select("id_pedido", "data_pedido", "status_pedido")
    return with_item_total(items_of_orders(lines, heads))


def with_attributes(fact: DataFrame, dims: Mapping[str, DataFrame], *names: str) -> DataFrame:
    """The fact with the current attributes of the named dimensions only.

    A measure that reads one dimension joins one: Spark cannot drop the other left
    joins of a wider view by itself, as it does not know that their keys are unique.
    Hashes meet as bytes, as each large dimension moves the fact once.
    """
    if not names:
        return fact
    hashes = [c for c in FACT_HASHES if c in fact.columns and not any(_other_type(fact, dims[n], c) for n in names)]
    rows = shortened(fact, hashes)
    for name in names:
        dim = DIMENSIONS[name]
        current = active_only(dims[name]).select(dim.surrogate, *[c for c in dim.tracked if c in dims[name].columns])
        rows = rows.join(shortened(current, [dim.surrogate] if dim.surrogate in hashes else []), dim.surrogate, "left")
    return restored(rows, hashes)


def _other_type(fact: DataFrame, dim: DataFrame, key: str) -> bool:
    """Whether the dimension has this key in another type, so that Spark has to compare the values as they are."""
    return key in dim.columns and dim.schema[key].dataType != fact.schema[key].dataType


# The view's columns, in order; under a dimension, its attribute that the view shows.
VIEW_COLUMNS = {
    "id_pedido": None,
    "id_item": None,
    "data_pedido": None,
    "status_pedido": None,
    "quantidade": None,
    "preco_unitario": None,
    "valor_total_item": None,
    "valor_total_pago_pedido": None,
    "nome_cliente": ("dim_clientes", "nome_cliente"),
    "cidade_cliente": ("dim_clientes", "cidade"),
    "estado_cliente": ("dim_clientes", "estado"),
    "nome_produto": ("dim_produtos", "nome_produto"),
    "preco_base": ("dim_produtos", "preco_base"),
    "nome_categoria": ("dim_produtos", "nome_categoria"),
    "nome_loja": ("dim_lojas", "nome_loja"),
    "estado_loja": ("dim_lojas", "estado_loja"),
    "nome_vendedor": ("dim_vendedores", "nome_vendedor"),
    "tipo_pagamento": ("dim_metodos_pagamento", "tipo_pagamento"),
}
# Dimensions of the order first, the large ones before those that are broadcast: so long as the items of an
# order stay side by side, their shuffles compress what they have in common. Products scatter them.
_VIEW_JOINS = ("dim_clientes", "dim_vendedores", "dim_produtos", "dim_lojas", "dim_metodos_pagamento")


def sales_star_view(fact: DataFrame, dims: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """The fact with the current attributes of its five dimensions (18 columns), or these columns of it.

    With ``columns``, a dimension of which no attribute is asked for is not joined (``star_rows``).
    """
    wanted = columns or tuple(VIEW_COLUMNS)
    shown = {c: VIEW_COLUMNS[c] for c in wanted}
    read = [n for n in _VIEW_JOINS if any(s is not None and s[0] == n for s in shown.values())]
    rows = fact if len(read) == len(DIMENSIONS) else _as_often_as_shown(fact, dims, [n for n in DIMENSIONS if n not in read])
    attributes = {n: [s[1] for s in shown.values() if s is not None and s[0] == n] for n in read}
    kept = dict.fromkeys([c for c, s in shown.items() if s is None] + [DIMENSIONS[n].surrogate for n in read])
    narrow = {n: _narrowed(dims[n], n, attributes[n]) for n in read}
    joined = with_attributes(rows.select(*kept), narrow, *read)
    return joined.select(*[F.col(c if s is None else s[1]).alias(c) for c, s in shown.items()])


def _narrowed(dim: DataFrame, name: str, attributes: Sequence[str]) -> DataFrame:
    """The dimension without the attributes that are not asked for: two dimensions have one of the same name."""
    return dim.drop(*[c for c in DIMENSIONS[name].tracked if c not in attributes])


def star_rows(fact: DataFrame, dims: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """The view's rows in columns that it has from the fact, without joins that add nothing.

    A dimension of which no attribute is read matters only where a surrogate key has several
    active versions, as the view shows a fact row once for each. Runs a job per dimension that
    looks for such keys.
    """
    return _as_often_as_shown(fact, dims, list(DIMENSIONS)).select(*columns)


def _as_often_as_shown(fact: DataFrame, dims: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    """Each fact row as often as the joins of these dimensions would show it."""

    def repeated(name: str) -> DataFrame | None:
        key = DIMENSIONS[name].surrogate
        keys = shortened(active_only(dims[name]).select(key), [key])
        many = restored(keys.groupBy(key).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1"), [key]).persist()
        if not many.isEmpty():
            return many
        many.unpersist()
        return None

    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        found = dict(zip(names, pool.map(repeated, names)))
    rows = fact
    for name, many in found.items():
        if many is not None:
            every = F.sequence(F.lit(1).cast("long"), F.coalesce("_times", F.lit(1)))
            rows = rows.join(many, DIMENSIONS[name].surrogate, "left").withColumn("_times", F.explode(every)).drop("_times")
    return rows


def star_inner_sample(fact: DataFrame, dims: Mapping[str, DataFrame], rows: int = 5) -> DataFrame:
    """The first fact rows by item key with client and product names, as evidence of the joins."""
    clients = active_only(dims["dim_clientes"]).select("sk_cliente", "nome_cliente")
    products = active_only(dims["dim_produtos"]).select("sk_produto", "nome_produto")
    return (
        fact.join(clients, "sk_cliente")
        .join(products, "sk_produto")
        .orderBy("id_item")
        .limit(rows)
        .select(
            "id_pedido",
            "data_pedido",
            "nome_cliente",
            "nome_produto",
            "valor_total_item",
            "quantidade",
        )
    )


def register_views(spark: SparkSession, fact: DataFrame, dims: Mapping[str, DataFrame]) -> None:
    """Temp views of the gold tables: dimensions show active rows, the fact all rows."""
    for name, dim in dims.items():
        active_only(dim).createOrReplaceTempView(name)
    fact.createOrReplaceTempView(FACT)


def run_sql_script(spark: SparkSession, script: str) -> int:
    """Run ``;``-separated statements; lines that begin with ``--`` are comments."""
    kept = [line for line in script.splitlines() if not line.lstrip().startswith("--")]
    statements = [s.strip() for s in "\n".join(kept).split(";")]
    statements = [s for s in statements if s]
    for statement in statements:
        spark.sql(statement)
    return len(statements)


# The view as SQL over the registered gold views.
VIEW_SQL = f"""
-- Every fact row with the current attributes of its dimensions.
CREATE OR REPLACE TEMP VIEW {VIEW} AS
SELECT id_pedido, id_item, data_pedido, status_pedido, quantidade, preco_unitario,
       valor_total_item, valor_total_pago_pedido, nome_cliente,
       cidade AS cidade_cliente, estado AS estado_cliente, nome_produto, preco_base,
       nome_categoria, lj.nome_loja, estado_loja, nome_vendedor, tipo_pagamento
FROM {FACT}
LEFT JOIN dim_clientes USING (sk_cliente)
LEFT JOIN dim_produtos USING (sk_produto)
LEFT JOIN dim_lojas lj USING (sk_loja)
LEFT JOIN dim_vendedores USING (sk_vendedor)
LEFT JOIN dim_metodos_pagamento USING (sk_metodo);
"""


def gold_row_counts(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """Rows per registered view."""
    return row_counts({n: spark.table(n) for n in names}).withColumnRenamed("etapa", "tabela")
