"""Snapshots of the five dimensions, derived from silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapidar.functions.expressions import surrogate_key
from lapidar.operators.dedup import latest_per_key


@dataclass(frozen=True)
class Dimension:
    """How a dimension is keyed, tracked and built from silver tables."""

    key: str
    surrogate: str
    tracked: tuple[str, ...]
    inputs: tuple[str, ...]
    snapshot: Callable[..., DataFrame]

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.surrogate, self.key, *self.tracked)


def dim_projection(rows: DataFrame, key: str, surrogate: str, **columns: str) -> DataFrame:
    """Surrogate key, business key and the named columns (new name = source name).

    Rows are unique already: silver holds one row per key and every lookup joined to it
    is reduced to one row per key first, so no further distinct (and shuffle) is needed.
    """
    return rows.select(
        surrogate_key(key).alias(surrogate),
        key,
        *[F.col(source).alias(name) for name, source in columns.items()],
    )


def dim_left_join(entity: DataFrame, lookup: DataFrame, key: str, *columns: str) -> DataFrame:
    """Entity rows with columns of a lookup that has one row per key."""
    return entity.join(lookup.select(key, *columns), key, "left")


def clients(clientes: DataFrame, enderecos: DataFrame) -> DataFrame:
    """A client with several addresses keeps the one with the highest id."""
    addressed = enderecos.select("id_cliente", "id_endereco", "cidade", "estado").filter(
        F.col("id_cliente").isNotNull()
    )
    one = latest_per_key(addressed, "id_cliente", [F.desc("id_endereco")])
    rows = dim_left_join(clientes, one, "id_cliente", "cidade", "estado")
    return dim_projection(
        rows, "id_cliente", "sk_cliente", nome_cliente="nome_completo", cidade="cidade", estado="estado"
    )


def products(produtos: DataFrame, categorias: DataFrame) -> DataFrame:
    rows = dim_left_join(produtos, categorias, "id_categoria", "nome_categoria")
    return dim_projection(
        rows,
        "id_produto",
        "sk_produto",
        nome_produto="nome_produto",
        preco_base="preco_base",
        nome_categoria="nome_categoria",
    )


def stores(lojas: DataFrame) -> DataFrame:
    return dim_projection(
        lojas, "id_loja", "sk_loja", nome_loja="nome_loja", estado_loja="estado_loja"
    )


def sellers(vendedores: DataFrame, lojas: DataFrame) -> DataFrame:
    rows = dim_left_join(vendedores, lojas, "id_loja", "nome_loja")
    return dim_projection(
        rows, "id_vendedor", "sk_vendedor", nome_vendedor="nome_vendedor", nome_loja="nome_loja"
    )


def payment_methods(metodos: DataFrame) -> DataFrame:
    return dim_projection(metodos, "id_metodo", "sk_metodo", tipo_pagamento="tipo_pagamento")


# Keys and tracked columns of each dimension.
DIMENSIONS = {
    "dim_clientes": Dimension(
        "id_cliente",
        "sk_cliente",
        ("nome_cliente", "cidade", "estado"),
        ("clientes", "enderecos"),
        clients,
    ),
    "dim_produtos": Dimension(
        "id_produto",
        "sk_produto",
        ("nome_produto", "preco_base", "nome_categoria"),
        ("produtos", "categorias"),
        products,
    ),
    "dim_lojas": Dimension("id_loja", "sk_loja", ("nome_loja", "estado_loja"), ("lojas",), stores),
    "dim_vendedores": Dimension(
        "id_vendedor",
        "sk_vendedor",
        ("nome_vendedor", "nome_loja"),
        ("vendedores", "lojas"),
        sellers,
    ),
    "dim_metodos_pagamento": Dimension(
        "id_metodo", "sk_metodo", ("tipo_pagamento",), ("metodos_pagamento",), payment_methods
    ),
}
