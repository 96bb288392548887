"""The ten source tables: declared column types, primary keys, processing order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import StringType, StructField, StructType

# Table and column names and types of the source system. The first
# column of each table is its primary key.
COLUMNS = {
    "categorias": "id_categoria BIGINT, nome_categoria STRING",
    "produtos": "id_produto BIGINT, id_categoria BIGINT, nome_produto STRING, preco_base DECIMAL(10,2)",
    "clientes": "id_cliente BIGINT, nome_completo STRING, cpf STRING, email STRING, data_cadastro DATE",
    "enderecos": "id_endereco BIGINT, id_cliente BIGINT, estado STRING, cidade STRING",
    "lojas": "id_loja BIGINT, nome_loja STRING, estado_loja STRING",
    "vendedores": "id_vendedor BIGINT, id_loja BIGINT, nome_vendedor STRING",
    "metodos_pagamento": "id_metodo BIGINT, tipo_pagamento STRING",
    "pedidos": "id_pedido BIGINT, id_cliente BIGINT, id_loja BIGINT, id_vendedor BIGINT, "
    "data_pedido TIMESTAMP, status_pedido STRING",
    "itens_pedido": "id_item BIGINT, id_pedido BIGINT, id_produto BIGINT, quantidade INT, "
    "preco_unitario DECIMAL(10,2)",
    "pagamentos_pedido": "id_pagamento BIGINT, id_pedido BIGINT, id_metodo BIGINT, "
    "valor_pago DECIMAL(10,2), data_pagamento TIMESTAMP",
}

# Dimensions come before the tables that refer to them.
PROCESSING_ORDER = (
    "categorias",
    "lojas",
    "metodos_pagamento",
    "clientes",
    "produtos",
    "enderecos",
    "vendedores",
    "pedidos",
    "itens_pedido",
    "pagamentos_pedido",
)

# Silver tables the gold layer needs before it may start.
GOLD_INPUTS = tuple(t for t in PROCESSING_ORDER if t != "enderecos")

# Tables that grow with sales: their silver copies are split by ranges of the numeric
# key, so an upsert of recent keys rewrites only the last ranges. Keys per range:
KEY_RANGE = {
    "pedidos": 20_000_000,
    "itens_pedido": 50_000_000,
    "pagamentos_pedido": 50_000_000,
}
# Where the key of such a table is text, it is split into so many buckets by hash. With another
# number the next load that changes rows lays the table out anew.
KEY_BUCKETS = 64


def check_table(table: str) -> None:
    if table not in COLUMNS:
        raise ValueError(f"unknown table {table!r}; known tables: {sorted(COLUMNS)}")


def table_schema(table: str, key_types: Mapping[str, str] | None = None) -> StructType:
    """Declared types. ``key_types`` overrides single columns, e.g. ``{"id_item": "string"}``."""
    check_table(table)
    key_types = key_types or {}
    declared = StructType.fromDDL(COLUMNS[table])
    types = {f.name: key_types.get(f.name, f.dataType.simpleString()) for f in declared}
    return StructType.fromDDL(", ".join(f"{name} {dtype}" for name, dtype in types.items()))


def raw_schema(table: str) -> StructType:
    """The same columns as nullable text, as they arrive in the landing files."""
    check_table(table)
    names = StructType.fromDDL(COLUMNS[table]).names
    return StructType([StructField(n, StringType(), True) for n in names])


def primary_key(table: str) -> str:
    check_table(table)
    return StructType.fromDDL(COLUMNS[table]).names[0]
