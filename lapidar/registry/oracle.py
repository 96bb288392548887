"""DuckDB SQL for the registered queries, written independently of the Spark plans."""

from __future__ import annotations

import re

T1, T2, T3 = "1997-01-01 00:00:00", "1998-06-01 00:00:00", "2002-01-01 00:00:00"

_DIMS = {
    "dim_clientes": ("id_cliente", "sk_cliente", ("nome_cliente", "cidade", "estado")),
    "dim_produtos": ("id_produto", "sk_produto", ("nome_produto", "preco_base", "nome_categoria")),
    "dim_lojas": ("id_loja", "sk_loja", ("nome_loja", "estado_loja")),
    "dim_vendedores": ("id_vendedor", "sk_vendedor", ("nome_vendedor", "nome_loja")),
    "dim_metodos_pagamento": ("id_metodo", "sk_metodo", ("tipo_pagamento",)),
}
_TABLES = (
    "categorias lojas metodos_pagamento clientes produtos enderecos vendedores pedidos "
    "itens_pedido pagamentos_pedido"
).split()
_CAT = "CAST('0x' || substr(md5(p_type), 1, 15) AS BIGINT)"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'Concluído' WHEN 'O' THEN 'Pendente' ELSE 'Cancelado' END"
_ITEM = (
    "md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
    "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_shipdate AS VARCHAR)))"
)


def _batch(key: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN TIMESTAMP '{T2}' ELSE TIMESTAMP '{T1}' END"


def _master(n: int) -> dict[str, str]:
    """Master data in state ``n``."""
    first = n == 1
    known = lambda key: f"WHERE {key} % 100 <> 99" if first else "WHERE true"
    moved = lambda key, nation: nation if first else f"CASE WHEN {key} % 7 = 0 THEN ({nation} + 1) % 25 ELSE {nation} END"
    return {
        f"produtos_{n}": f"""
            SELECT p_partkey AS id_produto,
                   {_CAT if first else f'CASE WHEN p_partkey % 11 <> 0 THEN {_CAT} END'} AS id_categoria,
                   p_name AS nome_produto,
                   CAST(CAST(p_retailprice AS DECIMAL(10,2))
                        + {'0' if first else 'CASE WHEN p_partkey % 7 = 0 THEN 10 ELSE 0 END'}
                        AS DECIMAL(10,2)) AS preco_base
            FROM part {known('p_partkey')}""",
        f"clientes_{n}": f"""
            SELECT c_custkey AS id_cliente, c_name AS nome_completo,
                   CASE WHEN c_custkey % 10 <> 3 THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS cpf,
                   CASE WHEN c_custkey % 20 <> 1 THEN c_name || '@x' END AS email,
                   DATE '1994-12-31' AS data_cadastro
            FROM customer {known('c_custkey')}""",
        f"enderecos_{n}": f"""
            SELECT c_custkey * 2 + 1 AS id_endereco, c_custkey AS id_cliente, r_name AS estado,
                   {'n_name' if first else 'CASE WHEN c_custkey % 11 <> 0 THEN n_name END'} AS cidade
            FROM customer
            JOIN nation ON n_nationkey = {moved('c_custkey', 'c_nationkey')}
            JOIN region ON r_regionkey = n_regionkey
            {known('c_custkey')}
            UNION ALL
            SELECT c_custkey * 2, c_custkey, 'ANTES', 'ANTIGA'
            FROM customer {known('c_custkey')} AND c_custkey % 9 = 0""",
        f"lojas_{n}": f"""
            SELECT n_nationkey AS id_loja, n_name AS nome_loja, ' ' || lower(r_name) || ' ' AS estado_loja
            FROM nation JOIN region
              ON r_regionkey = {'n_regionkey' if first else 'CASE WHEN n_nationkey % 7 = 0 THEN (n_regionkey + 1) % 5 ELSE n_regionkey END'}
            {'WHERE n_nationkey <> 24' if first else ''}""",
        f"vendedores_{n}": f"""
            SELECT s_suppkey AS id_vendedor, {moved('s_suppkey', 's_nationkey')} AS id_loja,
                   s_name AS nome_vendedor
            FROM supplier {known('s_suppkey')}""",
        f"metodos_pagamento_{n}": f"""
            SELECT DISTINCT CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS id_metodo,
                   {"o_orderpriority" if first else "CASE WHEN o_orderpriority LIKE '3%' THEN o_orderpriority || ' (novo)' ELSE o_orderpriority END"}
                   AS tipo_pagamento
            FROM orders {"WHERE o_orderpriority NOT LIKE '5%'" if first else ''}""",
        f"snap_dim_clientes_{n}": f"""
            SELECT md5(CAST(c.id_cliente AS VARCHAR)) AS sk_cliente, c.id_cliente,
                   nome_completo AS nome_cliente, e.cidade, e.estado
            FROM clientes_{n} c LEFT JOIN (
                SELECT * FROM enderecos_{n}
                QUALIFY row_number() OVER (PARTITION BY id_cliente ORDER BY id_endereco DESC) = 1
            ) e ON e.id_cliente = c.id_cliente""",
        f"snap_dim_produtos_{n}": f"""
            SELECT md5(CAST(id_produto AS VARCHAR)) AS sk_produto, id_produto, nome_produto,
                   preco_base, nome_categoria
            FROM produtos_{n} p LEFT JOIN categorias c ON c.id_categoria = p.id_categoria""",
        f"snap_dim_lojas_{n}": f"""
            SELECT md5(CAST(id_loja AS VARCHAR)) AS sk_loja, id_loja, nome_loja,
                   upper(trim(estado_loja)) AS estado_loja
            FROM lojas_{n}""",
        f"snap_dim_vendedores_{n}": f"""
            SELECT md5(CAST(id_vendedor AS VARCHAR)) AS sk_vendedor, id_vendedor, nome_vendedor, nome_loja
            FROM vendedores_{n} v LEFT JOIN lojas_{n} l ON l.id_loja = v.id_loja""",
        f"snap_dim_metodos_pagamento_{n}": f"""
            SELECT md5(CAST(id_metodo AS VARCHAR)) AS sk_metodo, id_metodo, tipo_pagamento
            FROM metodos_pagamento_{n}""",
    }


def _opened(columns: str, start: str, stamp: str) -> str:
    return (
        f"{columns}, {start} AS data_inicio_vigencia, CAST(NULL AS TIMESTAMP) AS data_fim_vigencia, "
        f"true AS registro_ativo, TIMESTAMP '{stamp}' AS _gold_processed_at"
    )


def _changed(tracked: tuple[str, ...], old: str, new: str) -> str:
    return "(" + " OR ".join(f"{old}.{c} IS DISTINCT FROM {new}.{c}" for c in tracked) + ")"


_ORIGIN = "TIMESTAMP '1900-01-01 00:00:00'"


def _two_loads(name: str, new_key_start: str = _ORIGIN) -> str:
    key, _, tracked = _DIMS[name]
    diff = _changed(tracked, "o", "s")
    return f"""
        SELECT o.* REPLACE (
                   CASE WHEN s.{key} IS NOT NULL AND {diff} THEN TIMESTAMP '{T2}' END AS data_fim_vigencia,
                   NOT (s.{key} IS NOT NULL AND {diff}) AS registro_ativo)
        FROM {name}_inicial o LEFT JOIN snap_{name}_2 s ON s.{key} = o.{key}
        UNION ALL BY NAME
        SELECT {_opened('s.*', f"CASE WHEN o.{key} IS NULL THEN {new_key_start} ELSE TIMESTAMP '{T2}' END", T2)}
        FROM snap_{name}_2 s LEFT JOIN {name}_inicial o ON o.{key} = s.{key}
        WHERE o.{key} IS NULL OR {diff}"""


def _valid(alias: str, key: str, outer: str = "p") -> str:
    return (
        f"{alias}.{key} = {outer}.{key} AND p.data_pedido >= {alias}.data_inicio_vigencia AND "
        f"({alias}.data_fim_vigencia IS NULL OR p.data_pedido < {alias}.data_fim_vigencia)"
    )


def _int(column: str) -> str:
    pattern = r"'^\s*([+-]?\d+)\.\d*\s*$'"
    return (
        f"coalesce(TRY_CAST({column} AS BIGINT), "
        f"TRY_CAST(regexp_extract({column}, {pattern}, 1) AS BIGINT))"
    )


_BRONZE_COLUMNS = (
    "id_pedido",
    "id_cliente",
    "id_loja",
    "id_vendedor",
    "data_pedido",
    "status_pedido",
    "_source_table",
)
_TYPED_ORDER = f"""{_int('id_pedido')} AS id_pedido, {_int('id_cliente')} AS id_cliente,
    {_int('id_loja')} AS id_loja, {_int('id_vendedor')} AS id_vendedor,
    TRY_CAST(data_pedido AS TIMESTAMP) AS data_pedido, trim(status_pedido) AS status_pedido,
    _ingestion_timestamp, _source_file, _source_table"""

_FACT_SELECT = """
    SELECT i.id_pedido, i.id_item, c.sk_cliente, l.sk_loja, v.sk_vendedor, d.sk_produto, m.sk_metodo,
           p.data_pedido, p.status_pedido, i.quantidade, i.preco_unitario,
           CAST(i.quantidade * i.preco_unitario AS DECIMAL(38,2)) AS valor_total_item,
           CAST(g.valor_total_pago_pedido AS DECIMAL(38,2)) AS valor_total_pago_pedido"""


def _ctes() -> dict[str, str]:
    ctes = {
        "categorias": f"SELECT DISTINCT {_CAT} AS id_categoria, p_type AS nome_categoria FROM part",
        **_master(1),
        **_master(2),
    }
    for name in _DIMS:
        ctes[f"{name}_inicial"] = f"SELECT {_opened('*', _ORIGIN, T1)} FROM snap_{name}_1"
        ctes[f"{name}_completa"] = f"SELECT {_opened('*', _ORIGIN, T2)} FROM snap_{name}_2"
        ctes[name] = _two_loads(name)
    ctes["pedidos"] = f"""
        SELECT o_orderkey AS id_pedido, o_custkey AS id_cliente, o_orderkey % 25 AS id_loja,
               o_orderkey % (SELECT count(*) FROM supplier) AS id_vendedor, o_orderdate AS data_pedido,
               {_STATUS} AS status_pedido, {_batch('o_orderkey')} AS _silver_processed_at
        FROM orders"""
    ctes["itens_pedido"] = f"""
        SELECT {_ITEM} AS id_item, l_orderkey AS id_pedido, l_partkey AS id_produto,
               CAST(l_quantity AS INTEGER) AS quantidade,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS preco_unitario,
               {_batch('l_orderkey')} AS _silver_processed_at
        FROM lineitem"""
    ctes["pagamentos_pedido"] = f"""
        SELECT o_orderkey * 2 AS id_pagamento, o_orderkey AS id_pedido,
               CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS id_metodo,
               CAST(o_totalprice AS DECIMAL(10,2)) AS valor_pago, o_orderdate AS data_pagamento,
               {_batch('o_orderkey')} AS _silver_processed_at
        FROM orders
        UNION ALL
        SELECT o_orderkey * 2 + 1, o_orderkey, CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) % 5 + 1,
               CAST(1 AS DECIMAL(10,2)), o_orderdate, {_batch('o_orderkey')}
        FROM orders WHERE o_orderkey % 8 = 0"""
    ctes["pagos"] = """
        SELECT id_pedido, CAST(sum(valor_pago) AS DECIMAL(38,2)) AS valor_total_pago_pedido,
               arg_min(id_metodo, id_pagamento) AS id_metodo
        FROM pagamentos_pedido GROUP BY id_pedido"""
    ctes["fato"] = f"""{_FACT_SELECT}, TIMESTAMP '{T3}' AS _gold_processed_at
        FROM itens_pedido i
        JOIN pedidos p ON p.id_pedido = i.id_pedido
        LEFT JOIN pagos g ON g.id_pedido = p.id_pedido
        LEFT JOIN dim_clientes c ON {_valid('c', 'id_cliente')}
        LEFT JOIN dim_lojas l ON {_valid('l', 'id_loja')}
        LEFT JOIN dim_vendedores v ON {_valid('v', 'id_vendedor')}
        LEFT JOIN dim_produtos d ON {_valid('d', 'id_produto', 'i')}
        LEFT JOIN dim_metodos_pagamento m ON {_valid('m', 'id_metodo', 'g')}"""
    ctes["fato_carga_1"] = f"""{_FACT_SELECT}, TIMESTAMP '{T3}' AS _gold_processed_at
        FROM itens_pedido i
        JOIN pedidos p ON p.id_pedido = i.id_pedido AND p._silver_processed_at = TIMESTAMP '{T1}'
        LEFT JOIN pagos g ON g.id_pedido = p.id_pedido
        LEFT JOIN dim_clientes_inicial c ON c.id_cliente = p.id_cliente
        LEFT JOIN dim_lojas_inicial l ON l.id_loja = p.id_loja
        LEFT JOIN dim_vendedores_inicial v ON v.id_vendedor = p.id_vendedor
        LEFT JOIN dim_produtos_inicial d ON d.id_produto = i.id_produto
        LEFT JOIN dim_metodos_pagamento_inicial m ON m.id_metodo = g.id_metodo"""
    ctes["vw"] = """
        SELECT f.id_pedido, f.id_item, f.data_pedido, f.status_pedido, f.quantidade, f.preco_unitario,
               f.valor_total_item, f.valor_total_pago_pedido, c.nome_cliente,
               c.cidade AS cidade_cliente, c.estado AS estado_cliente, d.nome_produto, d.preco_base,
               d.nome_categoria, l.nome_loja, l.estado_loja, v.nome_vendedor, m.tipo_pagamento
        FROM fato f
        LEFT JOIN dim_clientes c ON c.sk_cliente = f.sk_cliente AND c.registro_ativo
        LEFT JOIN dim_produtos d ON d.sk_produto = f.sk_produto AND d.registro_ativo
        LEFT JOIN dim_lojas l ON l.sk_loja = f.sk_loja AND l.registro_ativo
        LEFT JOIN dim_vendedores v ON v.sk_vendedor = f.sk_vendedor AND v.registro_ativo
        LEFT JOIN dim_metodos_pagamento m ON m.sk_metodo = f.sk_metodo AND m.registro_ativo"""
    ctes["bronze_pedidos"] = f"""
        SELECT CASE WHEN o_orderkey % 101 = 0 THEN 'x' || o_orderkey
                    WHEN o_orderkey % 5 = 0 AND copia = 2 THEN o_orderkey || '.0'
                    WHEN o_orderkey % 6 = 0 THEN ' ' || o_orderkey
                    ELSE CAST(o_orderkey AS VARCHAR) END AS id_pedido,
               CASE WHEN o_orderkey % 9 = 0 THEN o_custkey || '.0'
                    WHEN o_orderkey % 23 = 0 THEN 'abc'
                    WHEN o_orderkey % 31 = 0 THEN '  '
                    WHEN o_orderkey % 29 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS id_cliente,
               CAST(o_orderkey % 25 AS VARCHAR) AS id_loja,
               CASE WHEN o_orderkey % 37 = 0 THEN '12345678901'
                    ELSE CAST(o_orderkey % 10 AS VARCHAR) END AS id_vendedor,
               CASE WHEN o_orderkey % 13 = 0 THEN '02/01/2024'
                    ELSE CAST(o_orderdate AS VARCHAR) END AS data_pedido,
               CASE WHEN o_orderkey % 17 = 0 THEN 'Devolvido'
                    WHEN o_orderkey % 19 = 0 THEN NULL
                    WHEN copia = 2 THEN 'Cancelado'
                    WHEN copia = 3 THEN ' ' || {_STATUS} || ' '
                    ELSE {_STATUS} END AS status_pedido,
               CASE WHEN copia = 2 THEN TIMESTAMP '{T2}' ELSE TIMESTAMP '{T1}' END AS _ingestion_timestamp,
               'carga-' || copia AS _source_file, 'pedidos' AS _source_table
        FROM (SELECT *, unnest(CASE WHEN o_orderkey % 20 = 0 THEN [1, 2, 3]
                                    WHEN o_orderkey % 4 = 0 THEN [1, 2]
                                    WHEN o_orderkey % 10 = 0 THEN [1, 3] ELSE [1] END) AS copia
              FROM orders)"""
    ctes["pedidos_recentes"] = f"""
        SELECT * FROM bronze_pedidos
        QUALIFY row_number() OVER (
            PARTITION BY coalesce(CAST({_int('id_pedido')} AS VARCHAR), id_pedido)
            ORDER BY _ingestion_timestamp DESC, _source_file DESC,
                     {', '.join(f'{c} DESC NULLS LAST' for c in _BRONZE_COLUMNS)}) = 1"""
    ctes["pedidos_tipados"] = f"SELECT {_TYPED_ORDER} FROM bronze_pedidos"
    ctes["pedidos_silver"] = f"""
        SELECT *, TIMESTAMP '{T2}' AS _silver_processed_at
        FROM (SELECT {_TYPED_ORDER} FROM pedidos_recentes)
        WHERE id_pedido IS NOT NULL AND status_pedido IN ('Concluído', 'Pendente', 'Cancelado')"""
    ctes["bronze_pagamentos"] = f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id_pagamento, CAST(o_orderkey AS VARCHAR) AS id_pedido,
               split_part(o_orderpriority, '-', 1) AS id_metodo,
               CASE WHEN o_orderkey % 8 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) || '5'
                    WHEN o_orderkey % 15 = 0 THEN 'R$ 10'
                    WHEN o_orderkey % 21 = 0 THEN '123456789.12'
                    WHEN o_orderkey % 27 = 0 THEN '-1'
                    WHEN o_orderkey % 33 = 0 THEN ' 7 '
                    ELSE CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END AS valor_pago,
               CAST(o_orderdate AS VARCHAR) AS data_pagamento,
               TIMESTAMP '{T1}' AS _ingestion_timestamp, 'carga-1' AS _source_file
        FROM orders"""
    ctes["pagamentos_tipados"] = """
        SELECT CAST(id_pagamento AS BIGINT) AS id_pagamento, CAST(id_pedido AS BIGINT) AS id_pedido,
               CAST(id_metodo AS BIGINT) AS id_metodo,
               TRY_CAST(valor_pago AS DECIMAL(10,2)) AS valor_pago,
               CAST(data_pagamento AS TIMESTAMP) AS data_pagamento, _ingestion_timestamp, _source_file
        FROM bronze_pagamentos"""
    ctes["concluidos"] = "SELECT * FROM vw WHERE status_pedido = 'Concluído'"
    return ctes


_CTES = _ctes()


def _sql(body: str) -> str:
    """The body with the common table expressions it uses, directly or not."""
    text, used = body, []
    for name, definition in reversed(_CTES.items()):
        if re.search(rf"\b{name}\b", text):
            used.append(f"{name} AS ({definition})")
            text += "\n" + definition
    return f"WITH {', '.join(reversed(used))}\n{body}" if used else body


def _counts(tables: dict[str, str], label: str = "etapa") -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS {label}, count(*) AS linhas FROM {t}" for n, t in tables.items()
    )


def _bound(table: str, n: int = 2) -> str:
    fixed = ("categorias", "pedidos", "itens_pedido", "pagamentos_pedido")
    return table if table in fixed else f"{table}_{n}"


def _scd2_checks(table: str, frame: str, key: str, required: tuple[str, ...]) -> list[str]:
    zero = {
        "unicidade_registro_ativo_por_chave": f"(SELECT count(*) FROM (SELECT {key} FROM {frame} "
        f"WHERE registro_ativo GROUP BY {key} HAVING count(*) > 1))",
        "ativos_sem_data_fim": f"(SELECT count(*) FROM {frame} "
        "WHERE registro_ativo AND data_fim_vigencia IS NOT NULL)",
        "inativos_com_data_fim": f"(SELECT count(*) FROM {frame} "
        "WHERE NOT registro_ativo AND data_fim_vigencia IS NULL)",
        **{
            f"sem_nulos_em_{c}": f"(SELECT count(*) FROM {frame} WHERE {c} IS NULL)"
            for c in required
        },
    }
    rows = [
        f"SELECT '{table}' AS tabela, 'tabela_existe' AS verificacao, 1 AS medida, true AS passou",
        f"SELECT '{table}', 'tabela_nao_vazia', (SELECT count(*) FROM {frame}), "
        f"(SELECT count(*) FROM {frame}) > 0",
        f"SELECT '{table}', 'colunas_scd2_presentes', 0, true",
    ]
    return rows + [f"SELECT '{table}', '{n}', {q}, {q} = 0" for n, q in zero.items()]


def _sk_checks(table: str, frame: str, sk: str) -> list[str]:
    count = f"(SELECT count(*) FROM {frame})"
    nulls = f"(SELECT count(*) FROM {frame} WHERE {sk} IS NULL)"
    repeated = f"(SELECT count(*) FROM (SELECT {sk} FROM {frame} GROUP BY {sk} HAVING count(*) > 1))"
    return [
        f"SELECT '{table}' AS tabela, 'registros' AS verificacao, {count} AS medida, {count} > 0 AS passou",
        f"SELECT '{table}', 'sk_nulas', {nulls}, {nulls} = 0",
        f"SELECT '{table}', 'sk_duplicadas', {repeated}, {repeated} = 0",
    ]


def _all(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


def _dashboard_checks() -> str:
    revenue = "(SELECT coalesce(sum(valor_total_item), 0) FROM concluidos)"
    orders = "(SELECT count(DISTINCT id_pedido) FROM concluidos)"
    ticket = f"coalesce(CAST({revenue} AS DOUBLE) / nullif({orders}, 0), 0)"
    pairs = {
        "1_linhas_da_view": ("(SELECT count(*) FROM vw)", "(SELECT count(*) FROM fato)"),
        "2_receita_total": (
            revenue,
            "(SELECT coalesce(sum(f.valor_total_item), 0) FROM fato f "
            "JOIN concluidos v ON v.id_item = f.id_item)",
        ),
        "3_total_pedidos": (
            "(SELECT count(DISTINCT id_pedido) FROM vw)",
            "(SELECT count(DISTINCT id_pedido) FROM fato)",
        ),
        "4_clientes_unicos": (
            "(SELECT count(DISTINCT sk_cliente) FROM fato WHERE id_item IN (SELECT id_item FROM vw))",
            "(SELECT count(DISTINCT sk_cliente) FROM fato)",
        ),
        "5_ticket_medio": (
            ticket,
            "(SELECT coalesce(CAST(sum(valor_total_item) AS DOUBLE) / nullif(count(DISTINCT id_pedido), 0), 0) "
            "FROM fato WHERE status_pedido = 'Concluído')",
        ),
        "6_soma_das_categorias": (
            "(SELECT sum(r) FROM (SELECT sum(valor_total_item) AS r FROM concluidos GROUP BY nome_categoria))",
            revenue,
        ),
        "7_soma_dos_meses": (
            "(SELECT sum(r) FROM (SELECT sum(valor_total_item) AS r FROM concluidos "
            "GROUP BY date_trunc('month', data_pedido)))",
            revenue,
        ),
        "8_id_item_unico": (
            "(SELECT count(*) FROM vw)",
            "(SELECT count(DISTINCT id_item) FROM vw)",
        ),
    }
    return _all(
        [
            f"SELECT '{n}' AS verificacao, CAST({a} AS DOUBLE) AS obtido, CAST({b} AS DOUBLE) AS esperado, "
            f"abs(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE)) <= 0.01 AS passou"
            for n, (a, b) in pairs.items()
        ]
    )


def _revenue(name: str) -> str:
    return f"CAST(coalesce(sum(valor_total_item), 0) AS DECIMAL(38,2)) AS {name}"


def oracle_queries() -> dict[str, str]:
    clients = _DIMS["dim_clientes"]
    changed_clients = _changed(clients[2], "o", "s")
    label = (
        "CASE WHEN o.{key} IS NULL THEN 'novo' WHEN {diff} THEN 'alterado' "
        "ELSE 'sem_alteracao' END"
    )
    client_pairs = (
        "snap_dim_clientes_2 s LEFT JOIN dim_clientes_inicial o ON o.id_cliente = s.id_cliente"
    )
    bad_cells = {
        "id_pedido": ("bigint", _int("id_pedido")),
        "id_cliente": ("bigint", _int("id_cliente")),
        "id_loja": ("bigint", _int("id_loja")),
        "id_vendedor": ("bigint", _int("id_vendedor")),
        "data_pedido": ("timestamp", "TRY_CAST(data_pedido AS TIMESTAMP)"),
    }
    no_method = "CASE WHEN status_pedido IN ('Concluído', 'Pendente', 'Cancelado') THEN 1 ELSE 0 END"
    fact_nulls = (
        "id_pedido id_item sk_cliente sk_loja sk_vendedor sk_produto sk_metodo data_pedido "
        "status_pedido quantidade preco_unitario valor_total_item valor_total_pago_pedido "
        "_gold_processed_at"
    ).split()
    raw_orders = ", ".join(_BRONZE_COLUMNS[:-1])
    waves = f"SELECT * FROM fato_carga_1 UNION ALL SELECT * FROM fato WHERE id_pedido % 3 = 0"
    marks = _all(
        [
            f"SELECT '{n}' AS fonte, CAST(max(_silver_processed_at) AS VARCHAR) AS marca FROM {n}"
            for n in _TABLES[-3:]
        ]
    )
    bodies = {
        # scans, sources, sinks
        "scan_csv_raw": f"SELECT {raw_orders} FROM bronze_pedidos",
        "extract_table": "SELECT * FROM customer",
        "sink_csv_landing": "SELECT CAST(id_produto AS VARCHAR) AS id_produto, "
        "CAST(id_categoria AS VARCHAR) AS id_categoria, nome_produto, "
        "CAST(preco_base AS VARCHAR) AS preco_base FROM produtos_2",
        "read_layer": "SELECT * FROM clientes_2",
        "assert_not_empty": _counts({n: _bound(n) for n in _TABLES}),
        "sink_append": "SELECT * FROM vendedores_1 UNION ALL SELECT * FROM vendedores_2",
        "sink_overwrite": "SELECT * FROM vendedores_2",
        "table_exists": _counts({**{n: n for n in _DIMS}, "fato_vendas": "fato"}),
        "local_rows": f"SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'Concluído' "
        "WHEN 'O' THEN 'Pendente' WHEN 'P' THEN 'Cancelado' END AS status_pedido FROM orders",
        "compact_table": "SELECT * FROM dim_clientes",
        "register_views": "SELECT * FROM dim_vendedores WHERE registro_ativo",
        "load_sql_views": "SELECT * FROM vw",
        "gold_row_counts": _counts(
            {
                **{n: f"(SELECT * FROM {n} WHERE registro_ativo)" for n in _DIMS},
                "fato_vendas": "fato",
            },
            "tabela",
        ),
        # projections, filters, predicates
        "bronze_audit": f"""SELECT CAST(id_cliente AS VARCHAR) AS id_cliente, nome_completo, cpf,
            email, CAST(data_cadastro AS VARCHAR) AS data_cadastro,
            TIMESTAMP '{T1}' AS _ingestion_timestamp, 'clientes_raw.csv' AS _source_file,
            'clientes' AS _source_table FROM clientes_2""",
        "processed_at": f"SELECT *, TIMESTAMP '{T2}' AS _silver_processed_at FROM clientes_2",
        "dim_projection": "SELECT md5(CAST(id_produto AS VARCHAR)) AS sk_produto, id_produto, "
        "nome_produto AS nome, preco_base AS preco FROM produtos_2",
        "drop_null_key": "SELECT * EXCLUDE (_source_table) FROM pedidos_tipados WHERE id_pedido IS NOT NULL",
        "rule_not_null": "SELECT * FROM clientes_2 WHERE cpf IS NOT NULL AND email IS NOT NULL",
        "rule_in_set": "SELECT * EXCLUDE (_source_table) FROM pedidos_tipados "
        "WHERE status_pedido IN ('Concluído', 'Pendente', 'Cancelado')",
        "rule_positive": "SELECT * FROM pagamentos_tipados WHERE valor_pago > 0",
        "rule_normalize": "SELECT * REPLACE (upper(trim(estado_loja)) AS estado_loja) FROM lojas_2",
        "rule_registry": _counts(
            {
                **{n: _bound(n) for n in _TABLES},
                "clientes": "(SELECT * FROM clientes_2 WHERE cpf IS NOT NULL AND email IS NOT NULL)",
                "pedidos": f"(SELECT * FROM pedidos_tipados WHERE {no_method} = 1)",
                "itens_pedido": "(SELECT * FROM itens_pedido WHERE quantidade > 0 AND preco_unitario > 0)",
                "pagamentos_pedido": "(SELECT * FROM pagamentos_pedido WHERE valor_pago > 0)",
            }
        ),
        "active_only": "SELECT * FROM dim_produtos WHERE registro_ativo",
        "incremental_filter": f"SELECT * FROM pedidos WHERE _silver_processed_at > TIMESTAMP '{T1}'",
        "version_history": "SELECT * FROM dim_clientes WHERE id_cliente = 7 ORDER BY data_inicio_vigencia",
        "status_filter": "SELECT * FROM pedidos WHERE status_pedido = 'Concluído'",
        "fact_projection": "SELECT * EXCLUDE (_gold_processed_at) FROM fato",
        # joins
        "dim_left_join": "SELECT p.*, c.nome_categoria FROM produtos_2 p "
        "LEFT JOIN categorias c ON c.id_categoria = p.id_categoria",
        "fact_inner_join": "SELECT i.* EXCLUDE (_silver_processed_at), p.id_cliente, p.status_pedido "
        "FROM itens_pedido i JOIN pedidos p ON p.id_pedido = i.id_pedido",
        "fact_left_payments": "SELECT p.id_pedido, p.id_cliente, g.valor_total_pago_pedido, g.id_metodo "
        "FROM pedidos p LEFT JOIN pagos g ON g.id_pedido = p.id_pedido",
        "scd2_point_in_time": f"""SELECT p.id_pedido, p.id_cliente, p.data_pedido, c.sk_cliente, c.cidade,
            c.estado, c.data_inicio_vigencia AS inicio
            FROM pedidos p LEFT JOIN dim_clientes c ON {_valid('c', 'id_cliente')}""",
        "new_keys_anti": "SELECT s.* FROM snap_dim_clientes_2 s WHERE NOT EXISTS "
        "(SELECT 1 FROM dim_clientes_inicial o WHERE o.id_cliente = s.id_cliente AND o.registro_ativo)",
        "matched_inner": """SELECT s.id_produto, s.nome_produto, s.preco_base, s.nome_categoria,
            o.nome_produto AS nome_produto_anterior, o.preco_base AS preco_base_anterior,
            o.nome_categoria AS nome_categoria_anterior
            FROM snap_dim_produtos_2 s JOIN dim_produtos_inicial o ON o.id_produto = s.id_produto""",
        "sales_star_view": "SELECT * FROM vw",
        "star_inner_sample": """SELECT f.id_pedido, f.data_pedido, c.nome_cliente, d.nome_produto,
            f.valor_total_item, f.quantidade
            FROM fato f JOIN dim_clientes c ON c.sk_cliente = f.sk_cliente AND c.registro_ativo
            JOIN dim_produtos d ON d.sk_produto = f.sk_produto AND d.registro_ativo
            ORDER BY f.id_item LIMIT 5""",
        "view_fact_reconcile": f"SELECT {_revenue('receita_direta')} FROM fato "
        "WHERE id_item IN (SELECT id_item FROM concluidos)",
        # aggregations
        "payments_per_order": "SELECT * FROM pagos",
        "max_watermark": _all(
            [
                f"SELECT '{n}' AS fonte, max(_silver_processed_at) AS max_ts FROM {n}"
                for n in _TABLES[-3:]
            ]
        ),
        "batch_row_count": _counts(
            {
                "bronze": "bronze_pedidos",
                "mais_recentes": "pedidos_recentes",
                "silver": "pedidos_silver",
            }
        ),
        "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS linhas FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        "distinct_rows": "SELECT DISTINCT id_cliente, id_loja FROM pedidos",
        "count_distinct": _all(
            [
                f"SELECT '{c}' AS coluna, count(DISTINCT {c}) AS distintos FROM fato"
                for c in ("id_pedido", "sk_cliente", "id_item")
            ]
        ),
        "null_counts": _all(
            [f"SELECT '{c}' AS coluna, count(*) - count({c}) AS nulos FROM fato" for c in fact_nulls]
        ),
        # windows, set operations
        "latest_per_key": "SELECT * FROM events QUALIFY row_number() OVER "
        "(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
        "category_pareto": f"""SELECT nome_categoria, receita,
            CAST(receita AS DOUBLE) / CAST(sum(receita) OVER () AS DOUBLE) AS participacao,
            CAST(sum(receita) OVER (ORDER BY receita DESC, nome_categoria NULLS LAST
                 ROWS UNBOUNDED PRECEDING) AS DOUBLE)
              / CAST(sum(receita) OVER () AS DOUBLE) AS participacao_acumulada
            FROM (SELECT nome_categoria, {_revenue('receita')} FROM concluidos GROUP BY nome_categoria)
            ORDER BY receita DESC, nome_categoria NULLS LAST""",
        "union_changes": f"SELECT s.* FROM {client_pairs} WHERE o.id_cliente IS NULL "
        f"UNION ALL SELECT s.* FROM {client_pairs} WHERE o.id_cliente IS NOT NULL AND {changed_clients}",
        # composite operators
        "typed_cast": "SELECT * FROM pagamentos_tipados",
        "cast_loss_report": _all(
            [
                f"SELECT '{c}' AS coluna, '{t}' AS tipo, count(*) AS perdidos FROM pedidos_recentes "
                f"WHERE trim({c}) <> '' AND {cast} IS NULL"
                for c, (t, cast) in bad_cells.items()
            ]
        ),
        "quality_discard_report": f"""SELECT 'pedidos' AS tabela, count(*) AS lidas,
            count(*) FILTER (WHERE k IS NULL) AS sem_chave,
            count(*) FILTER (WHERE k IS NOT NULL AND ok = 0) AS contra_regra,
            count(*) FILTER (WHERE k IS NOT NULL AND ok = 1) AS validas,
            count(*) FILTER (WHERE k IS NULL OR ok = 0) AS descartadas
            FROM (SELECT k, {no_method} AS ok
                  FROM (SELECT {_int('id_pedido')} AS k, trim(status_pedido) AS status_pedido
                        FROM pedidos_recentes))""",
        "silver_load_report": f"""
            SELECT 'recebidas' AS medida, count(*) AS linhas FROM bronze_pedidos
            UNION ALL
            SELECT unnest(['lidas', 'sem_chave', 'contra_regra', 'validas', 'gravadas']),
                   unnest([count(*), count(*) FILTER (WHERE k IS NULL), count(*) FILTER (WHERE k IS NOT NULL AND ok = 0),
                           count(*) FILTER (WHERE k IS NOT NULL AND ok = 1), count(*) FILTER (WHERE k IS NOT NULL AND ok = 1)])
            FROM (SELECT k, {no_method} AS ok
                  FROM (SELECT {_int('id_pedido')} AS k, trim(status_pedido) AS status_pedido FROM pedidos_recentes))
            UNION ALL SELECT * FROM ({" UNION ALL ".join(
                f"SELECT 'perdidos_{c}', count(*) AS n FROM pedidos_recentes WHERE trim({c}) <> '' AND {cast} IS NULL"
                for c, (_, cast) in bad_cells.items())}) WHERE n > 0""",
        "silver_out_of_order": f"SELECT {raw_orders} FROM pedidos_silver",
        "scan_csv_quarantine": """
            SELECT concat_ws(',', id_metodo, tipo_pagamento) AS linha, 'bronze' AS destino FROM metodos_pagamento_2
            UNION ALL
            SELECT CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR)
                        ELSE concat_ws(',', o_orderkey, o_orderpriority, 'x') END, 'quarentena'
            FROM orders WHERE o_orderkey % 5 = 0""",
        "silver_build": "SELECT * FROM pedidos_silver",
        "bronze_build": _all(
            [
                f"SELECT CAST(id_vendedor AS VARCHAR) AS id_vendedor, CAST(id_loja AS VARCHAR) AS id_loja, "
                f"nome_vendedor, TIMESTAMP '{ts}' AS _ingestion_timestamp, 'vendedores' AS _source_table "
                f"FROM vendedores_{n}"
                for n, ts in ((1, T1), (2, T2))
            ]
        ),
        "upsert": "SELECT * FROM produtos_1 UNION ALL SELECT * FROM produtos_2 "
        "WHERE id_produto NOT IN (SELECT id_produto FROM produtos_1)",
        "close_versions": f"""SELECT o.* REPLACE (
              CASE WHEN s.id_cliente IS NOT NULL AND {changed_clients} THEN TIMESTAMP '{T2}' END
                AS data_fim_vigencia,
              NOT (s.id_cliente IS NOT NULL AND {changed_clients}) AS registro_ativo)
            FROM dim_clientes_inicial o
            LEFT JOIN snap_dim_clientes_2 s ON s.id_cliente = o.id_cliente""",
        "insert_missing": "SELECT * FROM dim_clientes_inicial UNION ALL SELECT "
        + _opened("s.*", f"TIMESTAMP '{T2}'", T2)
        + " FROM snap_dim_clientes_2 s WHERE id_cliente NOT IN (SELECT id_cliente FROM dim_clientes_inicial)",
        "insert_versions": "SELECT * FROM dim_lojas_inicial UNION ALL SELECT "
        + _opened("*", f"TIMESTAMP '{T2}'", T2)
        + " FROM snap_dim_lojas_2",
        "detect_changes": f"SELECT s.*, {label.format(key='id_cliente', diff=changed_clients)} AS mudanca "
        f"FROM {client_pairs}",
        "scd2_apply": _two_loads("dim_clientes", f"TIMESTAMP '{T2}'"),
        "scd2_incremental": "SELECT * FROM dim_produtos",
        "scd2_counts": _all(
            [
                f"SELECT '{n}' AS tabela, count(*) FILTER (WHERE m = 'novo') AS novos, "
                "count(*) FILTER (WHERE m = 'alterado') AS alterados, "
                "count(*) FILTER (WHERE m = 'sem_alteracao') AS sem_alteracao FROM (SELECT "
                + label.format(key=key, diff=_changed(tracked, "o", "s"))
                + f" AS m FROM snap_{n}_2 s LEFT JOIN {n}_inicial o ON o.{key} = s.{key})"
                for n, (key, _, tracked) in _DIMS.items()
            ]
        ),
        **{n: f"SELECT * FROM {n}" for n in _DIMS},
        "item_total": "SELECT id_item, quantidade, preco_unitario, "
        "CAST(quantidade * preco_unitario AS DECIMAL(38,2)) AS valor_total_item FROM itens_pedido",
        "fato_vendas": "SELECT * FROM fato",
        "fato_vendas_incremental": waves,
        "skip_when_no_orders": f"""
            SELECT 1 AS carga, count(*) AS pedidos FROM pedidos WHERE _silver_processed_at = TIMESTAMP '{T1}'
            UNION ALL
            SELECT 2, count(*) FROM pedidos WHERE _silver_processed_at = TIMESTAMP '{T2}'
            UNION ALL
            SELECT 3, count(*) FROM pedidos WHERE _silver_processed_at > TIMESTAMP '{T2}'""",
        "get_checkpoint": marks,
        "save_checkpoint": marks,
        # integrity checks
        "validate_dimension_scd2": _all(
            [
                row
                for n, (key, _, _) in _DIMS.items()
                for row in _scd2_checks(n, n, key, (key, "registro_ativo", "data_inicio_vigencia"))
            ]
        ),
        "single_active": _all(
            [
                f"SELECT '{n}' AS tabela, count(*) AS chaves_repetidas, count(*) = 0 AS passou FROM "
                f"(SELECT {key} FROM {n} WHERE registro_ativo GROUP BY {key} HAVING count(*) > 1)"
                for n, (key, _, _) in _DIMS.items()
            ]
        ),
        "validate_surrogate_key": _all(
            [row for n, (_, sk, _) in _DIMS.items() for row in _sk_checks(n, n, sk)]
        ),
        "qa_fact": _all(
            ["SELECT 'fato_vendas' AS tabela, 'tabela_nao_vazia' AS verificacao, "
             "count(*) AS medida, count(*) > 0 AS passou FROM fato",
             "SELECT 'fato_vendas', 'id_item_unico', count(*), count(*) = 0 FROM "
             "(SELECT id_item FROM fato GROUP BY id_item HAVING count(*) > 1)"]
            + [
                f"SELECT 'fato_vendas', '{n}', count(*), count(*) = 0 FROM fato WHERE {w}"
                for n, w in {
                    "valor_total_item_positivo": "valor_total_item IS NULL OR valor_total_item <= 0",
                    "sk_cliente_preenchida": "sk_cliente IS NULL",
                    "sk_produto_preenchida": "sk_produto IS NULL",
                }.items()
            ]
        ),
        "qa_initial_load": _all(
            [
                row
                for n, (key, sk, _) in _DIMS.items()
                for row in _scd2_checks(n, f"{n}_completa", key, ("registro_ativo",))
                + _sk_checks(n, f"{n}_completa", sk)
            ]
        ),
        "qa_dashboard": _dashboard_checks(),
        "silver_ready": _all(
            [
                f"SELECT 'silver_ready' AS etapa, '{n}' AS tabela, "
                "CASE WHEN count(*) > 0 THEN 'ok' ELSE 'falha' END AS situacao, "
                f"'com linhas' AS detalhe FROM {_bound(n)}"
                for n in _TABLES
                if n != "enderecos"
            ]
        ),
        "persist_and_validate": _counts({n: n for n in _DIMS}),
        # KPIs and trends
        "receita_total": f"SELECT {_revenue('receita_total')} FROM concluidos",
        "total_pedidos": "SELECT count(DISTINCT id_pedido) AS total_pedidos FROM vw",
        "ticket_medio": "SELECT coalesce(CAST(sum(valor_total_item) AS DOUBLE) "
        "/ nullif(count(DISTINCT id_pedido), 0), 0) AS ticket_medio FROM concluidos",
        "clientes_unicos": "SELECT count(DISTINCT sk_cliente) AS clientes_unicos FROM fato",
        "receita_por_categoria": f"SELECT nome_categoria, {_revenue('receita')} FROM concluidos "
        "GROUP BY nome_categoria ORDER BY receita DESC, nome_categoria",
        "receita_por_categoria_direta": f"""SELECT nome_categoria, {_revenue('receita')}
            FROM (SELECT d.nome_categoria, i.quantidade * i.preco_unitario AS valor_total_item
                  FROM itens_pedido i JOIN pedidos p ON p.id_pedido = i.id_pedido
                  LEFT JOIN snap_dim_produtos_2 d ON d.id_produto = i.id_produto
                  WHERE p.status_pedido = 'Concluído')
            GROUP BY nome_categoria ORDER BY receita DESC, nome_categoria""",
        "evolucao_mensal": f"SELECT date_trunc('month', data_pedido) AS mes, {_revenue('receita')} "
        "FROM concluidos GROUP BY mes ORDER BY mes",
        "faturamento_bruto": f"SELECT {_revenue('faturamento_bruto')} FROM fato",
        "itens_por_pedido": "SELECT CAST(count(*) AS DOUBLE) / count(DISTINCT id_pedido) "
        "AS itens_por_pedido FROM fato",
        "pedidos_por_metodo_mes": """SELECT mes, tipo_pagamento, pedidos,
            CAST(pedidos AS DOUBLE) / CAST(sum(pedidos) OVER (PARTITION BY mes) AS DOUBLE) AS participacao
            FROM (SELECT date_trunc('month', data_pedido) AS mes, tipo_pagamento,
                         count(DISTINCT id_pedido) AS pedidos
                  FROM vw GROUP BY mes, tipo_pagamento)
            ORDER BY mes, tipo_pagamento""",
        # streaming
        "stream_bronze": f"SELECT {raw_orders}, 'pedidos' AS _source_table FROM bronze_pedidos",
        "stream_silver_upsert": f"SELECT {raw_orders} FROM pedidos_silver",
        "stream_fact": "SELECT * FROM fato",
        "fato_vendas_mesmo_lote": "SELECT * FROM fato",
        "fato_vendas_chave_tardia": "SELECT * EXCLUDE (_gold_processed_at) FROM fato",
        # jobs
        "run_layer": _counts(
            {
                **{n: _bound(n) for n in _TABLES},
                "clientes": "(SELECT * FROM clientes_2 WHERE cpf IS NOT NULL AND email IS NOT NULL)",
            }
        ),
        "run_dimensions": _all(
            [
                f"SELECT 'dimensoes' AS etapa, '{n}' AS tabela, "
                f"CASE WHEN count(*) > 0 THEN 'ok' ELSE 'falha' END AS situacao FROM {n}"
                for n in _DIMS
            ]
        ),
        "run_all": f"""{_FACT_SELECT}
            FROM itens_pedido i
            JOIN pedidos p ON p.id_pedido = i.id_pedido
            LEFT JOIN pagos g ON g.id_pedido = p.id_pedido
            LEFT JOIN (SELECT s.* FROM snap_dim_clientes_2 s JOIN clientes_2 k ON k.id_cliente = s.id_cliente
                       WHERE k.cpf IS NOT NULL AND k.email IS NOT NULL) c ON c.id_cliente = p.id_cliente
            LEFT JOIN snap_dim_lojas_2 l ON l.id_loja = p.id_loja
            LEFT JOIN snap_dim_vendedores_2 v ON v.id_vendedor = p.id_vendedor
            LEFT JOIN snap_dim_produtos_2 d ON d.id_produto = i.id_produto
            LEFT JOIN snap_dim_metodos_pagamento_2 m ON m.id_metodo = g.id_metodo""",
    }
    return {name: _sql(body) for name, body in bodies.items()}
