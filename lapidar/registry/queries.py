"""One callable (spark, sf_dir) -> DataFrame per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from lapidar.operators import checks, scd2
from lapidar.operators.control import LAYER, get_checkpoint, save_checkpoint
from lapidar.operators.dedup import distinct_rows, latest_per_key, newest_first
from lapidar.operators.facts import (
    fact_projection,
    incremental_filter,
    items_of_orders,
    max_watermark,
    payments_per_order,
    point_in_time_join,
    with_item_total,
    with_payments,
)
from lapidar.operators.ingest import bronze_audit, processed_at
from lapidar.operators.merge import upsert
from lapidar.operators.rules import (
    ORDER_STATUS,
    apply_table_rule,
    drop_null_key,
    in_set,
    normalized,
    not_null,
    positive,
    quality_discard_report,
)
from lapidar.operators.skew import hot_keys
from lapidar.operators.typing import cast_loss_report, typed_cast
from lapidar.plans import jobs, kpis
from lapidar.plans.dashboard_checks import VIEW_CATEGORIES, VIEW_LINES, qa_dashboard, view_fact_revenue
from lapidar.plans.dimensions import DIMENSIONS, dim_left_join, dim_projection
from lapidar.plans.sales import (
    FACT,
    VIEW,
    VIEW_SQL,
    build_fact,
    gold_row_counts,
    register_views,
    run_sql_script,
    sales_lines,
    sales_star_view,
    star_inner_sample,
    star_rows,
    with_attributes,
)
from lapidar.plans.silver import latest_bronze, silver_build
from lapidar.registry.gold_data import gold, waves
from lapidar.session import apply_settings, scratch_dir
from lapidar.sources.lake import Lake
from lapidar.sources.landing import MALFORMED, assert_not_empty, landing_path, read_landing, write_landing
from lapidar.sources.retail_binding import (
    FACT_LOAD,
    FIRST_LOAD,
    SECOND_LOAD,
    RetailTables,
)
from lapidar.sources.schemas import PROCESSING_ORDER, raw_schema, table_schema
from lapidar.streaming.streams import stream_bronze, stream_fact, stream_silver_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Item ids of the bound tables are hashes.
KEY_TYPES = {"id_item": "string"}
ALL_SOURCES = ("pedidos", "itens_pedido", "pagamentos_pedido")


def query(name: str) -> Callable[[Callable[[RetailTables], DataFrame]], Query]:
    """Register a query; its timestamps come out free of time zones."""

    def register(build: Callable[[RetailTables], DataFrame]) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            df = build(RetailTables(spark, sf_dir))
            zoned = {f.name for f in df.schema if isinstance(f.dataType, TimestampType)}
            if not zoned:
                return df
            return df.select(
                *[
                    F.col(c).cast("timestamp_ntz").alias(c) if c in zoned else F.col(c)
                    for c in df.columns
                ]
            )

        QUERIES[name] = run
        return run

    return register


def _new_lake(t: RetailTables, name: str) -> Lake:
    return Lake(t.spark, scratch_dir(t.spark, name))


def _first_dimension(t: RetailTables, name: str) -> DataFrame:
    dim = DIMENSIONS[name]
    return scd2.scd2_apply(None, t.snapshot(name, 1), dim.key, dim.tracked, FIRST_LOAD)


def _view(t: RetailTables) -> DataFrame:
    g = gold(t.spark, t.sf_dir)
    return jobs.shown(g.lake, lambda fact: sales_star_view(fact, g.dims), _new_lake(t, "view"), VIEW)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- scans, sources, sinks -------------------------------------------------------------


@query("scan_csv_raw")
def _scan_csv_raw(t):
    root = scratch_dir(t.spark, "landing")
    write_landing(t.bronze_orders().select(*raw_schema("pedidos").names), root, "pedidos")
    return read_landing(t.spark, root, "pedidos")


@query("extract_table")
def _extract_table(t):
    return assert_not_empty(t.source("customer"), "customer")


@query("sink_csv_landing")
def _sink_csv_landing(t):
    """The second extraction replaces the first."""
    root = scratch_dir(t.spark, "landing")
    for snapshot in (1, 2):
        write_landing(t.table("produtos", snapshot), root, "produtos")
    return read_landing(t.spark, root, "produtos")


@query("read_layer")
def _read_layer(t):
    lake = _new_lake(t, "layer")
    lake.publish(t.table("clientes"), "silver", "clientes")
    return lake.read("silver", "clientes")


@query("assert_not_empty")
def _assert_not_empty(t):
    tables = {n: assert_not_empty(t.table(n), n) for n in PROCESSING_ORDER}
    return checks.row_counts(tables)


@query("sink_append")
def _sink_append(t):
    lake = _new_lake(t, "append")
    for snapshot in (1, 2):
        lake.append(t.table("vendedores", snapshot), "bronze", "vendedores")
    return lake.read("bronze", "vendedores")


@query("sink_overwrite")
def _sink_overwrite(t):
    lake = _new_lake(t, "overwrite")
    for snapshot in (1, 2):
        lake.publish(t.table("vendedores", snapshot), "silver", "vendedores")
    return lake.read("silver", "vendedores")


@query("table_exists")
def _table_exists(t):
    """Rows of each gold table; a table nobody wrote does not exist."""
    lake = gold(t.spark, t.sf_dir).lake
    there = [n for n in (*DIMENSIONS, FACT, "fato_estoque") if lake.exists("gold", n)]
    return checks.row_counts({n: lake.read("gold", n) for n in there})


@query("local_rows")
def _local_rows(t):
    """Literal rows as lookup of all orders; an empty frame of the same schema adds nothing."""
    names = t.spark.createDataFrame(
        list(zip("FOP", ORDER_STATUS)), "o_orderstatus string, status_pedido string"
    )
    orders = t.source("orders").select("o_orderkey", "o_orderstatus")
    return orders.unionByName(orders.limit(0)).join(names, "o_orderstatus")


@query("compact_table")
def _compact_table(t):
    lake = _new_lake(t, "compact")
    rows = t.dimension("dim_clientes").repartition(16)
    lake.publish(rows, "gold", "dim_clientes")
    lake.compact("gold", "dim_clientes")
    return lake.read("gold", "dim_clientes")


@query("register_views")
def _register_views(t):
    g = gold(t.spark, t.sf_dir)
    register_views(t.spark, g.fact, g.dims)
    return t.spark.table("dim_vendedores")


@query("load_sql_views")
def _load_sql_views(t):
    g = gold(t.spark, t.sf_dir)

    def view(fact: DataFrame) -> DataFrame:
        register_views(t.spark, fact, g.dims)
        run_sql_script(t.spark, VIEW_SQL)
        return t.spark.table(VIEW)

    rows = jobs.shown(g.lake, view, _new_lake(t, "view"), VIEW)
    view(g.fact)  # what stays registered is the view of all months
    return rows


@query("gold_row_counts")
def _gold_row_counts(t):
    g = gold(t.spark, t.sf_dir)
    register_views(t.spark, g.fact, g.dims)
    return gold_row_counts(t.spark, [*DIMENSIONS, FACT])


# -- projections, filters, predicates --------------------------------------------------


def _landed(t: RetailTables, table: str) -> DataFrame:
    root = scratch_dir(t.spark, "landing")
    write_landing(t.table(table), root, table)
    return read_landing(t.spark, root, table)


@query("bronze_audit")
def _bronze_audit(t):
    rows = bronze_audit(_landed(t, "clientes"), "clientes", FIRST_LOAD)
    folder = F.regexp_extract("_source_file", r"([^/]+)/[^/]+$", 1)
    return rows.withColumn("_source_file", folder)


@query("processed_at")
def _processed_at(t):
    return processed_at(t.table("clientes"), "_silver_processed_at", SECOND_LOAD)


@query("dim_projection")
def _dim_projection(t):
    return dim_projection(
        t.table("produtos"), "id_produto", "sk_produto", nome="nome_produto", preco="preco_base"
    )


def _typed_orders(t: RetailTables) -> DataFrame:
    return typed_cast(t.bronze_orders(), table_schema("pedidos")).drop("_source_table")


@query("drop_null_key")
def _drop_null_key(t):
    return drop_null_key(_typed_orders(t), "id_pedido")


@query("rule_not_null")
def _rule_not_null(t):
    return not_null("cpf", "email").apply(t.table("clientes"))


@query("rule_in_set")
def _rule_in_set(t):
    return in_set("status_pedido", ORDER_STATUS).apply(_typed_orders(t))


@query("rule_positive")
def _rule_positive(t):
    typed = typed_cast(t.bronze_payments(), table_schema("pagamentos_pedido"))
    return positive("valor_pago").apply(typed).drop("_source_table")


@query("rule_normalize")
def _rule_normalize(t):
    return normalized("estado_loja").apply(t.table("lojas"))


@query("rule_registry")
def _rule_registry(t):
    """Rows each table keeps under its own rule."""
    frames = {n: t.table(n) for n in PROCESSING_ORDER}
    frames["pedidos"] = _typed_orders(t)
    return checks.row_counts({n: apply_table_rule(df, n) for n, df in frames.items()})


@query("active_only")
def _active_only(t):
    return scd2.active_only(gold(t.spark, t.sf_dir).dims["dim_produtos"])


@query("incremental_filter")
def _incremental_filter(t):
    return incremental_filter(t.table("pedidos"), "_silver_processed_at", FIRST_LOAD)


@query("version_history")
def _version_history(t):
    return scd2.version_history(gold(t.spark, t.sf_dir).dims["dim_clientes"], "id_cliente", 7)


@query("status_filter")
def _status_filter(t):
    return kpis.completed(t.table("pedidos"))


@query("fact_projection")
def _fact_projection(t):
    return fact_projection(_fused_fact(t))


# -- joins -----------------------------------------------------------------------------


@query("dim_left_join")
def _dim_left_join(t):
    return dim_left_join(t.table("produtos"), t.table("categorias"), "id_categoria", "nome_categoria")


@query("fact_inner_join")
def _fact_inner_join(t):
    orders = t.table("pedidos").select("id_pedido", "id_cliente", "status_pedido")
    items = t.table("itens_pedido").drop("_silver_processed_at")
    return items_of_orders(items, orders, hot_keys(items, "id_pedido"))


@query("fact_left_payments")
def _fact_left_payments(t):
    orders = t.table("pedidos").select("id_pedido", "id_cliente")
    joined = with_payments(orders, t.table("pagamentos_pedido"))
    return joined.withColumn(
        "valor_total_pago_pedido", F.col("valor_total_pago_pedido").cast("decimal(38,2)")
    )


@query("scd2_point_in_time")
def _scd2_point_in_time(t):
    """City and validity start of the client version at the order date."""
    dim = t.dimension("dim_clientes").withColumn("inicio", F.col(scd2.START))
    orders = t.table("pedidos").select("id_pedido", "id_cliente", "data_pedido")
    return point_in_time_join(
        orders, dim, "id_cliente", "data_pedido", "sk_cliente", "cidade", "estado", "inicio"
    )


@query("new_keys_anti")
def _new_keys_anti(t):
    dim = _first_dimension(t, "dim_clientes")
    return scd2.new_keys(dim, t.snapshot("dim_clientes", 2), "id_cliente")


@query("matched_inner")
def _matched_inner(t):
    dim = _first_dimension(t, "dim_produtos")
    tracked = DIMENSIONS["dim_produtos"].tracked
    return scd2.matched_pairs(dim, t.snapshot("dim_produtos", 2), "id_produto", tracked)


@query("sales_star_view")
def _sales_star_view(t):
    return _view(t)


@query("star_inner_sample")
def _star_inner_sample(t):
    g = gold(t.spark, t.sf_dir)
    return star_inner_sample(g.fact, g.dims)


@query("view_fact_reconcile")
def _view_fact_reconcile(t):
    g = gold(t.spark, t.sf_dir)
    return view_fact_revenue(g.fact, star_rows(g.fact, g.dims, "id_item", "status_pedido"))


# -- aggregations ----------------------------------------------------------------------


@query("payments_per_order")
def _payments_per_order(t):
    paid = payments_per_order(t.table("pagamentos_pedido"))
    return paid.withColumn(
        "valor_total_pago_pedido", F.col("valor_total_pago_pedido").cast("decimal(38,2)")
    )


@query("max_watermark")
def _max_watermark(t):
    return _union(
        [
            max_watermark(t.table(n), "_silver_processed_at").select(F.lit(n).alias("fonte"), "max_ts")
            for n in ALL_SOURCES
        ]
    )


@query("batch_row_count")
def _batch_row_count(t):
    bronze = t.bronze_orders()
    return checks.row_counts(
        {
            "bronze": bronze,
            "mais_recentes": latest_bronze(bronze, "pedidos"),
            "silver": silver_build(bronze, "pedidos", SECOND_LOAD),
        }
    )


@query("duplicate_keys")
def _duplicate_keys(t):
    return checks.duplicate_keys(t.source("lineitem"), "l_orderkey", "l_linenumber")


@query("distinct_rows")
def _distinct_rows(t):
    return distinct_rows(t.table("pedidos").select("id_cliente", "id_loja"))


@query("count_distinct")
def _count_distinct(t):
    fact = gold(t.spark, t.sf_dir).fact
    return checks.distinct_counts(fact, ["id_pedido", "sk_cliente", "id_item"])


@query("null_counts")
def _null_counts(t):
    return checks.null_counts(gold(t.spark, t.sf_dir).fact)


# -- windows, sorts, set operations ----------------------------------------------------


@query("latest_per_key")
def _latest_per_key(t):
    events = t.source("events")
    return latest_per_key(events, "user_id", newest_first(events, "ts", "event_id"))


@query("union_changes")
def _union_changes(t):
    dim = _first_dimension(t, "dim_clientes")
    tracked = DIMENSIONS["dim_clientes"].tracked
    labelled = scd2.detect_changes(dim, t.snapshot("dim_clientes", 2), "id_cliente", tracked)
    return scd2.union_changes(labelled)


# -- composite operators ---------------------------------------------------------------


@query("typed_cast")
def _typed_cast(t):
    typed = typed_cast(t.bronze_payments(), table_schema("pagamentos_pedido"))
    return typed.drop("_source_table")


@query("cast_loss_report")
def _cast_loss_report(t):
    """Values lost among the latest version of each order."""
    latest = latest_bronze(t.bronze_orders(), "pedidos")
    return cast_loss_report(latest, table_schema("pedidos"))


@query("quality_discard_report")
def _quality_discard_report(t):
    latest = latest_bronze(t.bronze_orders(), "pedidos")
    typed = typed_cast(latest, table_schema("pedidos"))
    return quality_discard_report(typed, "pedidos", "id_pedido")


@query("silver_build")
def _silver_build(t):
    return silver_build(t.bronze_orders(), "pedidos", SECOND_LOAD)


@query("silver_load_report")
def _silver_load_report(t):
    """What the silver load itself says about two batches of raw orders, without a scan of its own."""
    lake = _new_lake(t, "silver")
    lake.append(t.bronze_orders(), "bronze", "pedidos", "b1")
    report = jobs.load_silver(lake, "pedidos", SECOND_LOAD)
    counts = {k: v for k, v in asdict(report).items() if k != "perdidos"}
    rows = [*counts.items(), *((f"perdidos_{c}", n) for c, n in report.perdidos.items())]
    return t.spark.createDataFrame(rows, "medida string, linhas bigint")


@query("silver_out_of_order")
def _silver_out_of_order(t):
    """Raw orders in three bronze batches that arrive against the order of their times; silver has all."""
    lake, rows = _new_lake(t, "silver"), t.bronze_orders()
    late = F.col("_ingestion_timestamp") == F.lit(SECOND_LOAD).cast("timestamp")
    repeated = F.col("_source_file") == "carga-3"
    for label, batch in (("b3", late), ("b1", ~late & repeated), ("b2", ~late & ~repeated)):
        lake.append(rows.filter(batch), "bronze", "pedidos", label)
        jobs.load_silver(lake, "pedidos", SECOND_LOAD)
    return lake.read("silver", "pedidos").select(*table_schema("pedidos").names)


@query("scan_csv_quarantine")
def _scan_csv_quarantine(t):
    """Landing rows with a field too many or too few: their text and file's table, beside the batch's good rows."""
    root, lake = scratch_dir(t.spark, "landing"), _new_lake(t, "bronze")
    key = F.col("id_metodo").cast("string")
    lines = t.table("metodos_pagamento").select(F.concat_ws(",", key, "tipo_pagamento").alias("linha"))
    orders = t.source("orders").select("o_orderkey", "o_orderpriority")
    broken = orders.filter("o_orderkey % 5 = 0").select(
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string"))
        .otherwise(F.concat_ws(",", "o_orderkey", "o_orderpriority", F.lit("x")))
        .alias("linha")
    )
    # whole lines as one column, named like the header: no file's writer touches their commas
    landed = lines.unionByName(broken).withColumnRenamed("linha", "id_metodo,tipo_pagamento")
    landed.write.option("header", True).option("sep", "\u0001").csv(landing_path(root, "metodos_pagamento"))
    jobs.load_bronze(lake, root, "metodos_pagamento", FIRST_LOAD)
    good = lake.read("bronze", "metodos_pagamento").select(F.concat_ws(",", "id_metodo", "tipo_pagamento").alias("linha"), F.lit("bronze").alias("destino"))
    bad = lake.read("bronze", jobs.quarantine_of("metodos_pagamento"))
    return good.unionByName(bad.select(F.col(MALFORMED).alias("linha"), F.lit("quarentena").alias("destino")))


@query("bronze_build")
def _bronze_build(t):
    """Two loads of the landing folder accumulate."""
    root = scratch_dir(t.spark, "landing")
    lake = _new_lake(t, "bronze")
    for snapshot, batch_ts in ((1, FIRST_LOAD), (2, SECOND_LOAD)):
        write_landing(t.table("vendedores", snapshot), root, "vendedores")
        jobs.load_bronze(lake, root, "vendedores", batch_ts)
    return lake.read("bronze", "vendedores").drop("_source_file")


@query("upsert")
def _upsert(t):
    """Rows of the earlier state replace the later ones; keys only in the later state stay."""
    return upsert(t.table("produtos", 2), t.table("produtos", 1), "id_produto")


@query("close_versions")
def _close_versions(t):
    dim = _first_dimension(t, "dim_clientes")
    tracked = DIMENSIONS["dim_clientes"].tracked
    labelled = scd2.detect_changes(dim, t.snapshot("dim_clientes", 2), "id_cliente", tracked)
    changed = labelled.filter(F.col(scd2.CHANGE) == scd2.CHANGED)
    return scd2.close_versions(dim, changed, "id_cliente", SECOND_LOAD)


@query("insert_missing")
def _insert_missing(t):
    dim = _first_dimension(t, "dim_clientes")
    return scd2.insert_missing(dim, t.snapshot("dim_clientes", 2), "id_cliente", SECOND_LOAD)


@query("insert_versions")
def _insert_versions(t):
    dim = _first_dimension(t, "dim_lojas")
    return scd2.insert_versions(dim, t.snapshot("dim_lojas", 2), SECOND_LOAD)


@query("detect_changes")
def _detect_changes(t):
    dim = _first_dimension(t, "dim_clientes")
    tracked = DIMENSIONS["dim_clientes"].tracked
    return scd2.detect_changes(dim, t.snapshot("dim_clientes", 2), "id_cliente", tracked)


@query("scd2_apply")
def _scd2_apply(t):
    """The mode in which keys first seen in a later load start with that load."""
    dim = DIMENSIONS["dim_clientes"]
    first = _first_dimension(t, "dim_clientes")
    later = t.snapshot("dim_clientes", 2)
    return scd2.scd2_apply(first, later, dim.key, dim.tracked, SECOND_LOAD, None)


@query("scd2_incremental")
def _scd2_incremental(t):
    dim = DIMENSIONS["dim_produtos"]
    first = _first_dimension(t, "dim_produtos")
    later = t.snapshot("dim_produtos", 2)
    return scd2.scd2_incremental(first, later, dim.key, dim.tracked, SECOND_LOAD)


@query("scd2_counts")
def _scd2_counts(t):
    counts = []
    for name, dim in DIMENSIONS.items():
        first = _first_dimension(t, name)
        labelled = scd2.detect_changes(first, t.snapshot(name, 2), dim.key, dim.tracked)
        counts.append(scd2.change_counts(labelled).select(F.lit(name).alias("tabela"), "*"))
    return _union(counts)


def _dimension_query(name: str) -> None:
    def build(t: RetailTables) -> DataFrame:
        return t.dimension(name)

    query(name)(build)


for _name in DIMENSIONS:
    _dimension_query(_name)


@query("item_total")
def _item_total(t):
    items = t.table("itens_pedido").select("id_item", "quantidade", "preco_unitario")
    return with_item_total(items).withColumn(
        "valor_total_item", F.col("valor_total_item").cast("decimal(38,2)")
    )


def _fused_fact(t: RetailTables) -> DataFrame:
    """From the given tables and the written dimensions to the fact: Spark knows their sizes."""
    orders, items, payments = [t.table(n) for n in ALL_SOURCES]
    hot = hot_keys(items, "id_pedido")
    fact = build_fact(orders, items, payments, gold(t.spark, t.sf_dir).dims, FACT_LOAD, hot)
    return _plain_money(fact)


def _plain_money(fact: DataFrame) -> DataFrame:
    money = ("valor_total_item", "valor_total_pago_pedido")
    return fact.withColumns({c: F.col(c).cast("decimal(38,2)") for c in money})


@query("fato_vendas")
def _fato_vendas(t):
    return _fused_fact(t)


@query("fato_vendas_incremental")
def _fato_vendas_incremental(t):
    """Two loads: the second brings further orders and changed dimensions."""
    lake = waves(t.spark, t.sf_dir).lake
    return _plain_money(lake.read("gold", FACT))


@query("fato_vendas_mesmo_lote")
def _fato_vendas_mesmo_lote(t):
    """Silver takes the raw sales in two batches stamped alike, with a fact load after each."""
    lake = _raw_sales(t)
    odd = F.pmod(F.xxhash64("id_pedido"), F.lit(2))
    bronze = {n: lake.read("bronze", n) for n in ALL_SOURCES}
    staged = _new_lake(t, "stage")
    for name in DIMENSIONS:
        staged.publish(t.dimension(name), "gold", name)
    for part in (0, 1):
        for name in ALL_SOURCES:
            staged.append(bronze[name].filter(odd == part), "bronze", name, f"b{part}")
            jobs.load_silver(staged, name, SECOND_LOAD, KEY_TYPES)
        jobs.load_fact(staged, FACT_LOAD)
    return _plain_money(staged.read("gold", FACT))


@query("fato_vendas_chave_tardia")
def _fato_vendas_chave_tardia(t):
    """The fact is loaded while one client in seven and one product in eleven are unknown, and again once they are there."""
    lake = _new_lake(t, "late")
    for name in ALL_SOURCES:
        lake.publish(t.table(name), "silver", name)
    unknown = {"dim_clientes": "id_cliente % 7 = 0", "dim_produtos": "id_produto % 11 = 0"}
    for name in DIMENSIONS:
        rows = t.dimension(name)
        lake.publish(rows.filter(f"NOT {unknown[name]}") if name in unknown else rows, "gold", name)
    jobs.load_fact(lake, SECOND_LOAD)
    for name in unknown:
        lake.publish(t.dimension(name), "gold", name)
    jobs.load_fact(lake, FACT_LOAD)
    return _plain_money(lake.read("gold", FACT)).drop("_gold_processed_at")


@query("skip_when_no_orders")
def _skip_when_no_orders(t):
    """Orders rebuilt by three loads; the last one finds nothing new and writes nothing."""
    rebuilt = waves(t.spark, t.sf_dir).rebuilt
    rows = [(i + 1, n) for i, n in enumerate(rebuilt)]
    return t.spark.createDataFrame(rows, "carga int, pedidos bigint")


@query("save_checkpoint")
def _save_checkpoint(t):
    """The second save replaces the first."""
    lake = _new_lake(t, "control")
    tops = _union(
        [
            max_watermark(t.table(n), "_silver_processed_at").select(
                F.lit(n).alias("fonte"), F.col("max_ts").cast("string").alias("marca")
            )
            for n in ALL_SOURCES
        ]
    )
    save_checkpoint(lake, FACT, get_checkpoint(lake, FACT, ALL_SOURCES))
    save_checkpoint(lake, FACT, {r["fonte"]: r["marca"] for r in tops.collect()})
    return lake.read(LAYER, FACT).select("fonte", "marca")


@query("get_checkpoint")
def _get_checkpoint(t):
    """Watermarks after the loads, as the next load reads them."""
    lake = waves(t.spark, t.sf_dir).lake
    marks = get_checkpoint(lake, FACT, ALL_SOURCES)
    stored = lake.read(LAYER, FACT).select("fonte", "marca")
    return stored.filter(F.col("fonte").isin(*marks))


# -- integrity checks --------------------------------------------------------------------


@query("validate_dimension_scd2")
def _validate_dimension_scd2(t):
    dims = gold(t.spark, t.sf_dir).dims
    return _union([checks.dimension_scd2(dims[n], n, d.key) for n, d in DIMENSIONS.items()])


@query("single_active")
def _single_active(t):
    dims = gold(t.spark, t.sf_dir).dims
    return _union(
        [
            checks.single_active(dims[n], d.key).select(F.lit(n).alias("tabela"), "*")
            for n, d in DIMENSIONS.items()
        ]
    )


@query("validate_surrogate_key")
def _validate_surrogate_key(t):
    """Versions share their surrogate key, so changed dimensions report repeated ones."""
    dims = gold(t.spark, t.sf_dir).dims
    return _union(
        [checks.surrogate_key_check(dims[n], n, d.surrogate) for n, d in DIMENSIONS.items()]
    )


@query("qa_fact")
def _qa_fact(t):
    return checks.fact_quality(gold(t.spark, t.sf_dir).fact)


@query("qa_initial_load")
def _qa_initial_load(t):
    return _union(
        [
            checks.initial_load(
                scd2.scd2_apply(None, t.snapshot(n, 2), d.key, d.tracked, SECOND_LOAD), n, d.key, d.surrogate
            )
            for n, d in DIMENSIONS.items()
        ]
    )


@query("qa_dashboard")
def _qa_dashboard(t):
    g = gold(t.spark, t.sf_dir)
    return qa_dashboard(g.fact, sales_star_view(g.fact, g.dims, *VIEW_CATEGORIES), sales_star_view(g.fact, g.dims, *VIEW_LINES))


@query("silver_ready")
def _silver_ready(t):
    return jobs.silver_ready(waves(t.spark, t.sf_dir).lake)


@query("persist_and_validate")
def _persist_and_validate(t):
    lake = _new_lake(t, "persist")
    for name in DIMENSIONS:
        lake.publish(t.dimension(name), "gold", name)
    ok = [n for n in DIMENSIONS if jobs.persist_and_validate(lake, n)]
    return checks.row_counts({n: lake.read("gold", n) for n in ok})


# -- KPIs and trends ---------------------------------------------------------------------


def _kpi(name: str, measure: Callable[[DataFrame], DataFrame], *dimensions: str) -> None:
    def build(t: RetailTables) -> DataFrame:
        g = gold(t.spark, t.sf_dir)
        return measure(with_attributes(g.fact, g.dims, *dimensions))

    query(name)(build)


_kpi("receita_total", kpis.total_revenue)
_kpi("total_pedidos", kpis.total_orders)
_kpi("ticket_medio", kpis.average_ticket)
_kpi("clientes_unicos", kpis.unique_clients)
_kpi("receita_por_categoria", kpis.revenue_by_category, "dim_produtos")
_kpi("evolucao_mensal", kpis.monthly_revenue)
_kpi("faturamento_bruto", kpis.gross_revenue)
_kpi("itens_por_pedido", kpis.items_per_order)
_kpi("pedidos_por_metodo_mes", kpis.orders_by_method_and_month, "dim_metodos_pagamento")
_kpi("category_pareto", kpis.category_pareto, "dim_produtos")


@query("receita_por_categoria_direta")
def _receita_por_categoria_direta(t):
    """From the given tables to revenue by category in one plan: only the product
    dimension takes part, because the measure reads nothing else."""
    products = t.snapshot("dim_produtos", 2).select("id_produto", "nome_categoria")
    lines = sales_lines(t.table("pedidos"), t.table("itens_pedido"))
    return kpis.revenue_by_category(lines.join(products, "id_produto", "left"))


# -- streaming ---------------------------------------------------------------------------


def _run(stream) -> None:
    stream.awaitTermination()


@query("stream_bronze")
def _stream_bronze(t):
    """The second run finds no new file and adds nothing."""
    root, lake = scratch_dir(t.spark, "landing"), _new_lake(t, "stream")
    write_landing(t.bronze_orders().select(*raw_schema("pedidos").names), root, "pedidos")
    for _ in range(2):
        _run(stream_bronze(lake, root, "pedidos", f"{lake.root}/checkpoints"))
    return lake.read("bronze", "pedidos").select(*raw_schema("pedidos").names, "_source_table")


@query("stream_silver_upsert")
def _stream_silver_upsert(t):
    lake = _new_lake(t, "stream")
    lake.append(t.bronze_orders(), "bronze", "pedidos")
    for _ in range(2):
        _run(stream_silver_upsert(lake, "pedidos", f"{lake.root}/checkpoints"))
    return lake.read("silver", "pedidos").select(*table_schema("pedidos").names)


def _raw_sales(t: RetailTables) -> Lake:
    """Dimensions, and the sales as one raw bronze batch for each table."""
    lake = _new_lake(t, "stream")
    for name in DIMENSIONS:
        lake.publish(t.dimension(name), "gold", name)
    for name in ALL_SOURCES:
        columns = raw_schema(name).names
        rows = t.table(name).select(*[F.col(c).cast("string").alias(c) for c in columns])
        audit = {
            "_ingestion_timestamp": F.lit(FIRST_LOAD).cast("timestamp"),
            "_source_file": F.lit("carga-1"),
            "_source_table": F.lit(name),
        }
        lake.append(rows.withColumns(audit), "bronze", name)
    return lake


@query("stream_fact")
def _stream_fact(t):
    """Raw orders, items and payments to the fact; dimensions are there already."""
    lake = _raw_sales(t)
    clock = lambda: FACT_LOAD
    for _ in range(2):
        _run(stream_fact(lake, f"{lake.root}/checkpoints", KEY_TYPES, clock))
    return _plain_money(lake.read("gold", FACT))


# -- jobs --------------------------------------------------------------------------------


def _land_everything(t: RetailTables, root: str) -> None:
    for name in PROCESSING_ORDER:
        write_landing(t.table(name).select(*raw_schema(name).names), root, name)


@query("run_layer")
def _run_layer(t):
    """Bronze and silver for all ten tables; rows per silver table."""
    root, lake = scratch_dir(t.spark, "landing"), _new_lake(t, "run")
    _land_everything(t, root)
    for stage in ("bronze", "silver"):
        report = jobs.run_layer(lake, stage, SECOND_LOAD, root, KEY_TYPES)
        if jobs.failures(report):
            raise RuntimeError(f"{stage}: {jobs.failures(report)}")
    return checks.row_counts({n: lake.read("silver", n) for n in PROCESSING_ORDER})


@query("run_dimensions")
def _run_dimensions(t):
    """Status per dimension of a second run over unchanged silver tables."""
    return jobs.run_dimensions(waves(t.spark, t.sf_dir).lake, FACT_LOAD).drop("detalhe")


@query("run_all")
def _run_all(t):
    """CSV landing files to the fact, twice; the second run repeats no row."""
    root, lake = scratch_dir(t.spark, "landing"), _new_lake(t, "run")
    _land_everything(t, root)
    for batch_ts in (FIRST_LOAD, SECOND_LOAD):
        report = jobs.run_all(lake, root, batch_ts, KEY_TYPES)
        if jobs.failures(report):
            raise RuntimeError(f"failed: {jobs.failures(report)}")
    return _plain_money(lake.read("gold", FACT)).drop("_gold_processed_at")
