"""The retail tables derived from the driver's order tables.

``snapshot`` selects one of two states of the master data: between the first and the
second load some rows change, some attributes become NULL and some keys appear.
All rules are arithmetic on keys, so SQL can state the same tables independently.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.functions.expressions import at
from lapidar.operators.rules import ORDER_STATUS
from lapidar.operators.scd2 import scd2_apply
from lapidar.plans.dimensions import DIMENSIONS

# Literal batch times: results do not depend on when a query runs.
FIRST_LOAD = "1997-01-01 00:00:00"
SECOND_LOAD = "1998-06-01 00:00:00"
FACT_LOAD = "2002-01-01 00:00:00"

STORES = 25  # stores are nations

# The columns of the given tables.
SOURCES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


class RetailTables:
    """Silver tables, dimensions and fact inputs over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        """A given table; its declared schema spares Spark a job that reads file footers."""
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str, snapshot: int = 2) -> DataFrame:
        build = getattr(self, f"_{name}")
        fixed = {"categorias", "pedidos", "itens_pedido", "pagamentos_pedido"}
        return build() if name in fixed else build(snapshot)

    # -- master data -------------------------------------------------------------

    def _categorias(self) -> DataFrame:
        types = self.source("part").select("p_type").distinct()
        return types.select(
            _category_id("p_type").alias("id_categoria"), F.col("p_type").alias("nome_categoria")
        )

    def _produtos(self, snapshot: int) -> DataFrame:
        key = F.col("p_partkey")
        price = F.col("p_retailprice").cast("decimal(10,2)")
        category = _category_id("p_type")
        if snapshot == 2:
            price = F.when(key % 7 == 0, price + F.lit(10).cast("decimal(10,2)")).otherwise(price)
            category = F.when(key % 11 != 0, category)
        return _known(self.source("part"), key, snapshot).select(
            key.alias("id_produto"),
            category.alias("id_categoria"),
            F.col("p_name").alias("nome_produto"),
            price.cast("decimal(10,2)").alias("preco_base"),
        )

    def _clientes(self, snapshot: int) -> DataFrame:
        key = F.col("c_custkey")
        return _known(self.source("customer"), key, snapshot).select(
            key.alias("id_cliente"),
            F.col("c_name").alias("nome_completo"),
            F.when(key % 10 != 3, F.lpad(key.cast("string"), 11, "0")).alias("cpf"),
            F.when(key % 20 != 1, F.concat("c_name", F.lit("@x"))).alias("email"),
            F.lit("1994-12-31").cast("date").alias("data_cadastro"),
        )

    def _enderecos(self, snapshot: int) -> DataFrame:
        """Most clients have one address, some an older one too."""
        key, nation = F.col("c_custkey"), F.col("c_nationkey")
        if snapshot == 2:
            nation = _moved(key, nation)
        older = F.col("idade") == 1
        city = F.when(key % 11 != 0, F.col("n_name")) if snapshot == 2 else F.col("n_name")
        return (
            _known(self.source("customer"), key, snapshot)
            .select(
                key,
                nation.alias("n_nationkey"),
                F.explode(
                    F.when(key % 9 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
                ).alias("idade"),
            )
            .join(self._places(), "n_nationkey")
            .select(
                (key * 2 + F.lit(1) - F.col("idade")).alias("id_endereco"),
                key.alias("id_cliente"),
                F.when(older, "ANTES").otherwise(F.col("r_name")).alias("estado"),
                F.when(older, "ANTIGA").otherwise(city).alias("cidade"),
            )
        )

    def _places(self) -> DataFrame:
        nations = self.source("nation").withColumnRenamed("n_regionkey", "r_regionkey")
        return nations.join(self.source("region"), "r_regionkey").select(
            "n_nationkey", "n_name", "r_name"
        )

    def _lojas(self, snapshot: int) -> DataFrame:
        nation = F.col("n_nationkey")
        region = F.col("n_regionkey")
        if snapshot == 2:
            region = F.when(nation % 7 == 0, (region + 1) % 5).otherwise(region)
        rows = self.source("nation").select(nation, "n_name", region.alias("r_regionkey"))
        if snapshot == 1:
            rows = rows.filter(nation != STORES - 1)
        return rows.join(self.source("region"), "r_regionkey").select(
            nation.alias("id_loja"),
            F.col("n_name").alias("nome_loja"),
            F.concat(F.lit(" "), F.lower("r_name"), F.lit(" ")).alias("estado_loja"),
        )

    def _vendedores(self, snapshot: int) -> DataFrame:
        key, store = F.col("s_suppkey"), F.col("s_nationkey")
        if snapshot == 2:
            store = _moved(key, store)
        return _known(self.source("supplier"), key, snapshot).select(
            key.alias("id_vendedor"), store.alias("id_loja"), F.col("s_name").alias("nome_vendedor")
        )

    def _metodos_pagamento(self, snapshot: int) -> DataFrame:
        name = F.col("o_orderpriority")
        number = _method_id(name)
        if snapshot == 2:
            label = F.when(number == 3, F.concat(name, F.lit(" (novo)"))).otherwise(name)
        else:
            label = name
        rows = self.source("orders").select("o_orderpriority").distinct()
        if snapshot == 1:
            rows = rows.filter(number != 5)
        return rows.select(number.alias("id_metodo"), label.alias("tipo_pagamento"))

    # -- sales -------------------------------------------------------------------

    def _pedidos(self) -> DataFrame:
        key = F.col("o_orderkey")
        sellers = self.source("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
        return self.source("orders").select(
            key.alias("id_pedido"),
            F.col("o_custkey").alias("id_cliente"),
            (key % STORES).alias("id_loja"),
            (key % sellers).alias("id_vendedor"),
            F.col("o_orderdate").cast("timestamp").alias("data_pedido"),
            order_status("o_orderstatus").alias("status_pedido"),
            _batch_of(key).alias("_silver_processed_at"),
        )

    def _itens_pedido(self) -> DataFrame:
        """The line's price serves as unit price: it is exact to the cent."""
        return self.source("lineitem").select(
            item_key().alias("id_item"),
            F.col("l_orderkey").alias("id_pedido"),
            F.col("l_partkey").alias("id_produto"),
            F.col("l_quantity").cast("int").alias("quantidade"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("preco_unitario"),
            _batch_of(F.col("l_orderkey")).alias("_silver_processed_at"),
        )

    def _pagamentos_pedido(self) -> DataFrame:
        """Most orders have one payment, some a second one."""
        key = F.col("o_orderkey")
        method = _method_id("o_orderpriority")
        extra = F.col("extra") == 1
        return (
            self.source("orders")
            .select(
                "*",
                F.explode(
                    F.when(key % 8 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
                ).alias("extra"),
            )
            .select(
                (key * 2 + F.col("extra")).alias("id_pagamento"),
                key.alias("id_pedido"),
                F.when(extra, method % 5 + 1).otherwise(method).alias("id_metodo"),
                F.when(extra, F.lit("1.00").cast("decimal(10,2)"))
                .otherwise(F.col("o_totalprice").cast("decimal(10,2)"))
                .alias("valor_pago"),
                F.col("o_orderdate").cast("timestamp").alias("data_pagamento"),
                _batch_of(key).alias("_silver_processed_at"),
            )
        )

    # -- gold ----------------------------------------------------------------------

    def snapshot(self, dimension: str, snapshot: int) -> DataFrame:
        dim = DIMENSIONS[dimension]
        return dim.snapshot(*[self._master(t, snapshot) for t in dim.inputs])

    def dimension(self, name: str) -> DataFrame:
        """The dimension after both loads."""
        dim = DIMENSIONS[name]
        first = scd2_apply(None, self.snapshot(name, 1), dim.key, dim.tracked, FIRST_LOAD)
        return scd2_apply(first, self.snapshot(name, 2), dim.key, dim.tracked, SECOND_LOAD)

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.dimension(name) for name in DIMENSIONS}

    def _master(self, table: str, snapshot: int) -> DataFrame:
        rows = self.table(table, snapshot)
        if table == "lojas":
            return rows.withColumn("estado_loja", F.upper(F.trim("estado_loja")))
        return rows

    # -- raw rows as they arrive in bronze -------------------------------------------

    def bronze_orders(self) -> DataFrame:
        """Text rows with spelling variants, repeats, ties and values that do not fit."""
        key, copy = F.col("o_orderkey"), F.col("copia")
        text = key.cast("string")
        copies = (
            F.when(key % 20 == 0, F.array(*map(F.lit, (1, 2, 3))))
            .when(key % 4 == 0, F.array(*map(F.lit, (1, 2))))
            .when(key % 10 == 0, F.array(*map(F.lit, (1, 3))))
            .otherwise(F.array(F.lit(1)))
        )
        status = order_status("o_orderstatus")
        return (
            self.source("orders")
            .select("*", F.explode(copies).alias("copia"))
            .select(
                F.when(key % 101 == 0, F.concat(F.lit("x"), text))
                .when((key % 5 == 0) & (copy == 2), F.concat(text, F.lit(".0")))
                .when(key % 6 == 0, F.concat(F.lit(" "), text))
                .otherwise(text)
                .alias("id_pedido"),
                F.when(key % 9 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
                .when(key % 23 == 0, "abc")
                .when(key % 31 == 0, "  ")
                .when(key % 29 != 0, F.col("o_custkey").cast("string"))
                .alias("id_cliente"),
                (key % STORES).cast("string").alias("id_loja"),
                F.when(key % 37 == 0, "12345678901")
                .otherwise((key % 10).cast("string"))
                .alias("id_vendedor"),
                F.when(key % 13 == 0, "02/01/2024")
                .otherwise(F.col("o_orderdate").cast("string"))
                .alias("data_pedido"),
                F.when(key % 17 == 0, "Devolvido")
                .when((key % 19 != 0) & (copy == 2), "Cancelado")
                .when((key % 19 != 0) & (copy == 3), F.concat(F.lit(" "), status, F.lit(" ")))
                .when(key % 19 != 0, status)
                .alias("status_pedido"),
                F.when(copy == 2, at(SECOND_LOAD)).otherwise(at(FIRST_LOAD)).alias("_ingestion_timestamp"),
                F.concat(F.lit("carga-"), copy.cast("string")).alias("_source_file"),
                F.lit("pedidos").alias("_source_table"),
            )
        )

    def bronze_payments(self) -> DataFrame:
        """Text rows of payments with amounts that round, overflow or are no numbers."""
        key = F.col("o_orderkey")
        amount = F.col("o_totalprice").cast("decimal(10,2)").cast("string")
        return self.source("orders").select(
            key.cast("string").alias("id_pagamento"),
            key.cast("string").alias("id_pedido"),
            _method_id("o_orderpriority").cast("string").alias("id_metodo"),
            F.when(key % 8 == 0, F.concat(amount, F.lit("5")))
            .when(key % 15 == 0, "R$ 10")
            .when(key % 21 == 0, "123456789.12")
            .when(key % 27 == 0, "-1")
            .when(key % 33 == 0, " 7 ")
            .otherwise(amount)
            .alias("valor_pago"),
            F.col("o_orderdate").cast("string").alias("data_pagamento"),
            at(FIRST_LOAD).alias("_ingestion_timestamp"),
            F.lit("carga-1").alias("_source_file"),
            F.lit("pagamentos_pedido").alias("_source_table"),
        )


def order_status(code: str) -> Column:
    done, pending, cancelled = ORDER_STATUS
    return F.when(F.col(code) == "F", done).when(F.col(code) == "O", pending).otherwise(cancelled)


def item_key() -> Column:
    """Five columns identify a line; order and line number alone repeat."""
    parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in parts]))


def _category_id(name: str) -> Column:
    """Fifteen hex digits of the name's hash: an id that needs no numbering of all names."""
    return F.conv(F.substring(F.md5(F.col(name)), 1, 15), 16, 10).cast("bigint")


def _method_id(name: str | Column) -> Column:
    """The number before the first dash."""
    return F.split_part(F.col(name) if isinstance(name, str) else name, F.lit("-"), F.lit(1)).cast("bigint")


def _known(rows: DataFrame, key: Column, snapshot: int) -> DataFrame:
    """One key in a hundred appears only with the second load."""
    return rows.filter(key % 100 != 99) if snapshot == 1 else rows


def _moved(key: Column, nation: Column) -> Column:
    return F.when(key % 7 == 0, (nation + 1) % STORES).otherwise(nation)


def _batch_of(key: Column) -> Column:
    """Processing time of the silver row: two orders in three came with the first load."""
    return F.when(key % 3 == 0, at(SECOND_LOAD)).otherwise(at(FIRST_LOAD))
