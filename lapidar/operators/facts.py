"""Building blocks of the sales fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType

from lapidar.functions.expressions import at, surrogate_key
from lapidar.functions.hashes import shortened
from lapidar.operators.scd2 import BEGINNING, END, START
from lapidar.operators.skew import salted_join

# Columns of the fact, in order; the processing time follows them.
FACT_COLUMNS = (
    "id_pedido",
    "id_item",
    "sk_cliente",
    "sk_loja",
    "sk_vendedor",
    "sk_produto",
    "sk_metodo",
    "data_pedido",
    "status_pedido",
    "quantidade",
    "preco_unitario",
    "valor_total_item",
    "valor_total_pago_pedido",
)
# Those of them that are hashes, which the fact's shuffles move in half their bytes.
FACT_HASHES = ("id_item", "sk_cliente", "sk_loja", "sk_vendedor", "sk_produto", "sk_metodo")


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Amount paid and the method of the first payment of each order."""
    return payments.groupBy("id_pedido").agg(
        F.sum("valor_pago").alias("valor_total_pago_pedido"),
        F.min_by("id_metodo", "id_pagamento").alias("id_metodo"),
    )


def items_of_orders(
    items: DataFrame, orders: DataFrame, hot_orders: Mapping | None = None
) -> DataFrame:
    """Items with their order; the items of ``hot_orders`` are spread over several tasks."""
    return salted_join(items, orders, "id_pedido", "id_item", hot_orders or {})


def with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Order rows with their aggregated payments; orders without payment stay."""
    return orders.join(payments_per_order(payments), "id_pedido", "left")


def with_item_total(items: DataFrame) -> DataFrame:
    return items.withColumn("valor_total_item", F.col("quantidade") * F.col("preco_unitario"))


def point_in_time_join(
    rows: DataFrame, dim: DataFrame, fk: str, event_time: str, *columns: str
) -> DataFrame:
    """Add columns of the version valid at the event time; NULL where there is none.

    An equi join on the business key with the validity as residual condition. Only the
    key, the wanted columns and the validity of the dimension take part. Intervals are
    half-open, so an event on a boundary meets one version.
    """
    versions = dim.select(
        F.col(fk).alias("_fk"), *columns, F.col(START).alias("_from"), F.col(END).alias("_to")
    )
    event = F.col(event_time).cast("timestamp")
    valid = (event >= F.col("_from")) & (F.col("_to").isNull() | (event < F.col("_to")))
    return rows.join(versions, (F.col(fk) == F.col("_fk")) & valid, "left").drop(
        "_fk", "_from", "_to"
    )


def validity_spans(dim: DataFrame, fk: str, *columns: str) -> DataFrame:
    """Versions of a key as ``fk``, the columns, _from, _to; one where the next begins as the last ends
    and the columns are the same. At any time as many of them are valid as of the versions."""
    end, ends_later = F.col("_to"), F.col("_to").isNull() | (F.col("_to") >= F.col("_from"))
    versions = dim.select(fk, *columns, F.col(START).alias("_from"), F.col(END).alias("_to"))
    same = Window.partitionBy(fk, *columns).orderBy(F.asc("_from"), F.asc_nulls_last("_to"))
    so_far = same.rowsBetween(Window.unboundedPreceding, Window.currentRow)  # repeats begin spans of their own
    begins = F.when((F.lag("_to").over(same) == F.col("_from")) & ends_later, 0).otherwise(1)
    spans = versions.withColumn("_begins", begins).withColumn("_span", F.sum("_begins").over(so_far))
    return spans.groupBy(fk, *columns, "_span").agg(
        F.min("_from").alias("_from"), F.when(F.count_if(end.isNull()) == 0, F.max(end)).alias("_to")
    ).drop("_span")


def with_versions(rows: DataFrame, dim: DataFrame, fk: str, *columns: str) -> DataFrame:
    """Add the validity spans of the row's key as an array, for rows that do not know their time yet."""
    spans = validity_spans(dim.filter(F.col(fk).isNotNull()), fk, *columns)
    versions = spans.groupBy(fk).agg(F.collect_list(F.struct(*columns, "_from", "_to")).alias("_versions"))
    return rows.join(versions, fk, "left")


def valid_version(rows: DataFrame, event_time: str, *columns: str) -> DataFrame:
    """The columns of those of ``with_versions`` that are valid at the event time, as ``point_in_time_join``."""
    event = F.col(event_time).cast("timestamp")
    valid = lambda v: (event >= v["_from"]) & (v["_to"].isNull() | (event < v["_to"]))
    # most keys have one span, which needs no function over the array
    one = F.when(valid(F.get("_versions", F.lit(0))), F.col("_versions"))
    chosen = F.when(F.size("_versions") == 1, one).otherwise(F.filter("_versions", valid))
    found = rows.withColumn("_version", F.explode_outer(chosen))
    return found.withColumns({c: F.col(f"_version.{c}") for c in columns}).drop("_versions", "_version")


def odd_keys(rows: DataFrame, dim: DataFrame, fk: str, surrogate: str) -> DataFrame | None:
    """Keys of the rows whose surrogate has to be looked up, with their validity spans; None without any.

    Of any other key, at every time from the beginning on, exactly one version is valid, and its
    surrogate is the key's own hash: that can be computed wherever the key is. Keys that the
    dimension does not have are odd too; their ``_versions`` are null. Runs a job; the result is
    held, so that Spark knows its size. Hashes in it are bytes.
    """
    used = rows.select(fk).filter(F.col(fk).isNotNull()).distinct()
    of_used = dim.join(used, fk, "left_semi")
    starts, ends = F.array_sort(F.collect_list("_from")), F.array_sort(F.collect_list("_to"))
    versions = of_used.select(
        F.col(fk).alias("_fk"),
        F.col(START).alias("_from"),
        F.col(END).alias("_to"),
        F.col(surrogate).eqNullSafe(surrogate_key(fk)).alias("_own"),
    )
    # as many ends as starts but one, each end a later start: the versions follow each other without gap
    by_key = versions.groupBy("_fk").agg(
        F.every("_own").alias("_own"),
        F.every(F.col("_from").isNotNull() & (F.col("_to").isNull() | (F.col("_from") <= F.col("_to")))).alias("_forward"),
        starts.alias("_starts"),
        ends.alias("_ends"),
    )
    first = F.get("_starts", F.lit(0)) == at(BEGINNING)
    follows = F.slice("_starts", F.lit(2), F.greatest(F.size("_starts"), F.lit(1))) == F.col("_ends")
    last = F.size("_ends") == F.size("_starts") - 1
    plain = F.col("_own") & F.col("_forward") & first & last & follows
    if not _same_text(rows.schema[fk].dataType, dim.schema[fk].dataType):
        plain = F.lit(False)
    odd = used.join(by_key, F.col(fk) == F.col("_fk"), "left").filter(~F.coalesce(plain, F.lit(False))).select(fk).persist()
    if odd.isEmpty():
        odd.unpersist()
        return None
    found = with_versions(odd, shortened(dim.join(odd, fk, "left_semi"), [surrogate]), fk, surrogate).persist()
    found.count()
    odd.unpersist()
    return found


def _same_text(a: DataType, b: DataType) -> bool:
    """Whether equal keys of these types have the same text."""
    whole = (IntegerType, LongType)
    return isinstance(a, StringType) and a == b or isinstance(a, whole) and isinstance(b, whole)


def incremental_filter(df: DataFrame, column: str, watermark: str) -> DataFrame:
    """Rows strictly newer than the watermark; the comparison reaches the Parquet scan."""
    return df.filter(F.col(column) > F.lit(watermark).cast("timestamp"))


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_ts"))


def fact_projection(rows: DataFrame) -> DataFrame:
    return rows.select(*FACT_COLUMNS)
