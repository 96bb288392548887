"""Continuous loads. Every stream can stop and resume from its checkpoint folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lapidar.functions.expressions import tolerant_cast
from lapidar.operators.ingest import AUDIT_COLUMNS
from lapidar.operators.typing import cast_loss_counts
from lapidar.plans.jobs import CHANGED, FACT_SOURCES, append_bronze, merge_fact, merge_silver, noted_orders
from lapidar.sources.lake import Lake
from lapidar.sources.landing import landing_path, marked
from lapidar.sources.schemas import raw_schema, table_schema

# Files of a table that one micro-batch takes at most: the first run has the whole history before it.
FILES_PER_BATCH = 1000


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def stream_bronze(
    lake: Lake, landing: str, table: str, checkpoint: str, files_per_batch: int = FILES_PER_BATCH
) -> StreamingQuery:
    """Append each new landing file to bronze exactly once.

    Every micro-batch is a batch of the bronze table, beside those of batch loads; one that
    is replayed replaces itself. The ingestion time is fixed per micro-batch. Malformed rows
    go to the quarantine.
    """
    reader = marked(lake.spark.readStream, table).option("maxFilesPerTrigger", files_per_batch)
    files = reader.csv(landing_path(landing, table))
    rows = files.select(
        "*",
        F.current_timestamp().alias("_ingestion_timestamp"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(table).alias("_source_table"),
    )
    place = f"{checkpoint}/bronze_{table}"
    stream = hashlib.md5(place.encode()).hexdigest()

    def load(batch: DataFrame, batch_id: int) -> None:
        append_bronze(lake, batch, table, f"s{stream}-{batch_id}")

    return _for_each_batch(rows, load, place)


def stream_silver_upsert(
    lake: Lake,
    table: str,
    checkpoint: str,
    key_types: Mapping[str, str] | None = None,
    clock: Callable[[], str] = _now,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Upsert every micro-batch of bronze rows into silver.

    A micro-batch that is replayed finds its rows in silver already and changes nothing.
    The progress of the query has the rows read and the values that no cast keeps, per
    column, under the table's name in ``observedMetrics``.
    """
    counts = [F.count(F.lit(1)).alias("recebidas"), *cast_loss_counts(table_schema(table, key_types))]
    bronze = _bronze_stream(lake, table, files_per_batch).observe(f"silver_{table}", *counts)

    def load(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()  # computed once, so its counts hold
        try:
            merge_silver(lake, rows, table, clock(), key_types)
        finally:
            rows.unpersist()

    return _for_each_batch(bronze, load, f"{checkpoint}/silver_{table}")


def stream_fact(
    lake: Lake,
    checkpoint: str,
    key_types: Mapping[str, str] | None = None,
    clock: Callable[[], str] = _now,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Carry new bronze rows of orders, items and payments through silver into the fact.

    The orders to rebuild come from the micro-batch itself, after its rows are in
    silver: replaying a micro-batch rebuilds the same orders to the same rows, and no
    order can be missed between two loads.
    """
    place = f"{checkpoint}/fato_vendas"
    name, union = hashlib.md5(place.encode()).hexdigest(), None
    for table in FACT_SOURCES:
        stream = _bronze_stream(lake, table, files_per_batch)
        union = stream if union is None else union.unionByName(stream, allowMissingColumns=True)

    def load(rows: DataFrame, batch_id: int) -> None:
        # read from its files whenever it is needed: the first batch may be all there is, too much to hold
        batch_ts = clock()
        note = f"s{name}-{batch_id}"
        for table in FACT_SOURCES:
            columns = (*raw_schema(table).names, *AUDIT_COLUMNS)
            of_table = rows.filter(F.col("_source_table") == table).select(*columns)
            merge_silver(lake, of_table, table, batch_ts, key_types, note)
        order_type = table_schema("pedidos", key_types)["id_pedido"].dataType
        ids = rows.select(tolerant_cast("id_pedido", order_type).alias("id_pedido"))
        # also those that its rows have left, noted now or by an earlier run of this micro-batch
        notes = [b for b in lake.batches("silver", CHANGED) if b.endswith(f".{note}")]
        for left in noted_orders(lake, order_type, notes):
            ids = ids.unionByName(left)
        merge_fact(lake, ids, batch_ts)

    return _for_each_batch(union, load, place)


def _bronze_stream(lake: Lake, table: str, files_per_batch: int) -> DataFrame:
    schema = raw_schema(table).add("_ingestion_timestamp", "timestamp")
    for name in AUDIT_COLUMNS[1:]:
        schema = schema.add(name, "string")
    reader = lake.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(lake.path("bronze", table)).select(*schema.names)


def _for_each_batch(
    rows: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
