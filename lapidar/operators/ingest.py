"""Audit columns of the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapidar.functions.expressions import at

AUDIT_COLUMNS = ("_ingestion_timestamp", "_source_file", "_source_table")


def bronze_audit(df: DataFrame, table: str, batch_ts: str) -> DataFrame:
    """Ingestion time, source file and source table. ``df`` must come from a file scan."""
    return df.select(
        "*",
        at(batch_ts).alias("_ingestion_timestamp"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(table).alias("_source_table"),
    )


def processed_at(df: DataFrame, column: str, batch_ts: str) -> DataFrame:
    return df.withColumn(column, at(batch_ts))
