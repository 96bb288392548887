"""Latest row per key and exact duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | Column, newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order, which should be total.

    Spark turns ``row_number() = 1`` into a limit that runs per key before the
    shuffle as well, so a key with very many rows sends one row per input task.
    """
    window = Window.partitionBy(key).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def newest_first(df: DataFrame, timestamp: str, *ties: str) -> list[Column]:
    """Newest timestamp first; ties by the named columns, then by all remaining ones."""
    rest = [c for c in df.columns if c != timestamp and c not in ties]
    return [F.desc(c) for c in (timestamp, *ties, *rest)]


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
