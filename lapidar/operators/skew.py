"""Joins whose left side may hold a large share of its rows under one key.

AQE splits such a key only where both sides of the join come straight from a shuffle.
A right side that is already partitioned by the key, such as orders that were just joined
with their summed payments, does not; there the key is spread explicitly.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# A key with more rows than this is spread, over as many tasks as keep below it.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> dict:
    """Keys with more than ``rows`` rows, and how many tasks each needs.

    One pass over one column, counted with map-side combine; only the hot keys, at most
    one for every ``rows`` rows of the table, reach the driver.
    """
    counts = df.select(key).filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return {r[key]: -(-r["n"] // rows) for r in counts.filter(F.col("n") > rows).collect()}


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    hot: Mapping,
    how: str = "inner",
) -> DataFrame:
    """Equi join that spreads the rows of hot keys; ``hot`` says over how many groups each.

    ``spread_by`` is a left column that varies within a key; hashing it gives the salt,
    so a task that runs again puts each row in the same group. Only the right rows of
    hot keys are repeated; all other rows have the one salt 0. The result is exactly
    that of the plain join, for inner, left, left_semi and left_anti.
    """
    if not hot:
        return left.join(right, key, how)
    schema = StructType([StructField("_hot", left.schema[key].dataType), StructField("_salts", LongType())])
    salts = left.sparkSession.createDataFrame(list(hot.items()), schema)
    of_left = left.join(salts, F.col(key) == F.col("_hot"), "left")
    of_right = right.join(salts, F.col(key) == F.col("_hot"), "left")
    every = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1)) - 1)
    salt = F.pmod(F.xxhash64(spread_by), F.coalesce("_salts", F.lit(1)))
    salted_left = of_left.withColumn("_salt", salt).drop("_hot", "_salts")
    salted_right = of_right.withColumn("_salt", F.explode(every)).drop("_hot", "_salts")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
