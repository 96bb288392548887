"""Lakes the registered queries read: built from the given tables, once per session.

They are written below ``spark.checkpoint.dir``, so losing an executor loses no data.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.operators.scd2 import ACTIVE
from lapidar.plans.dimensions import DIMENSIONS
from lapidar.plans.jobs import ACTIVE_PART, FACT_SOURCES, load_dimension, load_fact, publish_fact
from lapidar.plans.sales import FACT
from lapidar.session import scratch_dir
from lapidar.sources.lake import Lake
from lapidar.sources.retail_binding import FACT_LOAD, FIRST_LOAD, SECOND_LOAD, RetailTables
from lapidar.sources.schemas import PROCESSING_ORDER

_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


@dataclass(frozen=True)
class Gold:
    """Written gold tables: the fact and the dimensions after both loads."""

    lake: Lake
    fact: DataFrame
    dims: dict[str, DataFrame]


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    return _once(spark, sf_dir, "gold", lambda: write_gold(spark, sf_dir))


def write_gold(spark: SparkSession, sf_dir: str) -> Gold:
    tables = RetailTables(spark, sf_dir)
    lake = Lake(spark, scratch_dir(spark, "gold"))
    state = F.when(F.col(ACTIVE), ACTIVE_PART).otherwise("h1")

    def write(name: str) -> None:
        lake.publish_parts(tables.dimension(name), "gold", name, state, [])

    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        list(pool.map(write, DIMENSIONS))
    dims = {name: lake.read("gold", name) for name in DIMENSIONS}
    publish_fact(lake, *[tables.table(t) for t in FACT_SOURCES], dims, FACT_LOAD)
    return Gold(lake, lake.read("gold", FACT), dims)


@dataclass(frozen=True)
class Waves:
    """A lake loaded in two waves and once more without news; orders rebuilt per run."""

    lake: Lake
    rebuilt: tuple[int, int, int]


def waves(spark: SparkSession, sf_dir: str) -> Waves:
    return _once(spark, sf_dir, "waves", lambda: _load_waves(spark, sf_dir))


def _load_waves(spark: SparkSession, sf_dir: str) -> Waves:
    """First wave: sales of the first load. Second wave: all sales, changed master data."""
    tables = RetailTables(spark, sf_dir)
    lake = Lake(spark, scratch_dir(spark, "waves"))
    rebuilt = []
    with ThreadPoolExecutor(4) as pool:
        for snapshot, batch_ts in ((1, FIRST_LOAD), (2, SECOND_LOAD)):

            def silver(name: str) -> None:
                rows = tables.table(name, snapshot)
                if name == "lojas":
                    rows = rows.withColumn("estado_loja", F.upper(F.trim("estado_loja")))
                if name in FACT_SOURCES and snapshot == 1:
                    loaded = F.lit(FIRST_LOAD).cast("timestamp")
                    rows = rows.filter(F.col("_silver_processed_at") == loaded)
                lake.publish(rows, "silver", name)

            list(pool.map(silver, PROCESSING_ORDER))
            list(pool.map(lambda name: load_dimension(lake, name, batch_ts), DIMENSIONS))
            # orders keep the keys that were there when they came
            rebuilt.append(load_fact(lake, FACT_LOAD, late_keys=False))
    rebuilt.append(load_fact(lake, FACT_LOAD, late_keys=False))
    return Waves(lake, tuple(rebuilt))
