"""Plan shapes that decide whether an operator scales, and results under skew."""

import re
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lapidar.operators.dedup import latest_per_key, newest_first
from lapidar.operators.facts import (
    incremental_filter,
    items_of_orders,
    payments_per_order,
    point_in_time_join,
)
from lapidar.operators.merge import upsert
from lapidar.operators.scd2 import scd2_apply, scd2_step
from lapidar.operators.skew import hot_keys, salted_join
from lapidar.plans import kpis
from lapidar.plans.sales import with_attributes
from lapidar.registry.gold_data import gold

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The final adaptive plan after running the query."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


@pytest.fixture
def setting(spark):
    before = {}

    def change(name, value):
        before[name] = spark.conf.get(name)
        spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    text = plan(latest_per_key(df, "k", newest_first(df, "t")))
    assert re.search(r"WindowGroupLimit.*Partial", text) and text.count("Exchange") == 1


def test_latest_per_key_with_one_hot_key(spark):
    df = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    latest = latest_per_key(df, "k", newest_first(df, "t"))
    assert latest.filter("k = 0").first().t == 299_997
    assert latest.count() == df.select("k").distinct().count()


def test_watermark_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "x", datetime(2024, 1, 1))], "k int, v string, t timestamp").write.parquet(str(tmp_path / "t"))
    text = plan(incremental_filter(spark.read.parquet(str(tmp_path / "t")), "t", "2024-01-01").select("k"))
    assert "GreaterThan(t," in text and "ReadSchema: struct<k:int,t:timestamp>" in text


def test_scd2_step_is_one_join(spark):
    dim = scd2_apply(None, spark.createDataFrame([(1, "a")], "k int, v string"), "k", ["v"], "2024-01-01")
    text = plan(scd2_step(dim, spark.createDataFrame([(1, "b")], "k int, v string"), "k", ["v"], "2024-02-01"))
    assert text.count("Join") == 1 and "FullOuter" in text


def test_small_upsert_does_not_shuffle_the_target(spark):
    target = spark.range(1_000_000).select("id", F.lit("a").alias("v"))
    source = spark.range(10).select("id", F.lit("b").alias("v"))
    text = plan(upsert(target, source, "id"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_payments_are_combined_before_the_shuffle(spark):
    df = spark.range(10).select(
        F.col("id").alias("id_pagamento"), F.lit(1).alias("id_pedido"), F.lit(1).alias("id_metodo"),
        F.lit(1).cast("decimal(10,2)").alias("valor_pago"))
    text = plan(payments_per_order(df))
    assert text.count("HashAggregate") == 2 and "partial_sum" in text and "SortAggregate" not in text


def test_category_revenue_joins_one_dimension(spark):
    g = gold(spark, SF)
    text = plan(kpis.revenue_by_category(with_attributes(g.fact, g.dims, "dim_produtos")))
    assert text.count("Join") == 1
    assert re.search(r"PushedFilters: \[.*EqualTo\(status_pedido,Concluído\)", text)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of all rows carry one key; the dimension has two versions of it."""
    folder = str(tmp_path_factory.mktemp("hot"))
    # the filler keeps the columns from compressing away, so the skew shows in bytes
    spark.range(300_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).cast("int").alias("k"),
        F.timestamp_seconds(F.col("id")).alias("t"), F.sha2(F.col("id").cast("string"), 512).alias("filler"),
    ).write.parquet(f"{folder}/facts")
    spark.range(5000).select(
        F.col("id").cast("int").alias("k"), F.explode(F.array(F.lit(0), F.lit(1))).alias("n")
    ).select(
        "k", F.concat("k", F.lit("-"), "n").alias("sk"),
        F.timestamp_seconds(F.col("n") * 150_000).alias("data_inicio_vigencia"),
        F.when(F.col("n") == 0, F.timestamp_seconds(F.lit(150_000))).alias("data_fim_vigencia"),
    ).write.parquet(f"{folder}/dim")
    return spark.read.parquet(f"{folder}/facts"), spark.read.parquet(f"{folder}/dim")


def test_hot_key_is_split_in_the_point_in_time_join(hot, setting):
    facts, dim = hot
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1MB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    joined = point_in_time_join(facts, dim, "k", "t", "sk")
    assert "skew=true" in executed(joined)
    by_version = joined.groupBy("sk").count()
    assert {r["sk"]: r["count"] for r in by_version.filter("sk like '0-%'").collect()} == {
        "0-0": facts.filter("k = 0 and t < timestamp_seconds(150000)").count(),
        "0-1": facts.filter("k = 0 and t >= timestamp_seconds(150000)").count(),
    }
    assert joined.count() == 300_000 and joined.filter("sk is null").count() == 0


def test_hot_keys_are_found_and_bounded(hot):
    facts, _ = hot
    assert list(hot_keys(facts, "k", rows=1000)) == [0]
    assert hot_keys(facts, "k") == {}
    assert hot_keys(facts.filter("k < 0"), "k", rows=1) == {}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(hot, how):
    facts, dim = hot
    right = dim.filter("data_fim_vigencia is null and k % 2 = 0").select("k", "sk")
    plain = facts.join(right, "k", how)
    salted = salted_join(facts, right, "k", "filler", {0: 40, 1: 3, 99999: 2}, how)
    assert salted.columns == plain.columns
    assert plain.exceptAll(salted).count() == 0 and salted.count() == plain.count()


def test_items_of_a_hot_order_spread_over_the_tasks(hot, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.shuffle.partitions", "16")
    items = hot[0].select(F.col("k").alias("id_pedido"), F.col("filler").alias("id_item"))
    # partitioned by the order already, where AQE could not split it
    orders = items.groupBy("id_pedido").agg(F.count("*").alias("itens"))

    def largest_task(joined):
        sizes = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count"))
        return tuple(sizes.first())

    assert largest_task(items_of_orders(items, orders))[0] > 100_000
    largest, total = largest_task(items_of_orders(items, orders, hot_keys(items, "id_pedido", rows=1000)))
    assert largest < 45_000 and total == 300_000


def test_broadcast_and_shuffled_joins_agree(hot, setting):
    facts, dim = hot
    summary = lambda: rows(point_in_time_join(facts, dim, "k", "t", "sk").groupBy("sk").count())
    broadcast = summary()
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert summary() == broadcast
