"""What the fact's shuffles move: hashes as bytes, narrow items, validity spans, each value once."""

from datetime import datetime

from conftest import rows
from pyspark.sql import functions as F

from lapidar.functions.hashes import restored, shortened
from lapidar.operators.facts import point_in_time_join, valid_version, validity_spans, with_versions
from lapidar.operators.merge import changed_rows

DAYS = [datetime(2024, 1, d) for d in range(1, 30)]
VERSIONS = "k int, sk string, data_inicio_vigencia timestamp, data_fim_vigencia timestamp"


def test_hashes_are_16_bytes_and_every_text_comes_back(spark):
    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "0123456789abcdef" * 2 + "\n", "x" * 16, "x" * 15, "x" * 15 + "\0", "é" * 16, "", None, "7"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    short = shortened(df, ["i", "t"])
    assert [len(r["t"]) for r in short.filter("i = 0").collect()] == [16]
    assert rows(restored(short, ["i", "t"])) == rows(df)


def test_versions_chosen_later_equal_the_point_in_time_join(spark):
    """With gaps, overlaps, repeats, empty and inverted validities, null keys and null times."""
    d = DAYS
    dim = spark.createDataFrame(
        [(1, "a", d[1], d[5]), (1, "a", d[5], d[9]), (1, "b", d[9], None), (2, "a", d[1], d[5]), (2, "a", d[3], d[5]), (2, "a", d[5], d[9]),
         (2, "a", d[5], d[9]), (3, "a", d[4], d[4]), (3, "a", d[4], d[2]), (3, None, d[6], d[8]), (3, None, d[8], d[10]), (4, "a", None, d[3]),
         (4, "a", d[3], None), (None, "n", d[1], None), (5, "a", d[1], d[5]), (5, "a", d[5], d[3])], VERSIONS)
    facts = spark.createDataFrame([(k, t) for k in (1, 2, 3, 4, 5, 6, None) for t in [*d[:14], None]], "k int, t timestamp")
    expected = point_in_time_join(facts, dim, "k", "t", "sk").select("k", "t", "sk")
    found = valid_version(with_versions(facts, dim, "k", "sk"), "t", "sk").select("k", "t", "sk")
    assert rows(found) == rows(expected)


def test_versions_without_a_change_of_the_key_are_one_span(spark):
    dim = spark.createDataFrame([(1, "a", DAYS[i], DAYS[i + 1]) for i in range(9)] + [(1, "a", DAYS[9], None)], VERSIONS)
    assert rows(validity_spans(dim, "k", "sk")) == [(1, "a", DAYS[0], None)]


def test_compared_values_meet_only_after_the_shuffle(spark):
    """Each value of either side is shuffled once, not once more inside a struct."""
    df = spark.createDataFrame([(1, "a", 1), (2, None, 1)], "k int, v string, t int")
    with_settings = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        old = spark.createDataFrame([(1, "b", 2), (2, None, 1), (3, "c", 1)], "k int, v string, t int")
        found = changed_rows(old, df.union(spark.createDataFrame([(4, "d", 1)], df.schema)), "k", ["k", "v"], ["t"])
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "struct(" not in plan.split("Join", 1)[1]
        assert rows(found) == [(4, "d", 1)]
        assert rows(changed_rows(old, df, "k", ["k", "v"])) == [(1, "a", 1)]
        assert rows(changed_rows(old, df, "k", ["k"])) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_settings)


def test_lake_restores_short_columns(spark, lake):
    df = spark.range(4).select(F.md5(F.col("id").cast("string")).alias("h"), F.lit("p").alias("p"))
    for table, given in (("a", df), ("b", shortened(df, ["h"]))):
        lake.publish_parts(given, "gold", table, F.col("p"), [], ["h"])
        assert rows(lake.read("gold", table).select("h")) == rows(df.select("h"))
