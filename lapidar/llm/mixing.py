"""Mixing of sources to target weights by systematic sampling; DataFrame functions only.

Every document of a source expects the same number of copies, target / size of the source. The
documents of a source stand in a fixed order (size class, hash, then size), their expected copies
are summed along it, one random offset per source is added, and a document is taken once for each
integer its interval crosses. Neighbours in the order have nearly the same size, so the words taken
stay near the target. No task sees a whole source: positions are counted inside buckets of bounded
size, and the buckets' starts come from their counts.

Defined results: a null text has size 0; null is a source of its own, ordered last; a source
without words has target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapidar.llm.common import FILE, ROW, WORD, located, own_columns, text_of, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = 20
ROWS_PER_BUCKET = 50_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and place of each document, written."""
    size = F.regexp_count(text_of(), F.lit(WORD)).cast("long")
    return written(docs.select("doc_id", "source", size.alias("size"), FILE, ROW), "sizes")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target: weights by code point order, excess over the cap reshared by weight.

    Resharing ends at one level: a source gets level times its weight, or its cap. The sources are
    ordered by the level at which each meets its cap; the level is the first that the next source
    does not meet. One row per source, so the unpartitioned windows stay small.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    position = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    ladder = Window.orderBy("meets", F.col("source").asc_nulls_last())
    before = ladder.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return (
        by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (position + 1).cast("int")))
        .withColumn("cap", (MOST_COPIES * F.col("source_size")).cast("double"))
        .withColumn("meets", F.col("cap") / F.col("weight"))
        .withColumn("left", SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.col("weights"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("meets"), F.col("level"))).over(everything))
        .select(
            "source",
            "source_size",
            "docs",
            F.when(F.col("meets") <= F.col("level"), F.col("cap"))
            .otherwise(F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
            .alias("target"),
        )
    )


def _hashed(*of: Column | str) -> Column:
    """A whole number below 2^48 that depends on nothing but the arguments and the seed."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *of, F.lit(str(SEED)))), 1, 12), 16, 10).cast("long")


def size_class(size: str) -> Column:
    """Four classes for each doubling of the size: the leading bits, by whole numbers alone."""
    return F.expr(f"length(bin({size} + 4)) * 4 + (shiftright({size} + 4, length(bin({size} + 4)) - 3) & 3)")


def mixed(sizes: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The rows of ``sizes`` with source_size, target and copies (times the document is taken)."""
    goals = written(targets(sizes), "targets")
    buckets = sizes.count() // rows_per_bucket + 1
    same = F.col("s.source").eqNullSafe(F.col("g.source"))
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("none"))
    rows = sizes.select(
        "*",
        key.alias("of"),
        size_class("size").alias("class"),
        F.pmod(_hashed("doc_id", "size", F.when(F.col("doc_id").isNull(), F.col(ROW))), F.lit(buckets)).alias("bucket"),
    )
    counts = rows.groupBy("of", "class", "bucket").agg(F.count("*").alias("here"))
    ahead = Window.partitionBy("of").orderBy("class", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("here").over(ahead), F.lit(0))).drop("here")
    inside = Window.partitionBy("of", "class", "bucket").orderBy("size", "doc_id", FILE, ROW)
    placed = (
        rows.withColumn("rank", F.row_number().over(inside))
        .join(starts, ["of", "class", "bucket"])
        .withColumn("rank", F.col("rank") + F.col("start"))
        .alias("s")
        .join(goals.alias("g"), same)
        .select("s.*", "source_size", "target")
    )
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _hashed(F.col("of")) / F.lit(float(1 << 48))
    crossed = F.floor(F.col("rank") * each + offset) - F.floor((F.col("rank") - 1) * each + offset)
    return placed.select("doc_id", "source", "size", FILE, ROW, "source_size", "target", crossed.cast("long").alias("copies"))


def mixture(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents in their own columns, each as often as the mix takes it."""
    placed = located(docs)
    taken = written(mixed(sized(placed)).where("copies > 0").select(FILE, ROW, "copies"), "taken")
    # texts are joined by a shuffle whatever their number: one plan for all sizes
    rows = placed.join(taken.withColumnRenamed("copies", "_llm_copies").hint("merge"), [FILE, ROW])
    return rows.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), F.col("_llm_copies").cast("int")))).select(
        own_columns(placed)
    )
