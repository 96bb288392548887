"""Exact deduplication by a stateful stream whose keyed state never expires.

``intake`` reads every row once and notes digest, identifier and place. ``fold`` streams these
notes through a keyed aggregation kept in RocksDB on the executors' disks (changes go to the
shared checkpoint folder): per digest the smallest identifier, its content locator and the number
of rows. There is no watermark, so nothing expires. Spark combines a digest's rows in each task
before they are exchanged, so a digest with a third of all rows sends one row per task.
``verified`` then compares the full bytes of all hits; digests that stand for several texts, if
any, are regrouped by the texts themselves.

Defined results: a null text counts as empty; rows without an identifier come after those with
one; among rows with the same smallest identifier the first place (file, row) stays; no rows give
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm.common import FILE, ROW, SPACE, located, text_of, without, written
from lapidar.session import scratch_dir

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # one memory budget per executor for all its state partitions
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: no disk is reserved ahead
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
FILES_PER_BATCH = 1000


def normalized(column: str = "text") -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(text_of(column), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _first(*also: Column) -> Column:
    """Orders rows: smallest identifier, then place; rows without an identifier last."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), *also)


def intake(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """doc_id, digest and place of every row of located ``docs``, written."""
    return written(docs.select("doc_id", digest(normalized()).alias("digest"), FILE, ROW), "intake")


def fold(spark: SparkSession, notes: DataFrame, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """digest, first (identifier and place of the row that stays), n: the state after all notes.

    The stream reads the notes' folder; run again on the same checkpoint it would go on with the
    files that came since. Each batch writes the groups it changed below its own number, so a batch
    that is tried again replaces its files.
    """
    session = spark.newSession()
    for name, value in STATE_SETTINGS.items():
        session.conf.set(name, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    folder = notes.inputFiles()[0].rsplit("/", 1)[0]
    state, place = scratch_dir(spark, "llm-dedup-state"), scratch_dir(spark, "llm-dedup-groups")
    rows = session.readStream.schema(notes.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    groups = rows.groupBy("digest").agg(F.min(_first(F.col(FILE), F.col(ROW))).alias("first"), F.count("*").alias("n"))

    def changed(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{place}/batch={number}")

    query = (
        groups.writeStream.outputMode("update")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .foreachBatch(changed)
        .start()
    )
    query.awaitTermination()
    updates = spark.read.parquet(place)
    # a group's count only grows: its last update has the greatest
    return updates.groupBy("digest").agg(F.min("first").alias("first"), F.max("n").alias("n"))


def verified(docs: DataFrame, groups: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Groups by full bytes: digest, text (null where the digest has one text), first, n.

    Equal texts are combined in each task before the exchange; only texts of hits move.
    """
    hits = groups.where("n > 1").select("digest")
    rows = docs.select("doc_id", FILE, ROW, normalized().alias("text")).withColumn("digest", digest(F.col("text")))
    texts = (
        rows.join(hits, "digest", "left_semi")
        .groupBy("digest", "text")
        .agg(F.min(_first(F.col(FILE), F.col(ROW))).alias("first"), F.count("*").alias("n"))
    )
    several = written(
        texts.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest"), "collisions"
    )
    if several.isEmpty():
        return groups.select("digest", F.lit(None).cast("string").alias("text"), "first", "n")
    return (
        groups.join(several, "digest", "left_anti")
        .select("digest", F.lit(None).cast("string").alias("text"), "first", "n")
        .unionByName(texts.join(several, "digest", "left_semi").select("digest", "text", "first", "n"))
    )


def exact_dedup(
    spark: SparkSession, docs: DataFrame, digest: Callable[[Column], Column] = sha256
) -> tuple[DataFrame, DataFrame]:
    """Located documents, and per row: doc_id, FILE, ROW, digest, keep_id, group_size, kept."""
    placed = located(docs)
    notes = intake(placed, digest)
    if notes.isEmpty():
        return placed, notes.select(
            "*", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
        )
    groups = written(verified(placed, written(fold(spark, notes), "groups"), digest).where("n > 1"), "hits")
    alone = groups.where("text IS NULL").drop("text")
    mixed = groups.where("text IS NOT NULL").select(F.col("digest").alias("d"), "text", "first", "n")
    rows = notes.join(alone, "digest", "left")
    if not mixed.isEmpty():
        # the texts of digests that stand for several
        texts = placed.select(FILE, ROW, normalized().alias("text")).withColumn("d", digest(F.col("text")))
        split = texts.join(mixed, ["d", "text"]).select(
            FILE, ROW, F.col("first").alias("first2"), F.col("n").alias("n2")
        )
        rows = (
            rows.join(split, [FILE, ROW], "left")
            .withColumn("first", F.coalesce("first2", "first"))
            .withColumn("n", F.coalesce("n2", "n"))
        )
    return placed, rows.select(
        "doc_id",
        FILE,
        ROW,
        "digest",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce((F.col(f"first.{FILE}") == F.col(FILE)) & (F.col(f"first.{ROW}") == F.col(ROW)), F.lit(True)).alias(
            "kept"
        ),
    )


def deduplicated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without their later copies, in their own columns."""
    placed, rows = exact_dedup(spark, docs)
    return without(placed, written(rows.where("NOT kept").select(FILE, ROW), "copies"))
