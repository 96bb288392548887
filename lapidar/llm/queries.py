"""The dealt operators as named queries: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapidar.llm import (
    bitsliced,
    exact_dedup,
    fill_in_middle,
    html_extract,
    language_model,
    mixing,
    order_minhash,
    packing,
    quality,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from lapidar.llm.common import located, table


def op1_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = order_minhash.near_classes(spark, table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "class_id", "class_size", "kept")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(spark, table(spark, sf_dir, "documents"))


def op4_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = F.pmod(F.col("vec_id"), F.lit(bitsliced.QUERIES_EVERY)) == 0
    return bitsliced.top_k(table(spark, sf_dir, "embeddings"), every).drop("exact")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored(spark, table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.sized(located(table(spark, sf_dir, "documents")))
    return mixing.mixed(sizes).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archived(spark, table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = url_filter.url_verdicts(spark, table(spark, sf_dir, "pages"))
    return rows.select("page_id", "host", "path", "rule", "verdict", "score")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.transformed(spark, table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_mincut": op1_html_mincut,
    "op2_order_minhash": op2_order_minhash,
    "op3_packing": op3_packing,
    "op4_bitsliced_topk": op4_bitsliced_topk,
    "op5_language_model": op5_language_model,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_whitening": op12_whitening,
    "op13_quality": op13_quality,
}
