"""One query per operator over the whole of its table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.llm import (
    alignment,
    decontamination,
    hard_negatives,
    language_id,
    mixing,
    mtree,
    pii,
    quality,
    secret_scan,
    simhash,
    toxicity,
    url_model,
    wavelet,
)
from prismcube.llm.common import crc32_remainder, table


def held_out(docs: DataFrame, divisor: int, remainder: int) -> DataFrame:
    """``docs`` with whether a document is held out; one without an id never is, nor is it learned from."""
    return docs.withColumn("held_out", F.coalesce(crc32_remainder(F.col("doc_id"), divisor) == remainder, F.lit(False)))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = held_out(table(spark, folder, "documents").select("doc_id", "text", "lang"), 4, 2)
    model = language_id.train(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return language_id.identify(docs, model)


def op2_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet.encode_documents(table(spark, folder, "documents"))


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_model.filter_urls(table(spark, folder, "pages"))


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


def op5_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_products(table(spark, folder, "embeddings"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, folder, "documents"))


def op9_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"))


def quality_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled ids that may be learned from."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return labels.where(crc32_remainder(F.col("doc_id"), 3) != 1)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = quality.train(docs, quality_labels(spark, folder))
    return quality.score_quality(held_out(docs, 3, 1), weights)


def toxic_labels(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled ids that may be learned from."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    return labels.where(crc32_remainder(F.col("doc_id"), 5) != 0)


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, toxic_labels(spark, folder))
    return toxicity.score_toxicity(held_out(docs, 5, 0), machine)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.with_wrong_labels(table(spark, folder, "embeddings")))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment_digests(table(spark, folder, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_shards": op2_token_shards,
    "op3_url_filter": op3_url_filter,
    "op4_personal_data": op4_personal_data,
    "op5_top_products": op5_top_products,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_secret_scan": op8_secret_scan,
    "op9_source_mix": op9_source_mix,
    "op10_quality": op10_quality,
    "op11_toxicity": op11_toxicity,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op5_top_products": mtree.ORACLE,
    "op9_source_mix": mixing.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
