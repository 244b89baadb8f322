"""A training corpus from ``documents``, in stages.

Each stage works on all that the one before kept. ``run`` writes what a stage
returns as Parquet into the shared folder and reads it again, so a lost
executor costs a stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prismcube.llm import decontamination, mixing, quality, queries, simhash, wavelet
from prismcube.llm.common import table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled documents among ``docs``."""
    labels = queries.quality_labels(spark, sf_dir)
    return quality.keep_good(docs, quality.train(docs, labels))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by the shingles and the bit distance of ``op7_simhash``."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.without_contamination(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in the token shards: ``doc_id, start, n_tokens, ids_crc32``."""
    return wavelet.encode_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", one_of_each),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: SQL can't express the classifier, fingerprints, walks and tokenizer; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
