"""From raw documents to packed training sequences, each stage over all that the one before kept.

A stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the
documents of the next one, so that a lost executor never sends the work back further than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradeloom.llm import exact_dedup, mixing, near_dedup, packing, quality
from tradeloom.llm.common import prepared, written
from tradeloom.llm.queries import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls junk go."""
    prepared(spark)
    return quality.keep_good(docs)


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    prepared(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def simhash_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    prepared(spark)
    return near_dedup.drop_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, stay or go, so that the sources come near their target weights."""
    prepared(spark)
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents of the mix with their places in sequences."""
    prepared(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_deduplication),
    ("simhash_near_dedup", simhash_deduplication),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Trained models, fingerprints and tokenizers cannot be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
