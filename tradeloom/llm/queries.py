"""The registered queries of the subpackage, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import (
    alignment,
    chat_format,
    cutting_stock,
    exact_dedup,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    sketches,
    suffix_tree,
    token_counts,
)
from tradeloom.llm.common import prepared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepared(spark), sf_dir)

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies; the operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_suffix_tree_scoring(spark, sf_dir):
    return suffix_tree.score(_documents(spark, sf_dir))


@query
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(_documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query
def op4_source_mixing(spark, sf_dir):
    mixed = mixing.mix(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op5_chat_formatting(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    said = r"\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast(given.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(given.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    conversations = given.select(*added.columns).union(added)
    return chat_format.digests(chat_format.format_chats(conversations))


@query
def op6_secret_scan(spark, sf_dir):
    return secret_scan.find_secrets(_documents(spark, sf_dir))


@query
def op7_simhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_documents(spark, sf_dir))


@query
def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir))


@query
def op9_quality_classifier(spark, sf_dir):
    return quality.classify(_documents(spark, sf_dir))


@query
def op10_document_fingerprints(spark, sf_dir):
    return sketches.fingerprints(_documents(spark, sf_dir))


@query
def op11_cross_tokenizer_alignment(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op12_packing(spark, sf_dir):
    return cutting_stock.pack(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def with_planted_period(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of a document, in a tenth of all documents periodic from some word on; a null id counts as empty text."""
    code, n = zlib.crc32(str("" if doc_id is None else doc_id).encode()), len(words)
    if code % 10 or not n:
        return words
    first = code // 10 % n
    period = 1 + (n - first) // (3 + code // 10 % 8)
    block = words[first : first + period]
    return words[:first] + (block * -(-(n - first) // period))[: n - first]


@query
def op13_periodic_run_detection(spark, sf_dir):
    return periodic_runs.periodic_runs(_documents(spark, sf_dir), with_planted_period).drop("runs")


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op8_exact_dedup"] = f"""
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), {_AZ}) AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""
