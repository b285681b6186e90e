"""From documents to packed training sequences, in stages that are each written as Parquet and read again.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents. Between stages the rows go to the shared folder of spark.checkpoint.dir.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverstat.llm import language, lines, minmax, packing, toxicity
from riverstat.llm.common import free, shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without letters, and longer ones far from all learned languages."""
    return language.known_language(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go; learned from the labels of documents that are still there."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; text and n_chars become those of the lines that stay."""
    into = free(docs, "_lines")
    kept = lines.drop_shared(lines.build(docs), docs, into=into)
    changed = {"text": F.col(f"{into}.text"), "n_chars": F.length(f"{into}.text").cast(docs.schema["n_chars"].dataType)}
    return kept.withColumns(changed).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: shingles of five words, similarity 0.8 or more."""
    return minmax.one_of_each(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place."""
    # Smaller lists of texts than the operator's own: workers still hold what the stages before have left.
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, together=2 << 20, remembered=150_000)


STAGES = [
    ("language_id", language_id), ("toxicity", toxic), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
    ("packing", packed),
]

# Learned models, hashed signatures and a tokenizer are not SQL; tests hold the stages' rows against plain Python, on sf0.001,
# toxicity on made rows with known labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
