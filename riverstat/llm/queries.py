"""Queries of the numbered operators over the whole tables, and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, language, lines, minmax, packing, pages, periods, polytope, sharding, tokencount, toxicity, vafile, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


@_query
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN).select("doc_id", "bpe.*")


@_query
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@_query
def op6_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    kept = lines.drop_shared(lines.build(docs), docs)
    return kept.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256"))


ORACLES["op6_lines"] = r"""
WITH l AS (
  SELECT rowid_ AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)),
k AS (
  SELECT r, doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE hot.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN hot USING (key) GROUP BY r"""


@_query
def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents", "doc_id", "text"))


@_query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    machine = toxicity.learn(docs, _table(spark, folder, "labels", "doc_id", "toxic"), ~toxicity.held_out())
    return toxicity.score(docs, machine).select("doc_id", toxicity.held_out().alias("held_out"), "toxicity.*")


@_query
def op8_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(_table(spark, folder, "pages", "page_id", "url", "html")).select("page_id", "url", "main.*")


@_query
def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text", "lang")
    profiles = language.learn(docs, ~language.held_out())
    found = language.predict(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", language.held_out().alias("held_out"), "language.*")


@_query
def op3_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return polytope.links(_table(spark, folder, "embeddings", "vec_id", "embedding", "label"))


@_query
def op5_minmax(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(_table(spark, folder, "documents", "doc_id", "text"), words=2, percent=80)


@_query
def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings", "vec_id", "embedding")
    return vafile.nearest(vectors, F.col("vec_id") % 100 == 0, k=10)


ORACLES["op7_topk"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.w, c.w)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10"""


@_query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings", "vec_id", "embedding"), components=8)


@_query
def op12_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokencount.count(docs, path, public_tokenizers.PATTERN, limit=1024).select("doc_id", "tokens.*")


@_query
def op13_periods(spark: SparkSession, folder: str) -> DataFrame:
    return periods.report(_table(spark, folder, "documents", "doc_id", "text"), periods.planted)
