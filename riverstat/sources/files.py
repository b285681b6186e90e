"""Shared pieces of the readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def source_name() -> Column:
    """Name of the file a row came from, without folder and extension."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[^./]*)?$", 1)


def source_folder() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1)


def read_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Lookup file with a declared schema; its size decides whether Spark broadcasts it."""
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=True)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise FileNotFoundError(message)
    return df
