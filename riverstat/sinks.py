"""Writing results."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from . import constants as K
from .operators.split import file_numbers
from .session import ensure_checkpoint_dir


def hold(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder, and read from there by all that is made of them."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/held-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", sort: Sequence[str] = ()) -> None:
    """CSV with a header; rows may be sorted inside each file."""
    rows = df.sortWithinPartitions(*sort) if sort else df
    rows.write.mode(mode).csv(path, header=True, nullValue="", emptyValue="")


def write_by_source(
    df: DataFrame, path: str, key: str = "source_file", fmt: str = "csv", mode: str = "errorifexists",
    sort: Sequence[str] = (),
) -> None:
    """One folder per source file. AQE evens out the write: a large source becomes several files of its folder."""
    rows = df.hint("rebalance", key)
    if sort:
        rows = rows.sortWithinPartitions(key, *sort)
    writer = rows.write.mode(mode).partitionBy(key)
    writer.csv(path, header=True, nullValue="", emptyValue="") if fmt == "csv" else writer.format(fmt).save(path)


def write_if_any(df: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Write only when there are rows; tells whether it did.

    The rows are counted while they are written, so the table is computed once; the folder that an empty table leaves is
    taken away again, unless it held something before.
    """
    seen = Observation()
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    appended = mode == "append" and files.exists(folder)
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, mode)
    if seen.get.get("rows"):
        return True
    if not appended:
        files.delete(folder, True)
    return False


def write_bounded(
    df: DataFrame, path: str, key: str, size: int = K.SPLIT_SIZE, mode: str = "errorifexists"
) -> None:
    """One folder per numbered file; a group is never spread over two numbers. Rows without a key get a folder of their own."""
    numbered = df.join(file_numbers(df, key, size), key, "left")
    write_by_source(numbered, path, "file_no", mode=mode, sort=(key,))


def write_tables(tables: Mapping[str, DataFrame], path: str, mode: str = "errorifexists") -> list[str]:
    """Write the named tables of a result, one folder each, leaving out empty ones; returns the names written."""
    return [name for name, table in tables.items() if write_if_any(table, f"{path}/{name}", mode)]
