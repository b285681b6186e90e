"""What the operators share: shipped code, shared folder, and columns computed from whole texts in bounded pieces."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Rows that a Python worker gets at once. Spark's own 10,000 are tens of MB of texts, sets or signatures, which the JVM, the
# pipe and the worker each hold once or more.
_BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that tasks import it and nothing need be installed there.

    Python workers get smaller batches from then on.
    """
    spark.conf.set(*_BATCH)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="riverstat-"), "riverstat.zip")  # Spark's own file server hands it out
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(_PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, one beside the warehouse, but only in a local session.

    On a cluster such a folder may belong to one machine, so the setting is required there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def cut(df: DataFrame, rows_per_file: int = 10_000) -> DataFrame:
    """The rows, written to the shared folder and read from there from now on.

    They are computed with all partitions the plan has and written in files of about `rows_per_file` rows, so a shuffle's
    many partitions do not become as many small files.
    """
    shared_folder(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    files = max(1, -(-held.count() // rows_per_file))
    written = held.coalesce(files).checkpoint()
    held.unpersist()
    return written


def pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose values of `column` have `limit` bytes in sum, or that are single rows."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def free(df: DataFrame, name: str) -> str:
    """`name`, or with underscores behind it, so that the table has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, until the values of `column` have `limit` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def with_struct(
    df: DataFrame, column: str, into: str, fields: T.StructType,
    start: Callable[[], Callable[[list[str | None]], list[pa.Array]]], limit: int = 4 << 20, gather: bool = False,
) -> DataFrame:
    """Add a struct column computed from a text column; a column of that name is replaced, all others are kept.

    `start` runs once a task and returns what turns a list of whole texts into one Arrow array per field. Texts come in
    lists of at most `limit` bytes, or one text alone; with `gather` several batches may make a list.
    """
    ship(df.sparkSession)
    df = df.select([c for c in df.columns if c != into])
    schema = T.StructType([*df.schema.fields, T.StructField(into, fields)])
    names = fields.names

    def run(batches):
        compute = start()
        for batch in gathered(batches, column, limit) if gather else batches:
            for piece in pieces(batch, column, limit):
                made = compute(piece.column(column).to_pylist())
                struct = pa.StructArray.from_arrays(made, names)
                yield pa.RecordBatch.from_arrays([*piece.columns, struct], [*piece.schema.names, into])

    return df.mapInArrow(run, schema)


def encoded(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode() for t in texts]


class Memo:
    """Results by key in bounded memory: once `limit` are held, those not used since the last time are forgotten."""

    def __init__(self, limit: int) -> None:
        self._limit, self._young, self._old = limit, {}, {}
        self.of = self._young.__getitem__

    def unknown(self, keys: set) -> list:
        """Those of the keys that have no result yet. Results of the others stay until the next call."""
        young, old = self._young, self._old
        if len(young) > self._limit:
            self._young, self._old = young, old = {}, young
            self.of = young.__getitem__
        missing = []
        for key in keys.difference(young):
            if key in old:
                young[key] = old[key]
            else:
                missing.append(key)
        return missing

    def add(self, keys, results) -> None:
        self._young.update(zip(keys, results))
