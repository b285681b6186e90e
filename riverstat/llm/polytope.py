"""Links between embeddings of high cosine by cross-polytope hashing.

A hash function rotates a unit vector by three rounds of random signs and a fast Hadamard transform, and takes the axis
(with its sign) that the result is nearest to. Three functions make a bucket of a table. A vector goes to its own bucket
and, as probes, to those with one function's second nearest axis instead; two vectors of one label that share a bucket of
one of the tables are candidates, and their cosine is computed in double precision.

Equal vectors of a label are one class. Members of a bucket are compared by matrix products in blocks of at most `BLOCK`,
so a large group is spread over many tasks and is never expanded into rows of pairs: a task returns for each class how many
vectors it is linked with, and the smallest class it is connected to in the block. A pair that meets in several buckets is
counted in the one with the smallest hash, which both vectors' lists of buckets tell.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and those without label, link with
nothing; vectors of different lengths are never compared; rows are vectors, also if they repeat a vec_id with the same or
another vector, so classes have numbers of their own and component_id is the smallest vec_id of all rows in the component;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship
from .components import components

TABLES, FUNCTIONS = 10, 3
BLOCK = 1024
TASK_ROWS = 20_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of the rows, whose length is a power of two, without scaling."""
    n, d = x.shape
    half = 1
    while half < d:
        parts = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], axis=2).reshape(n, d)
        half *= 2
    return x


def buckets(vectors: np.ndarray, tables: int, functions: int, seed: int) -> np.ndarray:
    """Codes of the buckets of unit vectors: for each table its own bucket and one probe a function."""
    n, d = vectors.shape
    width = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((n, width), dtype=np.float32)
    padded[:, :d] = vectors
    rng = np.random.default_rng([seed, width])
    rows, base = np.arange(n), 2 * width
    out = np.empty((n, tables, functions + 1), dtype=np.int64)
    for table in range(tables):
        best, second = np.empty((2, functions, n), dtype=np.int64)
        for f in range(functions):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice(np.float32([-1, 1]), width)) / np.float32(width ** 0.5)
            size = np.abs(y)
            for into in (best, second):
                axis = size.argmax(1)
                into[f] = 2 * axis + (y[rows, axis] < 0)
                size[rows, axis] = -1
        for probe in range(functions + 1):  # the last is the vector's own bucket
            code = np.full(n, table, dtype=np.int64)
            for f in range(functions):
                code = code * base + (second[f] if f == probe else best[f])
            out[:, table, probe] = code
    return out.reshape(n, -1)


def _valid(embedding: str):
    """Whether all components are finite numbers and some are not zero."""
    real = F.transform(embedding, lambda x: x.cast("double"))
    finite = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(real, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _hashed(classes: DataFrame, tables: int, functions: int, seed: int) -> DataFrame:
    """rep, label, buckets: hashes of label, length and bucket."""

    def run(batches):
        for batch in batches:
            column = batch.column("embedding")
            lengths = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.append(0, np.cumsum(lengths))
            label = batch.column("label").to_numpy().astype(np.int64)
            codes = [None] * len(lengths)
            for d in np.unique(lengths):
                at = np.flatnonzero(lengths == d)
                vectors = _unit(flat[ends[at][:, None] + np.arange(d)])
                mixed = buckets(vectors, tables, functions, seed).astype(np.uint64)
                for part in (label[at], np.full(len(at), d)):
                    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + part[:, None].astype(np.uint64)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                for i, row in zip(at.tolist(), mixed.astype(np.int64)):
                    codes[i] = row
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(codes, pa.list_(pa.int64()))], ["rep", "buckets"])

    return classes.select("rep", "label", "embedding").mapInArrow(run, "rep long, buckets array<long>")


def _blocked(entries: DataFrame, block: int) -> DataFrame:
    """Entries of buckets with several members, each in all block pairs it takes part in: bucket, rep, part, lo, hi."""
    sizes = cut(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
    blocks = F.expr(f"CAST(ceil(size / {block}) AS INT)")
    parted = entries.join(sizes, "bucket").withColumn("blocks", blocks).withColumn(
        "part", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return parted.withColumn("other", other).select(
        "bucket", "rep", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")
    )


def _linked(unit: np.ndarray, part: np.ndarray, lo: int, hi: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a block pair that are similar enough."""
    left, right = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
    i, j = np.nonzero(unit[left] @ unit[right].T >= cosine)
    i, j = left[i], right[j]
    return (i[i < j], j[i < j]) if lo == hi else (i, j)


def _met_before(codes: np.ndarray, bucket: int) -> np.ndarray:
    """For all pairs of members, whether they share a bucket with a smaller hash; by a product of 0/1 matrices."""
    n, width = codes.shape
    row, flat = np.repeat(np.arange(n), width), codes.ravel()
    row, flat = row[flat < bucket], flat[flat < bucket]
    names, index, count = np.unique(flat, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    shared = count[index] > 1
    held = np.zeros((n, int((count > 1).sum())), dtype=np.float32)
    held[row[shared], number[index[shared]]] = 1
    return held @ held.T > 0


def _roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest id that each can reach by the pairs."""
    root = ids.copy()
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        if (new == root).all():
            return root
        root = new


def links(
    vectors: DataFrame, cosine: float = 0.98, tables: int = TABLES, functions: int = FUNCTIONS, seed: int = 17,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept, from vec_id, embedding, label."""
    ship(vectors.sparkSession)
    usable = _valid("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("long").alias("label"), usable.alias("usable"))
    keys = [F.xxhash64("embedding", "label"), F.xxhash64("label", "embedding", F.lit(1))]
    rows = rows.withColumns({"a": keys[0], "b": keys[1]})
    classes = cut(
        rows.filter("usable").groupBy("a", "b").agg(
            F.min("vec_id").alias("least"), F.any_value("label").alias("label"),
            F.any_value("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"),
        ).withColumn("rep", F.monotonically_increasing_id())  # read again from the written table only
    )
    hashed = cut(_hashed(classes, tables, functions, seed))
    entries = hashed.select("rep", F.explode(F.array_distinct("buckets")).alias("bucket"))
    blocked = cut(_blocked(entries, block))
    groups = max(1, -(-blocked.count() // TASK_ROWS))
    needed = classes.select("rep", "embedding", "copies").join(hashed, "rep")
    # One group holds many small buckets, or a few block pairs of large ones.
    work = blocked.withColumn("group", F.pmod(F.xxhash64("bucket", "lo", "hi"), F.lit(groups))).join(needed, "rep")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bucket", "lo", "hi", "rep"], ignore_index=True)
        where = pdf[["bucket", "lo", "hi"]].to_numpy()
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
        reps, copies, part = (pdf[c].to_numpy() for c in ("rep", "copies", "part"))
        found = []
        for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pdf)]):
            bucket, lo, hi = where[at].tolist()
            unit = _unit(np.stack(pdf["embedding"].iloc[at:to].to_numpy()).astype(np.float64))
            i, j = _linked(unit, part[at:to], lo, hi, cosine)
            if not len(i):
                continue
            ids, n = reps[at:to], copies[at:to]
            first = ~_met_before(np.stack(pdf["buckets"].iloc[at:to].to_numpy()), bucket)[i, j]
            count = np.bincount(i[first], n[j[first]], to - at) + np.bincount(j[first], n[i[first]], to - at)
            some = np.union1d(i, j)
            found.append(pd.DataFrame({"rep": ids[some], "root": _roots(ids, i, j)[some], "n": count[some].astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({"rep": [], "root": [], "n": []}, dtype="int64")

    found = cut(work.groupBy("group").applyInPandas(compare, "rep long, root long, n long"))
    linked = found.groupBy("rep").agg(F.sum("n").alias("n"))
    joined = components(found, "rep", "root").withColumnRenamed("node", "rep")
    smallest = classes.select("rep", "least").join(joined, "rep").groupBy("component").agg(F.min("least").alias("smallest"))
    of_class = cut(
        classes.select("a", "b", "rep", "copies", "least").join(linked, "rep", "left")
        .join(joined, "rep", "left").join(smallest, "component", "left")
        .select("a", "b", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
                F.coalesce("smallest", "least").alias("component"))
    )
    out = rows.select("vec_id", "usable", "a", "b").join(of_class, ["a", "b"], "left").select(
        "vec_id", F.when(F.col("usable"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
