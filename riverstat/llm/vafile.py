"""Exact nearest vectors by inner product with vector-approximation files.

Every component of a vector is a whole number. An approximation file holds for each vector only in which of 64 cells of
equal width each component lies. For a query q, the middle of the cells and the sum of |q| * half the cell's width
bound the inner product from both sides. A block of vectors is scanned by these bounds alone; vectors whose upper bound
reaches the k-th largest lower bound are then read exactly, in the order of their bounds, until the k-th best score is above
the upper bound of all that are unread. That is certain, so nothing is missed, whatever the data.

Queries and vectors are dealt by hashes into blocks, and every block of queries meets every block of vectors in one task (the
work that an exact search without an index over the queries has). A task returns k rows a query; the best of these are
ranked after Spark has cut each partition to the k best of a query.

Defined cases: vectors that are null or hold null or non-finite components, and rows without vec_id, take no part; where a
vec_id repeats, each of its rows is a vector and a query of its own, none of which meets rows of its own vec_id, and the k best of
all its queries' results are ranked together, as in the SQL; a query meets only vectors of its own length; ties go to the smaller
vec_id; an empty table gives no rows; other columns are ignored. Components beyond 2^52 / scale are not supported and
raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship

CELLS = 64
BLOCK_VECTORS, BLOCK_QUERIES = 8192, 1024
READ = 64  # vectors of one query that are read exactly at a time


class Approximations:
    """Cells of a block of whole-numbered vectors (n, d)."""

    def __init__(self, exact: np.ndarray, cells: int = CELLS) -> None:
        self.exact = exact
        self._low = exact.min(0).astype(np.float64)
        self._width = np.maximum((exact.max(0) - self._low) / cells, 1e-9)
        self.cells = np.minimum(((exact - self._low) / self._width).astype(np.int64), cells - 1).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries, n) of the inner products, a little wider than rounding could make them."""
        middle = self._low + (self.cells + 0.5) * self._width
        q = queries.astype(np.float64)
        near, reach = q @ middle.T, (np.abs(q) @ (self._width / 2))[:, None]
        slack = 1e-9 * (np.abs(q) @ np.abs(middle).max(0, initial=0))[:, None] + 1e-6
        return near - reach - slack, near + reach + slack

    def nearest(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
        """(score, id) of each query's k best vectors, best first; its own id is left out."""
        lower, upper = self.bounds(queries)
        mine = own[:, None] == ids[None, :]
        lower[mine] = upper[mine] = -np.inf
        out = []
        for q in range(len(queries)):
            many = int((~mine[q]).sum())
            some = min(k, many)
            if not some:
                out.append([])
                continue
            certain = np.partition(lower[q], len(ids) - some)[len(ids) - some]
            candidates = np.flatnonzero((upper[q] >= certain) & ~mine[q])
            candidates = candidates[np.argsort(-upper[q, candidates], kind="stable")]
            best: list[tuple[int, int]] = []  # (-score, id)
            for at in range(0, len(candidates), READ):
                if len(best) == k and -best[-1][0] > upper[q, candidates[at]]:
                    break
                read = candidates[at:at + READ]
                score = _product(self.exact[read], queries[q])
                best = sorted([*best, *zip((-score).tolist(), ids[read].tolist())])[:k]
            out.append([(-s, i) for s, i in best])
        return out


def _product(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products, with Python's integers where 64 bits might not do."""
    if np.abs(vectors).max(initial=0).astype(float) * np.abs(query).max(initial=0) * max(1, len(query)) < 2.0 ** 62:
        return vectors @ query
    score = vectors.astype(object) @ query.astype(object)
    if max(map(abs, score)) >= 1 << 63:
        raise OverflowError("a score does not fit 64 bits")
    return score


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024,
    block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score from vec_id, embedding; queries are the rows for which `is_query` holds."""
    ship(vectors.sparkSession)
    real = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & (F.size("embedding") > 0)
    largest = 2.0 ** 52
    whole = F.transform(real, lambda x: F.when(F.abs(x * scale) < largest, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit("component too large")).cast("long")))
    number = F.monotonically_increasing_id().alias("row")  # rows of one vec_id are dealt apart
    rows = vectors.filter(usable).select("vec_id", is_query.alias("asks"), "embedding")
    rows = cut(rows.select("vec_id", "asks", F.size("embedding").alias("size"), whole.alias("whole"), number))
    vector_blocks = max(1, -(-rows.count() // block_vectors))
    queries = rows.filter("asks")
    query_blocks = max(1, -(-queries.count() // block_queries))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        """Each row in its block, once for every block of the other side."""
        block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
        return df.select("vec_id", "size", "whole", block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    asked = dealt(queries, "qb", query_blocks, "vb", vector_blocks).groupBy("qb", "vb", "size")
    held = dealt(rows, "vb", vector_blocks, "qb", query_blocks).groupBy("qb", "vb", "size")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            right = right.sort_values("vec_id")
            file = Approximations(np.stack(right["whole"].to_numpy()))
            ids, own = right["vec_id"].to_numpy(), left["vec_id"].to_numpy()
            asked_for = np.stack(left["whole"].to_numpy())
            for at in range(0, len(own), 128):
                part = file.nearest(asked_for[at:at + 128], ids, own[at:at + 128], k)
                found += [(q, i, s) for q, best in zip(own[at:at + 128].tolist(), part) for s, i in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    best = asked.cogroup(held).applyInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
