"""Joins on keys where NULL matches NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equally named keys with `<=>`; the result carries the left side's keys.

    Spark runs `<=>` as an equi-join on its own key expressions, so both sides are shuffled right below the join even if
    the right one is grouped by the same keys. That is what lets AQE split a left partition that a hot key makes too
    large (and broadcast a right side that turns out small), so callers keep the right side to one row per key.
    """
    renamed = {k: f"_right_{k}" for k in keys}
    other = right.withColumnsRenamed(renamed)
    condition: Column = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys))
    return left.join(other, condition, how).drop(*renamed.values())


def attach_scalar(df: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """Add the first cell of a one-row table to every row, as a scalar subquery."""
    return df.withColumn(name, table.select(table.columns[0]).limit(1).scalar())
