"""Wide tables to one row per value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def to_statistics(
    df: DataFrame, ids: Sequence[str], columns: Mapping[str, str] = K.STATISTIC_COLUMNS
) -> DataFrame:
    """One row per statistic (`StatisticalBasis`, `Result`); absent columns and NULL values give no row."""
    present = {c: name for c, name in columns.items() if c in df.columns}
    # `inline` and not `unpivot`: what templates compute above an Expand does not compile to Java.
    cells = F.array(*(
        F.struct(F.lit(name).alias("StatisticalBasis"), F.col(c).alias("Result")) for c, name in present.items()
    ))
    return df.select(*ids, F.inline(cells)).filter(F.col("Result").isNotNull())


def flagged_long(
    df: DataFrame,
    ids: Sequence[str],
    pairs: Mapping[str, tuple[str, str]],
    name: str,
    value: str,
    flag: str,
    keep_null: bool = False,
) -> DataFrame:
    """One row per (value, flag) pair: `pairs` maps the name of the row to its value and flag columns."""
    cells = F.array(*(
        F.struct(F.lit(n).alias(name), F.col(v).cast("double").alias(value), F.col(f).alias(flag))
        for n, (v, f) in pairs.items()
    ))
    long = df.select(*ids, F.inline(cells))
    return long if keep_null else long.filter(F.col(value).isNotNull())


def any_of_long(df: DataFrame, ids: Sequence[str], known: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per known column that the table happens to have; NULL values stay."""
    present = [c for c in known if c in df.columns]
    if not present:
        raise ValueError("none of the known value columns is present")
    return df.select(*ids, *(F.col(c).try_cast("double").alias(c) for c in present)).unpivot(
        list(ids), present, name, value
    )


def with_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns (name -> type) as NULL."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def stack(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; a column one of them lacks is NULL there."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
