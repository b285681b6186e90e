"""Registry of the queries and pieces shared by their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of the tables under `name`, with equivalent SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def text_dates(df: DataFrame, *names: str) -> DataFrame:
    """Dates as text, so that results compare the same whatever reads them."""
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd") for n in names})


def mean_sql(value: str, over: str = "") -> str:
    """Sum of the values, as multiples of 2^-64 in 128 bits and so without rounding, by their count.

    The sum becomes a double through two parts of fewer than 53 bits, so it is rounded once.
    """
    window = f" OVER {over}" if over else ""
    total = f"sum(CAST({value} * 18446744073709551616e0 AS HUGEINT)){window}"
    high, low = f"CAST({total} // 1125899906842624 AS DOUBLE)", f"CAST({total} % 1125899906842624 AS DOUBLE)"
    return f"(({high} * 1125899906842624e0 + {low}) / 18446744073709551616e0 / count({value}){window})"


def round_sql(value: str, digits: int) -> str:
    """Nearer neighbour with `digits` decimals, ties to even."""
    p = f"1e{digits}"
    v = f"({value})"
    low, high = f"(floor({v} * {p}) / {p})", f"(ceil({v} * {p}) / {p})"
    return (
        f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} - {low} < {high} - {v}"
        f" OR ({v} - {low} = {high} - {v} AND CAST(floor({v} * {p}) AS BIGINT) % 2 = 0) THEN {low} ELSE {high} END"
    )


def moving_sql(value: str, days: int, row: str = "row", frame: str | None = None) -> str:
    """Moving mean with its coverage and warm-up rules, over a window named f<days>."""
    f = frame or f"f{days}"
    return f"CASE WHEN count(*) OVER {f} >= {days - 1} AND {row} >= {days} THEN {mean_sql(value, f)} END"


def windows_sql(keys: str, day: str = "date", *lengths: int) -> str:
    """WINDOW clause with one range frame per length."""
    return "WINDOW " + ", ".join(
        f"f{n} AS (PARTITION BY {keys} ORDER BY {day} RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND CURRENT ROW)"
        for n in lengths
    )


def hours_sql(source: str, keys: str, ts: str, value: str) -> str:
    return (
        f"SELECT {keys}, CAST({ts} AS DATE) AS date, hour({ts}) AS hour, min({ts}) AS hrDTmin, max({ts}) AS hrDTmax,"
        f" count({value}) AS hrN, {mean_sql(value)} AS hrMean, min({value}) AS hrMin, max({value}) AS hrMax"
        f" FROM {source} WHERE {ts} IS NOT NULL GROUP BY ALL HAVING count({value}) > 0"
    )


def days_sql(hours: str, keys: str) -> str:
    return (
        f"SELECT {keys}, date, min(hrDTmin) AS dDTmin, max(hrDTmax) AS dDTmax, count(*) AS hrNday,"
        f" CAST(sum(hrN) AS BIGINT) AS dyN, {mean_sql('hrMean')} AS dyMean, min(hrMin) AS dyMin, max(hrMax) AS dyMax"
        f" FROM {hours} GROUP BY {keys}, date"
    )


def boxes_sql(source: str, keys: str, value: str) -> str:
    """CTEs `q` (quartiles per key, interpolated between the two neighbouring values) and `x` (values with `inside`)."""

    def quantile(p: float) -> str:
        low, high = f"s[CAST(floor(h * {p}) AS BIGINT) + 1]", f"s[CAST(ceil(h * {p}) AS BIGINT) + 1]"
        share = f"(h * {p} - floor(h * {p}))"
        return f"CASE WHEN {low} = {high} THEN {low} ELSE (1 - {share}) * {low} + {share} * {high} END"

    same = " AND ".join(f"t.{k} IS NOT DISTINCT FROM q.{k}" for k in keys.split(", "))
    return f"""l AS (SELECT {keys}, list_sort(list({value})) AS s, CAST(count(*) - 1 AS DOUBLE) AS h FROM {source}
      WHERE {value} IS NOT NULL GROUP BY {keys}),
q AS (SELECT {keys}, {quantile(0.25)} AS q1, {quantile(0.5)} AS median, {quantile(0.75)} AS q3, s[1] AS minimum,
             s[-1] AS maximum FROM l),
x AS (SELECT q.*, t.{value} AS v, t.{value} >= q1 - 1.5e0 * (q3 - q1) AND t.{value} <= q3 + 1.5e0 * (q3 - q1) AS inside
      FROM {source} t JOIN q ON {same} WHERE t.{value} IS NOT NULL)"""


STATUS_SQL = "CASE WHEN hrNday >= 22 THEN 'Final' ELSE 'Rejected' END"
COMMENT_SQL = (
    "CASE WHEN hrNday >= 22 THEN 'Generated by ORDEQ'"
    " WHEN hrNday >= 20 THEN 'Generated by ORDEQ; Estimated - ' || hrNday || ' hrs with valid data in day'"
    " ELSE 'Generated by ORDEQ; Rejected - ' || hrNday || ' hrs with valid data in day' END"
)
BASIS_SQL = (
    "CASE WHEN StatisticalBasis IN ('7DMADMin', '7DMADMean', '7DMADMax') THEN '7 Day'"
    " WHEN StatisticalBasis = '30DMADMean' THEN '30 Day' ELSE '1 Day' END"
)


def long_sql(source: str, ids: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{name}' AS StatisticalBasis, {column} AS Result FROM {source} WHERE {column} IS NOT NULL"
        for column, name in columns.items()
    )


STATISTICS = {
    "dyMax": "Daily Maximum", "dyMin": "Daily Minimum", "dyMean": "Daily Mean", "ma_min7": "7DMADMin",
    "ma_mean7": "7DMADMean", "ma_max7": "7DMADMax", "ma_mean30": "30DMADMean",
}
