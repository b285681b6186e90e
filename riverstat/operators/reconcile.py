"""Compare new results with the results store."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import blank_to_null, clock_hhmm, lookup
from .deploy import instrument_is_location
from .joins import null_safe_join
from .quality import date_window

NEW, DUPLICATE, UPDATE = "new", "suspected duplicate", "suspected update"


@dataclass(frozen=True)
class Columns:
    """Names of the identifying columns in the new results."""

    site: str = "SiteID"
    date: str = "ActStartDate"
    time: str = "ActStartTime"
    characteristic: str = "CharID"
    statistic: str = "StatisticalBasis"
    depth: str = "SmplDepth"
    method: str = "Method"
    result: str = "Result"


MATCH_KEYS = ("k_site", "k_char", "k_date", "k_time", "k_method", "k_depth", "k_stat")


def to_store_statistic(statistic: Column) -> Column:
    return lookup(statistic, K.STORE_STATISTIC, statistic)


def from_store_statistic(statistic: Column) -> Column:
    return lookup(statistic, {v: k for k, v in K.STORE_STATISTIC.items()}, statistic)


def prefilter_existing(
    existing: DataFrame, new: DataFrame, columns: Columns = Columns()
) -> DataFrame:
    """Stored results that could match: of a site and characteristic among the new ones, from the site's first date on.

    The parameters are one row per site and characteristic, reduced before any shuffle.
    """
    site = Window.partitionBy("p_site")
    wanted = (
        new.groupBy(F.col(columns.site).alias("p_site"), F.col(columns.characteristic).alias("p_char"))
        .agg(F.min(F.col(columns.date).cast("date")).alias("p_date"))
        .withColumn("p_min", F.min("p_date").over(site))
    )
    return existing.join(
        wanted,
        (F.col("MLocID") == F.col("p_site"))
        & (F.col("Char_Name") == F.col("p_char"))
        & (F.col("SampleStartDate").cast("date") >= F.col("p_min")),
        "left_semi",
    )


def _new_keys(columns: Columns) -> dict[str, Column]:
    return {
        "k_site": F.col(columns.site),
        "k_char": F.col(columns.characteristic),
        "k_date": F.col(columns.date).cast("date"),
        "k_time": clock_hhmm(F.col(columns.time)),
        "k_method": F.col(columns.method),
        "k_depth": blank_to_null(F.col(columns.depth)),
        "k_stat": to_store_statistic(F.col(columns.statistic)),
    }


def _stored_keys() -> dict[str, Column]:
    return {
        "k_site": F.col("MLocID"),
        "k_char": F.col("Char_Name"),
        "k_date": F.col("SampleStartDate").cast("date"),
        "k_time": clock_hhmm(F.col("SampleStartTime")),
        "k_method": F.col("Method_Code"),
        "k_depth": blank_to_null(F.col("act_depth_height")),
        "k_stat": F.col("Statistical_Base"),
    }


def stored_rows_matched(new: DataFrame, existing: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """Every stored row that shares its key with a new row, once, with the match keys.

    Together with the keys of the new rows this lists all pairs without making them: one row per stored row, however
    often its key was sent.
    """
    sent = new.select(*(key.alias(name) for name, key in _new_keys(columns).items())).distinct()
    return null_safe_join(existing.withColumns(_stored_keys()), sent, MATCH_KEYS, "left_semi")


def _one_key(keys: dict[str, Column]) -> dict[str, Column]:
    """The match keys as one struct, in which NULL equals NULL, and its hash, by which rows are sorted and told apart first."""
    return {"_hash": F.xxhash64(*keys.values()), "_key": F.struct(*(k.alias(n) for n, k in keys.items()))}


def classify_duplicates(new: DataFrame, existing: DataFrame, columns: Columns = Columns()) -> DataFrame:
    """Class of each new row: no stored match, a match with the same result, a match with another result.

    A row whose matches include both appears once in each class. The store is reduced to a row per key and result, and that
    to a row per key, so both lookups add at most one row to each new row, however often a key is stored or sent.
    `stored_matches` counts the stored rows, `stored_result` and `stored_uid` show one of them; `stored_rows_matched` has all
    of them. Where `stored_uid` is not asked for, both reductions are hash aggregations and the store is scanned once. Both
    sides are shuffled right below each join, so AQE can split the partition of a hot key.
    """
    sent = new.withColumns({**_one_key(_new_keys(columns)), "_result": F.col(columns.result).cast("double")})
    stored = existing.select(
        *(key.alias(name) for name, key in _one_key(_stored_keys()).items()),
        F.col("Result").cast("double").alias("result"), F.col("Result_UID").alias("uid"),
    )
    same = stored.groupBy("_hash", "_key", "result").agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("uid"))
    missing = F.col("result").isNull()
    of_key = same.groupBy("_hash", "_key").agg(
        F.sum("n").alias("n_any"), F.min("result").alias("low"), F.max("result").alias("high"),
        F.min_by("uid", "result").alias("low_uid"), F.max_by("uid", "result").alias("high_uid"),
        F.min(F.when(missing, F.col("uid"))).alias("missing_uid"),
    )
    same = same.select("_hash", "_key", F.col("result").alias("_result"), F.col("n").alias("n_same"), F.col("uid").alias("same_uid"))
    matched = null_safe_join(sent, of_key, ["_hash", "_key"], "left")
    matched = null_safe_join(matched, same, ["_hash", "_key", "_result"], "left")

    n_same = F.coalesce(F.col("n_same"), F.lit(0))
    is_low, is_high = F.col("low").eqNullSafe(F.col("_result")), F.col("high").eqNullSafe(F.col("_result"))
    # Any result but the row's own; where the only number is the row's, the other ones are missing.
    low, high = F.col("low").isNotNull() & ~is_low, F.col("high").isNotNull() & ~is_high
    duplicate = F.col("dup_class") == DUPLICATE
    update = F.col("dup_class") == UPDATE
    classes = F.when(F.col("n_any").isNull(), F.array(F.lit(NEW))).otherwise(
        F.array_compact(F.array(F.when(n_same > 0, DUPLICATE), F.when(F.col("n_any") > n_same, UPDATE)))
    )
    return matched.withColumn("dup_class", F.explode(classes)).select(
        *new.columns, "dup_class",
        F.when(duplicate, n_same).when(update, F.col("n_any") - n_same).otherwise(F.lit(0)).cast("bigint").alias("stored_matches"),
        F.when(duplicate, F.col("_result")).when(update & low, F.col("low")).when(update & high, F.col("high"))
        .alias("stored_result"),
        F.when(duplicate, F.col("same_uid")).when(update & low, F.col("low_uid")).when(update & high, F.col("high_uid"))
        .when(update, F.col("missing_uid")).alias("stored_uid"),
    )


def duplicate_views(classified: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """The three tables: new rows with their own columns, duplicates and updates with what is stored."""
    return {
        "non_duplicates": classified.filter(F.col("dup_class") == NEW).select(*columns),
        "suspected_dups": classified.filter(F.col("dup_class") == DUPLICATE).drop("dup_class"),
        "suspected_updates": classified.filter(F.col("dup_class") == UPDATE).drop("dup_class"),
    }


def check_duplicates(
    new: DataFrame, existing: DataFrame, columns: Columns = Columns(),
    hold: Callable[[DataFrame], DataFrame] = lambda table: table,
) -> dict[str, DataFrame]:
    """The three tables, and `stored_matches`: all stored rows that the duplicates and updates match.

    `hold` is applied to what feeds several of them (see `sinks.hold`).
    """
    candidates = hold(prefilter_existing(existing, new, columns))
    views = duplicate_views(hold(classify_duplicates(new, candidates, columns)), new.columns)
    return {**views, "stored_matches": stored_rows_matched(new, candidates, columns)}


# Column of the store -> column of the import file
_STORED_NAMES = {
    "MLocID": "SiteID", "act_id": "ActivityID", "SampleStartDate": "ActStartDate", "Char_Name": "CharID",
    "Result_Numeric": "Result", "Result_Unit": "Unit", "Statistical_Base": "StatisticalBasis",
}
STORED_KEYS = ("CharID", "Result", "Unit", "StatisticalBasis", "SiteID", "ActStartDate", "ActivityID")


def stored_results(
    existing: DataFrame, new: DataFrame, organization: str, start: str, end: str
) -> DataFrame:
    """Stored results of one organisation, of the sites at hand and inside the date window, under the import's names."""
    window = date_window(
        existing.filter(F.col("OrganizationID") == organization), F.col("SampleStartDate"), start, end
    )
    named = window.select(*(F.col(c).alias(n) for c, n in _STORED_NAMES.items()))
    typed = named.withColumns({
        "ActStartDate": F.col("ActStartDate").cast("date"),
        "StatisticalBasis": from_store_statistic(F.col("StatisticalBasis")),
    })
    return null_safe_join(
        typed.filter(F.col("SiteID").isNotNull()), new.select("SiteID").distinct(), ["SiteID"], "left_semi"
    )


def drop_existing(new: DataFrame, existing: DataFrame, keys: Sequence[str] = STORED_KEYS) -> DataFrame:
    """New rows without an equal stored row; NULL keys match NULL."""
    return null_safe_join(new, existing.select(*keys).distinct(), keys, "left_anti")


def new_deployments(deployed: DataFrame, known: DataFrame, organization: str | None = None) -> DataFrame:
    """Deployments at locations the store has no equipment for: left open, instrument named after the location."""
    if organization is not None:
        known = known.filter(F.col("OrganizationID") == organization)
    locations = known.select(F.col("MLocID").alias("Monitoring_Location_ID")).distinct()
    fresh = deployed.join(locations, "Monitoring_Location_ID", "left_anti")
    return instrument_is_location(fresh).withColumn("Activity_end_date_time", F.lit(""))
