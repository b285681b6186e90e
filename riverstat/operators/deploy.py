"""Instrument deployments: the extent of each station and instrument."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import months_instrument_id


def deployments(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    zone: Column,
    pad: str | None = None,
    names: tuple[str, str, str] = ("startdate", "enddate", "TZ"),
) -> DataFrame:
    """First and last reading per key and the zone of the first one.

    `pad` is an interval literal added to the last reading (`5 MINUTES`); without it the deployment stays open ("").
    The readings are reduced per key and zone by plain min/max, before the shuffle; the few rows left are then merged.
    """
    start, end, tz = names
    zoned = df.groupBy(*keys, zone.alias("_zone")).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    last = F.lit("") if pad is None else F.max("_last") + F.expr(f"INTERVAL {pad}")
    earliest = F.min(F.struct(F.col("_first").isNull().alias("_undated"), "_first", "_zone"))
    return zoned.groupBy(*keys).agg(
        F.min("_first").alias(start), last.alias(end), earliest["_zone"].alias(tz)
    )


def import_form(df: DataFrame, project: str) -> DataFrame:
    """Add the constant columns of the deployment import."""
    blank = ("Alternate_Project_ID", "Alternate_Project_ID2", "Frequency_on_minutes", "Depth_in_m")
    return df.withColumns({
        "Media": F.lit("Water"),
        "Media_subdivision": F.lit("Surface Water"),
        "Project_ID": F.lit(project),
        **{c: F.lit("") for c in blank},
    })


IMPORT_NAMES = ("Activity_start_date_time", "Activity_end_date_time", "Activity_start_end_time_Zone")


def with_instrument_id(df: DataFrame, location: str = "Monitoring_Location_ID") -> DataFrame:
    start, end, _ = IMPORT_NAMES
    return df.withColumn("Equipment_ID", months_instrument_id(F.col(location), F.col(start), F.col(end)))


def attach_instrument(readings: DataFrame, deployed: DataFrame, location: str) -> DataFrame:
    """Add each reading's instrument. One row per location on the right: the result has the readings' rows.

    Which side is broadcast, if any, is left to the measured size of the deployments; locations without an ID match
    each other, as they did when the deployments were built.
    """
    from .joins import null_safe_join

    return null_safe_join(readings, deployed.select(location, "Equipment_ID"), [location], "left")


def instrument_is_location(df: DataFrame, location: str = "Monitoring_Location_ID") -> DataFrame:
    return df.withColumn("Equipment_ID", F.col(location))


def first_deployment(df: DataFrame, location: str, start: str) -> DataFrame:
    """Earliest deployment of each location (one without a start only if there is no other), ties by the other columns.

    The smallest row as an aggregate, not a sorted window: a location with many rows is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in (location, start)]
    undated = F.col(start).isNull().alias("_undated")
    first = df.groupBy(location).agg(F.min(F.struct(undated, start, *rest)).alias("_first"))
    return first.select(location, *(F.col(f"_first.{c}").alias(c) for c in (start, *rest))).select(*df.columns)
