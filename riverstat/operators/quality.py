"""Unit and quality-flag normalisation of readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import fahrenheit_to_celsius, lookup


def normalise_units(df: DataFrame, value: str = "Result_Value", unit: str = "Result_Unit") -> DataFrame:
    """Add `r` and `r_units`: deg F becomes deg C, other units stay, an unknown unit leaves no value."""
    is_f = F.col(unit) == "deg F"
    return df.withColumns({
        "r": F.when(is_f, fahrenheit_to_celsius(F.col(value))).when(F.col(unit).isNotNull(), F.col(value)),
        "r_units": F.when(is_f, F.lit("deg C")).otherwise(F.col(unit)),
    })


def drop_rejected(df: DataFrame, status: str = "Result_Status_ID") -> DataFrame:
    """Drop rejected readings, and those without a status."""
    return df.filter(F.col(status) != K.REJECTED)


def keep_grades(
    df: DataFrame, grade: str, approval: str, grades: Sequence[int], approvals: Sequence[int]
) -> DataFrame:
    """Keep rows of the listed grades and approval levels; rows without either are dropped."""
    return df.filter(F.col(grade).isin(*grades) & F.col(approval).isin(*approvals))


def drop_qualifiers(df: DataFrame, qualifier: str, dropped: Sequence[str] = K.DROPPED_QUALIFIERS) -> DataFrame:
    """Drop rows with a listed qualifier, and those without any."""
    return df.filter(~F.col(qualifier).isin(*dropped))


def keep_site_types(df: DataFrame, site_type: str, excluded: Sequence[str] = K.EXCLUDED_SITE_TYPES) -> DataFrame:
    """Drop listed site types; sites without a type stay."""
    return df.filter(F.col(site_type).isNull() | ~F.col(site_type).isin(*excluded))


def date_window(df: DataFrame, date: Column, start: str, end: str, look_back: int = 0) -> DataFrame:
    """Rows dated from `look_back` days before `start` up to `end`, compared as dates."""
    first = F.date_sub(F.lit(start).cast("date"), look_back)
    return df.filter(date.cast("date").between(first, F.lit(end).cast("date")))


def repair_characteristic(df: DataFrame, name: str, repairs: Mapping[str, str]) -> DataFrame:
    return df.withColumn(name, lookup(F.col(name), repairs, F.col(name)))


def station_identifier(
    station: Column, prefix: str = K.JSON_PORTAL_PREFIX, aliases: Mapping[str, str] = K.JSON_PORTAL_ALIASES
) -> Column:
    """Station with the organisation's prefix, known aliases replaced."""
    full = F.concat(F.lit(prefix), station)
    return lookup(full, aliases, full)
