"""Text: keys, identifiers, blanks and small fixed lookups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clock import compact_date, month_text


def lookup(key: Column, values: Mapping[str, str], otherwise: Column | str | None = None) -> Column:
    """Value of a small fixed table by key, as one CASE expression (no join)."""
    if otherwise is None or isinstance(otherwise, str):
        otherwise = F.lit(otherwise)
    case = None
    for k, v in values.items():
        case = F.when(key == k, F.lit(v)) if case is None else case.when(key == k, F.lit(v))
    return otherwise if case is None else case.otherwise(otherwise)


def series_key(*parts: Column) -> Column:
    """Series label for output; grouping is on the columns themselves, which cannot collide."""
    return F.concat_ws("-", *parts)


def activity_id(site: Column, date: Column, activity_type: Column) -> Column:
    return F.concat_ws(":", site, compact_date(date), activity_type)


def months_instrument_id(site: Column, start: Column, end: Column) -> Column:
    """Instrument named after its station and the months of its deployment."""
    return F.concat_ws("-", site, month_text(start), month_text(end))


def base_identifier(text: Column) -> Column:
    """Text before the first `@`."""
    return F.regexp_replace(text, "@.*$", "")


def strip_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def number_text(value: Column) -> Column:
    """Number as text, whole ones without decimals."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def null_to_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))
