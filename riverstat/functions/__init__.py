from .clock import (
    clock_hhmm,
    compact_date,
    date_text,
    hour_key,
    iso_datetime,
    mdy_date,
    mdy_datetime,
    month_text,
    time_text,
    wall_clock,
)
from .exact import grouped
from .numeric import fahrenheit_to_celsius, round_nearest
from .text import (
    activity_id,
    base_identifier,
    blank_to_null,
    lookup,
    months_instrument_id,
    null_to_blank,
    number_text,
    series_key,
    strip_blanks,
)

__all__ = [
    "activity_id", "base_identifier", "blank_to_null", "clock_hhmm", "compact_date", "date_text",
    "fahrenheit_to_celsius", "grouped", "hour_key", "iso_datetime", "lookup", "mdy_date", "mdy_datetime",
    "month_text", "months_instrument_id", "null_to_blank", "number_text",
    "round_nearest", "series_key",
    "strip_blanks", "time_text", "wall_clock",
]
