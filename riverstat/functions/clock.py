"""Dates and clock times. Times are wall clock (TIMESTAMP_NTZ); unparsable text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


_TIME = r"^\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"
_MDY = r"^\s*(\d{1,2})[-/](\d{1,2})[-/](\d{4})"
_MDY_DATE = _MDY + r"(\s.*)?$"
_MDY_TIME = _MDY + r"\s+(\d{1,2}):(\d{2})(:\d{2})?\s*$"


def iso_datetime(date: Column, time: Column) -> Column:
    """Date column and `H:mm` or `H:mm:ss` text -> wall-clock timestamp."""
    full = F.when(time.rlike(r"^\d{1,2}:\d{2}$"), F.concat(time, F.lit(":00"))).otherwise(time)
    text = F.concat(date.cast("string"), F.lit(" "), full)
    return F.when(time.rlike(_TIME), text.try_cast("timestamp_ntz"))


def mdy_datetime(text: Column) -> Column:
    """`M/d/yyyy H:mm` -> wall-clock timestamp."""
    iso = F.regexp_replace(text, _MDY_TIME, "$3-$1-$2 $4:$5:00")
    return F.when(text.rlike(_MDY_TIME), iso.try_cast("timestamp_ntz"))


def mdy_date(text: Column) -> Column:
    """`MM-dd-yyyy` or `M/d/yyyy`, with any clock time after it -> date."""
    iso = F.regexp_replace(text, _MDY_DATE, "$3-$1-$2")
    return F.when(text.rlike(_MDY_DATE), iso.try_cast("date"))


def wall_clock(text: Column, zone: str) -> Column:
    """ISO text -> wall clock of `zone`; text without an offset already is wall clock."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    moved = F.convert_timezone(None, F.lit(zone), text.try_cast("timestamp"))
    return F.when(zoned, moved).otherwise(text.try_cast("timestamp_ntz"))


# Wall clocks are formatted from their own text: pattern formatting would read them in the session's zone first, where a
# clock time that daylight saving skips does not exist.


def hour_key(ts: Column) -> Column:
    """Hour of the series as text: year, day of year, hour."""
    def padded(number: Column, width: int) -> Column:
        return F.lpad(number.cast("string"), width, "0")

    return F.concat_ws("-", padded(F.year(ts), 4), padded(F.dayofyear(ts), 3), padded(F.hour(ts), 2))


def date_text(ts: Column, separator: str = "-") -> Column:
    """Year, month and day of a date or wall clock."""
    text = ts.cast("date").cast("string")
    return text if separator == "-" else F.replace(text, F.lit("-"), F.lit(separator))


def month_text(ts: Column) -> Column:
    """Year and month without a separator."""
    return F.substring(compact_date(ts), 1, 6)


def time_text(ts: Column) -> Column:
    """Clock time to the second."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 12, 8)


def compact_date(date: Column) -> Column:
    return date_text(date, "")


def clock_hhmm(text: Column) -> Column:
    """`H:MM[:SS]` -> `HH:MM`, row by row."""
    parts = F.split(text, ":")
    return F.concat(F.lpad(F.trim(F.get(parts, F.lit(0))), 2, "0"), F.lit(":"), F.get(parts, F.lit(1)))
