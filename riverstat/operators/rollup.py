"""Readings -> hours -> days, with the completeness of each day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import grouped


def hourly(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """One row per series and clock hour that has at least one valid value.

    The group holds (series, date, hour), so the readings of a dominating series spread over its hours, and Spark
    aggregates each input partition before the shuffle. A reading without a time belongs to no hour.
    """
    v = F.col(value)
    hours = grouped(
        df.filter(F.col(ts).isNotNull()), [*keys, F.to_date(ts).alias("date"), F.hour(ts).alias("hour")],
        {"hrMean": value},
        F.min(ts).alias("hrDTmin"),
        F.max(ts).alias("hrDTmax"),
        F.count(v).alias("hrN"),
        F.min(v).alias("hrMin"),
        F.max(v).alias("hrMax"),
    )
    return hours.filter(F.col("hrN") > 0)


def daily(
    hours: DataFrame,
    keys: Sequence[str],
    min_hours: int = K.COMPLETE_HOURS,
    est_hours: int = K.ESTIMATED_HOURS,
    cluster: Sequence[str] = (),
) -> DataFrame:
    """One row per series and day; the daily mean is the mean of the hourly means.

    `cluster` names the keys that the hours are placed by, so that this aggregation and the moving windows after it share
    one shuffle. They need not be all keys, and a key that may be a literal should not be among them: Spark takes literals
    out of a grouping, which placed rows then no longer fit. A series has at most 24 rows per calendar day here, however
    many readings it had.
    """
    rows = hours.repartition(*cluster) if cluster else hours
    days = grouped(
        rows, [*keys, "date"], {"dyMean": "hrMean"},
        F.min("hrDTmin").alias("dDTmin"),
        F.max("hrDTmax").alias("dDTmax"),
        F.count(F.lit(1)).alias("hrNday"),
        F.sum("hrN").alias("dyN"),
        F.min("hrMin").alias("dyMin"),
        F.max("hrMax").alias("dyMax"),
    )
    return days.withColumns({
        "ResultStatusID": completeness_status(F.col("hrNday"), min_hours),
        "cmnt": completeness_comment(F.col("hrNday"), min_hours, est_hours),
    })


def completeness_status(hours: Column, min_hours: int = K.COMPLETE_HOURS) -> Column:
    return F.when(hours >= min_hours, F.lit(K.FINAL)).otherwise(F.lit(K.REJECTED))


def completeness_comment(
    hours: Column, min_hours: int = K.COMPLETE_HOURS, est_hours: int = K.ESTIMATED_HOURS
) -> Column:
    def counted(word: str) -> Column:
        return F.concat(
            F.lit(f"{K.GENERATED_COMMENT}; {word} - "), hours.cast("string"), F.lit(" hrs with valid data in day")
        )

    return (
        F.when(hours >= min_hours, F.lit(K.GENERATED_COMMENT))
        .when(hours >= est_hours, counted("Estimated"))
        .otherwise(counted("Rejected"))
    )


def complete_days(days: DataFrame, min_hours: int = K.COMPLETE_HOURS) -> DataFrame:
    return days.filter(F.col("hrNday") >= min_hours)
