"""Roll-ups and moving statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverstat.functions import grouped, hour_key
from riverstat.operators.moving import MAX_7, MEAN_7, MEAN_30, MIN_7, MovingMean, moving
from riverstat.operators.reshape import to_statistics
from riverstat.operators.rollup import complete_days, daily, hourly

from .registry import (
    COMMENT_SQL,
    STATISTICS,
    STATUS_SQL,
    Tables,
    days_sql,
    hours_sql,
    long_sql,
    mean_sql,
    moving_sql,
    query,
    text_dates,
    windows_sql,
)

EVENT_HOURS = hours_sql("events", "event_type", "ts", "value")
EVENT_DAYS = f"WITH hr AS ({EVENT_HOURS}), dy AS ({days_sql('hr', 'event_type')})"


@query("hourly_rollup", f"""
SELECT event_type, strftime(hrDTmin, '%Y-%j-%H') AS hr, strftime(date, '%Y-%m-%d') AS date, hrDTmin, hrDTmax, hrN,
       hrMean, hrMin, hrMax
FROM ({EVENT_HOURS})""")
def hourly_rollup(t: Tables) -> DataFrame:
    hours = hourly(t.events, ["event_type"], "ts", "value").withColumn("hr", hour_key(F.col("hrDTmin")))
    return text_dates(hours.drop("hour"), "date")


@query("daily_rollup", f"""{EVENT_DAYS}
SELECT event_type, strftime(date, '%Y-%m-%d') AS date, dDTmin, dDTmax, hrNday, dyN, dyMean, dyMin, dyMax FROM dy""")
def daily_rollup(t: Tables) -> DataFrame:
    days = daily(hourly(t.events, ["event_type"], "ts", "value"), ["event_type"])
    return text_dates(days.drop("ResultStatusID", "cmnt"), "date")


USER_HOURS = hours_sql("events", "user_id, event_type", "ts", "value")


@query("daily_completeness", f"""
WITH u AS ({USER_HOURS}), e AS ({EVENT_HOURS}),
     dy AS (SELECT concat_ws('-', user_id, event_type) AS series, date, hrNday
            FROM ({days_sql('u', 'user_id, event_type')})
            UNION ALL SELECT event_type, date, hrNday FROM ({days_sql('e', 'event_type')}))
SELECT series, strftime(date, '%Y-%m-%d') AS date, hrNday, {STATUS_SQL} AS ResultStatusID, {COMMENT_SQL} AS cmnt
FROM dy""")
def daily_completeness(t: Tables) -> DataFrame:
    users = ["user_id", "event_type"]
    sparse = daily(hourly(t.events, users, "ts", "value"), users)
    dense = daily(hourly(t.events, ["event_type"], "ts", "value"), ["event_type"])
    shown = ("date", "hrNday", "ResultStatusID", "cmnt")
    label = F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("series")
    rows = sparse.select(label, *shown).unionByName(dense.select(F.col("event_type").alias("series"), *shown))
    return text_dates(rows, "date")


@query("complete_days", f"""{EVENT_DAYS}
SELECT event_type, strftime(date, '%Y-%m-%d') AS date, hrNday, dyMax FROM dy WHERE hrNday >= 22""")
def complete(t: Tables) -> DataFrame:
    days = complete_days(daily(hourly(t.events, ["event_type"], "ts", "value"), ["event_type"]))
    return text_dates(days.select("event_type", "date", "hrNday", "dyMax"), "date")


# lineitem as a daily series: one station per return flag and line status
SHIP_KEYS = ["l_returnflag", "l_linestatus"]
SHIP_KEYS_SQL = "l_returnflag, l_linestatus"
SHIP_DAYS = f"""dy AS (
    SELECT {SHIP_KEYS_SQL}, CAST(l_shipdate AS DATE) AS date, min(l_shipdate) AS dDTmin, max(l_shipdate) AS dDTmax,
           max(l_quantity) AS dyMax, min(l_quantity) AS dyMin, {mean_sql('l_quantity')} AS dyMean
    FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL),
rn AS (SELECT *, row_number() OVER (PARTITION BY {SHIP_KEYS_SQL} ORDER BY date) AS row FROM dy)"""
SHIP_WINDOWS = windows_sql(SHIP_KEYS_SQL, "date", 7, 30)


def ship_days(t: Tables, *keys: str) -> DataFrame:
    q = F.col("l_quantity")
    lines = t.lineitem.withColumn("site_no", F.concat("l_returnflag", "l_linestatus"))
    return grouped(
        lines, [*(keys or SHIP_KEYS), F.to_date("l_shipdate").alias("date")], {"dyMean": "l_quantity"},
        F.min("l_shipdate").alias("dDTmin"), F.max("l_shipdate").alias("dDTmax"), F.max(q).alias("dyMax"),
        F.min(q).alias("dyMin"),
    )


@query("mov7_max", f"""WITH {SHIP_DAYS}
SELECT {SHIP_KEYS_SQL}, strftime(date, '%Y-%m-%d') AS date, row, dyMax, {moving_sql('dyMax', 7)} AS ma_max7,
       min(dDTmin) OVER f7 AS ana_startdate7, max(dDTmax) OVER f7 AS ana_enddate7
FROM rn {SHIP_WINDOWS}""")
def mov7_max(t: Tables) -> DataFrame:
    moved = moving(ship_days(t), SHIP_KEYS, "date", [MAX_7], bounds=("dDTmin", "dDTmax"))
    return text_dates(moved.drop("dDTmin", "dDTmax", "dyMin", "dyMean"), "date")


@query("mov7_mean_min", f"""WITH {SHIP_DAYS}
SELECT {SHIP_KEYS_SQL}, strftime(date, '%Y-%m-%d') AS date, {moving_sql('dyMean', 7)} AS ma_mean7,
       {moving_sql('dyMin', 7)} AS ma_min7
FROM rn {SHIP_WINDOWS}""")
def mov7_mean_min(t: Tables) -> DataFrame:
    moved = moving(ship_days(t), SHIP_KEYS, "date", [MEAN_7, MIN_7])
    return text_dates(moved.select(*SHIP_KEYS, "date", "ma_mean7", "ma_min7"), "date")


@query("mov30_mean", f"""WITH {SHIP_DAYS}
SELECT {SHIP_KEYS_SQL}, strftime(date, '%Y-%m-%d') AS date, {moving_sql('dyMean', 30)} AS ma_mean30,
       min(dDTmin) OVER f30 AS ana_startdate30, max(dDTmax) OVER f30 AS ana_enddate30
FROM rn {SHIP_WINDOWS}""")
def mov30_mean(t: Tables) -> DataFrame:
    moved = moving(ship_days(t), SHIP_KEYS, "date", [MEAN_30], bounds=("dDTmin", "dDTmax"))
    return text_dates(
        moved.select(*SHIP_KEYS, "date", "ma_mean30", "ana_startdate30", "ana_enddate30"), "date"
    )


@query("mov7_null_poison", f"""WITH {SHIP_DAYS}, x AS (SELECT *, nullif(dyMin, 1) AS low FROM rn)
SELECT {SHIP_KEYS_SQL}, strftime(date, '%Y-%m-%d') AS date, low,
       CASE WHEN count(low) OVER f7 = count(*) OVER f7 THEN {moving_sql('low', 7)} END AS ma_low7
FROM x {SHIP_WINDOWS}""")
def mov7_null_poison(t: Tables) -> DataFrame:
    days = ship_days(t).withColumn("low", F.nullif(F.col("dyMin"), F.lit(1.0)))
    moved = moving(days, SHIP_KEYS, "date", [MovingMean("ma_low7", "low", 7)], null_poison=True)
    return text_dates(moved.select(*SHIP_KEYS, "date", "low", "ma_low7"), "date")


SHIP_MOVED = f"""mv AS (
    SELECT *, {moving_sql('dyMax', 7)} AS ma_max7, {moving_sql('dyMean', 7)} AS ma_mean7,
           {moving_sql('dyMin', 7)} AS ma_min7, {moving_sql('dyMean', 30)} AS ma_mean30,
           min(dDTmin) OVER f7 AS ana_startdate7, max(dDTmax) OVER f7 AS ana_enddate7,
           min(dDTmin) OVER f30 AS ana_startdate30, max(dDTmax) OVER f30 AS ana_enddate30
    FROM rn {SHIP_WINDOWS})"""


def ship_moved(t: Tables) -> DataFrame:
    return moving(
        ship_days(t), SHIP_KEYS, "date", [MAX_7, MEAN_7, MIN_7, MEAN_30], bounds=("dDTmin", "dDTmax")
    )


@query("stats_long", f"""WITH {SHIP_DAYS}, {SHIP_MOVED}
{long_sql('mv', SHIP_KEYS_SQL + ", strftime(date, '%Y-%m-%d') AS date", STATISTICS)}""")
def stats_long(t: Tables) -> DataFrame:
    return text_dates(to_statistics(ship_moved(t), [*SHIP_KEYS, "date"]), "date")
