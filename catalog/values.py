"""Scalar expressions, filters and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverstat import constants as K
from riverstat.functions import (
    activity_id,
    base_identifier,
    blank_to_null,
    clock_hhmm,
    compact_date,
    hour_key,
    iso_datetime,
    lookup,
    mdy_date,
    mdy_datetime,
    null_to_blank,
    time_text,
    wall_clock,
)
from riverstat.plans import published
from riverstat.plans.loggers import logger_long
from riverstat.operators.quality import (
    date_window,
    drop_qualifiers,
    drop_rejected,
    keep_grades,
    keep_site_types,
    normalise_units,
    repair_characteristic,
    station_identifier,
)
from riverstat.operators.reconcile import from_store_statistic, to_store_statistic
from riverstat.operators.summary import status_share, value_distribution
from riverstat.operators.template import continuous_ph

from .registry import Tables, boxes_sql, query, round_sql

_UNIT = {"click": "deg F", "view": "deg C", "purchase": "mg/l", "signup": "deg F"}
_UNIT_SQL = "CASE event_type WHEN 'error' THEN NULL " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in _UNIT.items()
) + " END"


@query("unit_convert", f"""
WITH u AS (SELECT event_id, value, {_UNIT_SQL} AS unit FROM events)
SELECT event_id, CASE WHEN unit = 'deg F' THEN 'deg C' ELSE unit END AS r_units,
       CASE WHEN unit = 'deg F' THEN {round_sql('(value - 32) * (CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE))', 2)}
            WHEN unit IS NOT NULL THEN value END AS r
FROM u""")
def unit_convert(t: Tables) -> DataFrame:
    readings = t.events.select("event_id", "value", lookup(F.col("event_type"), _UNIT).alias("unit"))
    return normalise_units(readings, "value", "unit").select("event_id", "r_units", "r")


@query("status_share", f"""
SELECT o_orderstatus, count(*) AS n, {round_sql('count(*) * 100.0e0 / sum(count(*)) OVER ()', 2)} AS per_status
FROM orders GROUP BY o_orderstatus""")
def share(t: Tables) -> DataFrame:
    return status_share(t.orders, "o_orderstatus")


@query("value_distribution", f"""
WITH {boxes_sql('events', 'event_type', 'value')}
SELECT event_type, minimum, q1, median, q3, maximum, count(*) AS n, min(v) FILTER (inside) AS whisker_low,
       max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
FROM x GROUP BY event_type, minimum, q1, median, q3, maximum""")
def distribution(t: Tables) -> DataFrame:
    return value_distribution(t.events, ["event_type"], "value")


@query("clock_dates", """
SELECT event_id, strftime(ts, '%Y-%j-%H') AS hr, strftime(ts, '%Y%m%d') AS compact,
       concat_ws(':', event_type, strftime(ts, '%Y%m%d'), 'FMC') AS activity,
       strftime(CAST(ts AS DATE) - INTERVAL 6 DAYS, '%Y-%m-%d') AS week_start,
       strftime(ts, '%H:%M') AS hhmm, date_trunc('second', ts) AS iso, date_trunc('minute', ts) AS mdy,
       date_trunc('second', ts) AS wall, strftime(ts, '%Y-%m-%d') AS record_date, ts + INTERVAL 5 MINUTES AS padded,
       replace('p@ ' || event_type, ' ', '%20') AS escaped
FROM events""")
def clock_dates(t: Tables) -> DataFrame:
    ts = F.col("ts")
    short = F.concat(F.hour(ts).cast("string"), F.date_format(ts, ":mm:ss"))
    return t.events.select(
        "event_id",
        hour_key(ts).alias("hr"),
        compact_date(ts).alias("compact"),
        activity_id(F.col("event_type"), ts, F.lit("FMC")).alias("activity"),
        F.date_format(F.date_sub(ts.cast("date"), 6), "yyyy-MM-dd").alias("week_start"),
        clock_hhmm(short).alias("hhmm"),
        iso_datetime(F.to_date(ts), time_text(ts)).alias("iso"),
        mdy_datetime(F.date_format(ts, "M/d/yyyy H:mm")).alias("mdy"),
        wall_clock(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), K.JSON_PORTAL_ZONE).alias("wall"),
        F.date_format(mdy_date(F.date_format(ts, "MM-dd-yyyy")), "yyyy-MM-dd").alias("record_date"),
        (ts + F.expr("INTERVAL 5 MINUTES")).alias("padded"),
        F.replace(F.concat(F.lit("p@ "), "event_type"), F.lit(" "), F.lit("%20")).alias("escaped"),
    )


@query("qc_filters", """
SELECT 'rejected' AS rule, o_orderkey AS id FROM orders WHERE nullif(o_orderstatus, 'P') <> 'F'
UNION ALL SELECT 'qualifier', o_orderkey FROM orders WHERE nullif(o_orderpriority, '5-LOW') NOT IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'site type', o_orderkey FROM orders
    WHERE nullif(o_orderpriority, '5-LOW') IS NULL OR o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'grade', l_orderkey FROM lineitem WHERE l_linenumber = 1 AND l_quantity IN (10, 20)
UNION ALL SELECT 'published', l_orderkey FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT 'flag', l_orderkey FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def qc_filters(t: Tables) -> DataFrame:
    orders = t.orders.withColumns({
        "status": F.when(F.col("o_orderstatus") == "F", F.lit(K.REJECTED)).otherwise(
            F.nullif("o_orderstatus", F.lit("P"))
        ),
        "priority": F.nullif("o_orderpriority", F.lit("5-LOW")),
    })
    lines = t.lineitem
    denied = ("1-URGENT", "2-HIGH")
    none = F.lit(None).cast("double")
    flag = lookup(F.col("l_returnflag"), {"A": "<0> [GSM]", "N": "<-3>", "R": "<4>"}).alias("F_Temp")
    logger = lines.select(
        F.col("l_orderkey").alias("StationCode"), F.col("l_quantity").alias("Temp"), flag, none.alias("DO_Pct"),
        F.lit("<-2>").alias("F_DO_Pct"), none.alias("DO_mgl"), F.lit(None).cast("string").alias("F_DO_mgl"), none.alias("pH"),
        F.lit("<1>").alias("F_pH"),
    )
    kept = {
        "rejected": drop_rejected(orders, "status"),
        "qualifier": drop_qualifiers(orders, "priority", denied),
        "site type": keep_site_types(orders, "priority", denied),
        "grade": keep_grades(lines, "l_linenumber", "l_quantity", (1,), (10, 20)),
        "published": published(lines.withColumn("published_status", F.when(F.col("l_returnflag") == "R", K.PUBLISHED))),
        "flag": logger_long(logger).filter("parameter = 'Temp'").withColumnRenamed("StationCode", "l_orderkey"),
    }
    rows = None
    for rule, df in kept.items():
        key = "o_orderkey" if "o_orderkey" in df.columns else "l_orderkey"
        part = df.select(F.lit(rule).alias("rule"), F.col(key).alias("id"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query("date_window", """
SELECT event_id, ts FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-15' - INTERVAL 5 DAYS AND DATE '2024-01-20'""")
def window(t: Tables) -> DataFrame:
    return date_window(t.events, F.col("ts"), "2024-01-15", "2024-01-20", look_back=5).select("event_id", "ts")


@query("ph_passthrough", """
SELECT CAST(user_id AS VARCHAR) AS Monitoring_Location_ID, strftime(ts, '%Y/%m/%d') AS Activity_start_date,
       strftime(ts, '%H:%M:%S') AS Activity_Start_Time, 'PST' AS Activity_Time_Zone,
       CAST(user_id AS VARCHAR) AS Equipment_ID, 'pH' AS Characteristic_Name, value AS Result_Value,
       'pH units' AS Result_Unit, 'Final' AS Result_Status_ID
FROM events WHERE event_type = 'purchase'""")
def ph_passthrough(t: Tables) -> DataFrame:
    user = F.col("user_id").cast("string")
    return continuous_ph(
        t.events.filter(F.col("event_type") == "purchase"), user, F.col("ts"), F.lit("PST"), user, F.col("value"),
        F.lit("pH units"), F.lit(K.FINAL),
    )


@query("alias_repair", """
WITH e AS (SELECT event_id, 'PDX_BES-' || CASE event_type WHEN 'click' THEN 'FC-8' WHEN 'view' THEN 'JC1'
                  WHEN 'error' THEN 'TC-4' ELSE event_type END AS full_id, event_type FROM events)
SELECT event_id,
       CASE full_id WHEN 'PDX_BES-FC-8' THEN 'PDX_BES-FC8' WHEN 'PDX_BES-JC1' THEN 'PDX_BES-JC-1'
                    WHEN 'PDX_BES-TC-4' THEN 'PDX_BES-TC4' ELSE full_id END AS station,
       CASE event_type WHEN 'view' THEN 'Temperature, water' ELSE event_type END AS characteristic,
       CASE event_type WHEN 'click' THEN '7DADMin' WHEN 'view' THEN 'Maximum' ELSE event_type END AS stored_statistic,
       CASE event_type WHEN 'click' THEN '7DMADMax' WHEN 'view' THEN '7DMADMin' ELSE event_type END AS statistic
FROM e""")
def alias_repair(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    station = lookup(kind, {"click": "FC-8", "view": "JC1", "error": "TC-4"}, kind)
    rows = t.events.withColumn("characteristic", lookup(kind, {"view": "Temperature,water"}, kind))
    rows = repair_characteristic(rows, "characteristic", {"Temperature,water": K.TEMPERATURE})
    return rows.select(
        "event_id",
        station_identifier(station).alias("station"),
        "characteristic",
        to_store_statistic(lookup(kind, {"click": K.MOVING_MIN_7, "view": K.DAILY_MAX}, kind)).alias(
            "stored_statistic"
        ),
        from_store_statistic(lookup(kind, {"click": "7DADM", "view": "7DADMin"}, kind)).alias("statistic"),
    )


@query("inventory_text", """
SELECT event_id, event_type || '.Primary' AS char, regexp_matches(event_type, 'c') AS has_c,
       contains(event_type, 'view') AS has_view
FROM events WHERE event_type IN ('click', 'view', 'purchase')""")
def inventory_text(t: Tables) -> DataFrame:
    identifier = F.concat("event_type", F.lit(".Primary@"), F.col("event_id").cast("string"), F.lit("@x"))
    rows = t.events.select("event_id", "event_type", base_identifier(identifier).alias("char"))
    wanted = rows.filter(F.col("char").isin("click.Primary", "view.Primary", "purchase.Primary"))
    return wanted.select(
        "event_id", "char", F.col("event_type").rlike("c").alias("has_c"),
        F.col("event_type").contains("view").alias("has_view"),
    )


@query("null_blank", """
SELECT o_orderkey, nullif(replace(o_orderstatus, 'P', ''), '') AS depth,
       coalesce(nullif(o_orderstatus, 'O'), '') AS shown, CAST(o_custkey AS VARCHAR) AS site,
       strftime(o_orderdate, '%H:%M:%S') AS clock
FROM orders""")
def null_blank(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        blank_to_null(F.replace(status, F.lit("P"), F.lit(""))).alias("depth"),
        null_to_blank(F.nullif(status, F.lit("O"))).alias("shown"),
        F.col("o_custkey").cast("string").alias("site"),
        time_text(F.col("o_orderdate")).alias("clock"),
    )
