"""Whole data flows, from readings to the import template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverstat import constants as K
from riverstat.functions import lookup
from riverstat.plans import (
    daily_max_temperature,
    logger_folder_stats,
    multi_part_submission_stats,
    portal_json_stats,
    portal_stats,
    submission_distribution,
    submission_stats,
)
from riverstat.plans.daily_max import of_characteristics, published
from riverstat.plans.daily_values import OXYGEN_MOVING, OXYGEN_PAIRS, daily_value_template

from .registry import (
    BASIS_SQL,
    COMMENT_SQL,
    STATISTICS,
    STATUS_SQL,
    Tables,
    boxes_sql,
    days_sql,
    hours_sql,
    long_sql,
    mean_sql,
    moving_sql,
    query,
    round_sql,
    text_dates,
    windows_sql,
)
from .series import ship_days
from .shapes import TEMPLATE_SQL, bounds_sql

# events as submitted readings
_CHAR = {
    "click": K.TEMPERATURE, "error": K.TEMPERATURE, "view": K.DISSOLVED_OXYGEN, "purchase": K.PH,
    "signup": "Conductivity",
}
_UNIT = {"click": "deg F", "error": "deg C", "view": "mg/l", "purchase": "pH units", "signup": "uS/cm"}


def case_sql(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def submitted(t: Tables, location) -> DataFrame:
    kind = F.col("event_type")
    return t.events.select(
        location.alias("Monitoring_Location_ID"),
        F.to_date("ts").alias("Activity_Start_Date"),
        F.date_format("ts", "HH:mm:ss").alias("Activity_Start_Time"),
        F.lit("PST").alias("Activity_Time_Zone"),
        lookup(kind, _CHAR).alias("Equipment_ID"),
        lookup(kind, _CHAR).alias("Characteristic_Name"),
        F.col("value").alias("Result_Value"),
        lookup(kind, _UNIT).alias("Result_Unit"),
        F.when(F.col("value") > 200, F.lit(K.REJECTED)).otherwise(F.lit("Accepted")).alias("Result_Status_ID"),
    )


def submitted_sql(location: str) -> str:
    return f"""src AS (
    SELECT {location} AS loc, {case_sql('event_type', _CHAR)} AS char, {case_sql('event_type', _UNIT)} AS unit,
           date_trunc('second', ts) AS datetime, value FROM events WHERE (value > 200) IS NOT TRUE),
rd AS (SELECT loc, char, unit, CASE unit WHEN 'deg F' THEN 'deg C' ELSE unit END AS r_units, datetime,
              CASE WHEN unit = 'deg F'
                   THEN {round_sql('(value - 32) * (CAST(5 AS DOUBLE) / CAST(9 AS DOUBLE))', 2)}
                   WHEN unit IS NOT NULL THEN value END AS r FROM src)"""


def statistics_sql(keys: str) -> str:
    temperature, oxygen = f"char = '{K.TEMPERATURE}'", f"char = '{K.DISSOLVED_OXYGEN}'"
    return f"""hr AS ({hours_sql('rd', keys, 'datetime', 'r')}), dy AS ({days_sql('hr', keys)}),
kp AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY date) AS row FROM dy
       WHERE hrNday >= 22 OR NOT ({temperature} OR {oxygen})),
mv AS (SELECT *, CASE WHEN {temperature} THEN {moving_sql('dyMax', 7)} END AS ma_max7,
              CASE WHEN {oxygen} THEN {moving_sql('dyMean', 7)} END AS ma_mean7,
              CASE WHEN {oxygen} THEN {moving_sql('dyMin', 7)} END AS ma_min7,
              CASE WHEN {oxygen} THEN {moving_sql('dyMean', 30)} END AS ma_mean30,
              min(dDTmin) OVER f7 AS ana_startdate7, max(dDTmax) OVER f7 AS ana_enddate7,
              min(dDTmin) OVER f30 AS ana_startdate30, max(dDTmax) OVER f30 AS ana_enddate30
       FROM kp {windows_sql(keys, 'date', 7, 30)}),
lg AS ({long_sql('mv', keys + ", date, dDTmin, dDTmax, hrNday, ana_startdate7, ana_enddate7, ana_startdate30,"
                 " ana_enddate30", STATISTICS)}),
bs AS (SELECT *, {BASIS_SQL} AS RsltTimeBasis FROM lg)
SELECT char AS "charID", r_units AS "Result_Unit",
       CASE char WHEN 'Conductivity' THEN '120.1' WHEN 'Dissolved oxygen (DO)' THEN 'NFM 6.2.1-LUM' WHEN 'pH' THEN '150.1'
                 WHEN 'Temperature, water' THEN '170.1' END AS "Result_Analytical_Method_ID",
       {STATUS_SQL} AS "ResultStatusID", {COMMENT_SQL} AS cmnt, loc AS "Monitoring_Location_ID", char AS "Equipment",
       'Call' AS "Project", 'Alt' AS alt_project, 'PST' AS "ActStartTimeZone", 'PST' AS "ActEndTimeZone",
       'PST' AS "AnaStartTimeZone", 'PST' AS "AnaEndTimeZone", {TEMPLATE_SQL}
FROM bs"""


@query("submission_stats", f"WITH {submitted_sql('event_type')}, {statistics_sql('loc, char, unit, r_units')}")
def submission(t: Tables) -> DataFrame:
    readings = submitted(t, F.col("event_type"))
    return text_dates(submission_stats(readings, "Call", "Alt")["statistics"], "ActStartDate")


@query("multi_part_submission_stats", f"WITH {submitted_sql(chr(39) + 'L' + chr(39))}, "
       f"{statistics_sql('loc, char, r_units')}")
def multi_part(t: Tables) -> DataFrame:
    readings = submitted(t, F.lit("L"))
    return text_dates(multi_part_submission_stats(readings, "Call", "Alt")["statistics"], "ActStartDate")


@query("submission_deployments", f"""
SELECT event_type AS "Monitoring_Location_ID", {case_sql('event_type', _CHAR)} AS "Equipment_ID",
       min(date_trunc('second', ts)) AS startdate, max(date_trunc('second', ts)) + INTERVAL 5 MINUTES AS enddate,
       'PST' AS "TZ"
FROM events GROUP BY event_type""")
def submission_deployed(t: Tables) -> DataFrame:
    return submission_stats(submitted(t, F.col("event_type")), "Call", "Alt")["deployments"]


@query("submission_distribution", f"""
WITH {submitted_sql('event_type')}, {boxes_sql('rd', 'char, loc', 'r')}
SELECT char AS "Characteristic_Name", loc AS "Monitoring_Location_ID", minimum, q1, median, q3, maximum, count(*) AS n,
       min(v) FILTER (inside) AS whisker_low, max(v) FILTER (inside) AS whisker_high,
       count(*) FILTER (NOT inside) AS outliers
FROM x GROUP BY char, loc, minimum, q1, median, q3, maximum""")
def submission_spread(t: Tables) -> DataFrame:
    return submission_distribution(submitted(t, F.col("event_type")))


# events as wide logger rows: all four parameters at once, suspect temperatures, rejected saturation
_LOGGER_UNIT = {"Temp": "deg C", "DO_mgl": "mg/l"}
_LOGGER_CHAR = {"Temp": K.TEMPERATURE, "DO_mgl": K.DISSOLVED_OXYGEN}


@query("logger_stats", f"""
WITH lo AS (SELECT event_type AS loc, 'Temp' AS parameter, date_trunc('minute', ts) AS datetime, value AS r FROM events
            WHERE (value > 200) IS NOT TRUE UNION ALL
            SELECT event_type, 'DO_mgl', date_trunc('minute', ts), value FROM events),
hr AS ({hours_sql('lo', 'loc, parameter', 'datetime', 'r')}), dy AS ({days_sql('hr', 'loc, parameter')}),
kp AS (SELECT *, row_number() OVER (PARTITION BY loc, parameter ORDER BY date) AS row FROM dy WHERE hrNday >= 22),
mv AS (SELECT *, CASE WHEN parameter = 'Temp' THEN {moving_sql('dyMax', 7)} END AS ma_max7,
              CASE WHEN parameter <> 'Temp' THEN {moving_sql('dyMean', 7)} END AS ma_mean7,
              CASE WHEN parameter <> 'Temp' THEN {moving_sql('dyMin', 7)} END AS ma_min7,
              CASE WHEN parameter <> 'Temp' THEN {moving_sql('dyMean', 30)} END AS ma_mean30
       FROM kp {windows_sql('loc, parameter', 'date', 7, 30)}),
lg AS ({long_sql('mv', 'loc, parameter, dDTmax', STATISTICS)})
SELECT {case_sql('parameter', _LOGGER_CHAR)} AS "charID", {round_sql('Result', 2)} AS "Result",
       {case_sql('parameter', _LOGGER_UNIT)} AS "Result_Unit",
       CASE parameter WHEN 'Temp' THEN '170.1' ELSE 'NFM 6.2.1-LUM' END AS "Result_Analytical_Method_ID",
       'Calculated' AS "RsltType", 'Final' AS "ResultStatusID", StatisticalBasis, {BASIS_SQL} AS "RsltTimeBasis",
       'Generated by ORDEQ' AS cmnt, 'FMC' AS "ActivityType", loc AS "Monitoring_Location_ID",
       'ContinuousPrb' AS "SmplColMthd", 'Probe/Sensor' AS "SmplColEquip", '' AS "SmplDepth", '' AS "SmplDepthUnit",
       '' AS "SmplColEquipComment", '' AS "Samplers", 'ContinuousPrb' AS "Equipment",
       strftime(dDTmax, '%Y-%m-%d') AS "ActStartDate", '0:00' AS "ActStartTime", 'PST' AS "ActStartTimeZone",
       strftime(dDTmax, '%Y-%m-%d') AS "ActEndDate", '23:59' AS "ActEndTime", 'PST' AS "ActEndTimeZone",
       '' AS "AnaStartDate", '' AS "AnaStartTime", '' AS "AnaStartTimeZone", '' AS "AnaEndDate", '' AS "AnaEndTime",
       '' AS "AnaEndTimeZone"
FROM lg""")
def logger_stats(t: Tables) -> DataFrame:
    return logger_folder_stats(logger_wide(t))["statistics"]


def logger_wide(t: Tables) -> DataFrame:
    value = F.col("value")
    return t.events.select(
        F.col("event_type").alias("StationCode"),
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("DateTimeStamp"),
        value.alias("Temp"), F.when(value > 200, F.lit("<1> [x]")).otherwise(F.lit("<0>")).alias("F_Temp"),
        value.alias("DO_Pct"), F.lit("<-3>").alias("F_DO_Pct"),
        value.alias("DO_mgl"), F.lit("<4>").alias("F_DO_mgl"),
        value.alias("pH"), F.lit("<0>").alias("F_pH"),
    )


_INSTRUMENTS = {"click": "click_0124", "view": "view_0124", "error": "error_0124"}
_INSTRUMENT_SQL = case_sql("event_type", _INSTRUMENTS)


@query("logger_ph", f"""
SELECT event_type AS "Monitoring_Location_ID", strftime(ts, '%Y/%m/%d') AS "Activity_start_date",
       strftime(ts, '%H:%M') || ':00' AS "Activity_Start_Time", 'PST' AS "Activity_Time_Zone",
       {_INSTRUMENT_SQL} AS "Equipment_ID", 'pH' AS "Characteristic_Name", value AS "Result_Value",
       'pH units' AS "Result_Unit", 'Final' AS "Result_Status_ID"
FROM events""")
def logger_ph(t: Tables) -> DataFrame:
    return logger_folder_stats(logger_wide(t), _INSTRUMENTS)["continuous_ph"]


@query("logger_deployments", f"""
SELECT event_type AS "Monitoring_Location_ID", {_INSTRUMENT_SQL} AS "Equipment_ID",
       min(date_trunc('minute', ts)) AS startdate, '' AS enddate, 'PST' AS "TZ"
FROM events GROUP BY event_type""")
def logger_deployed(t: Tables) -> DataFrame:
    return logger_folder_stats(logger_wide(t), _INSTRUMENTS)["deployments"]


# lineitem days as daily values of a site
_DAY_PAIRS = {
    "dyMax": ("Daily Maximum", "max_cd"), "dyMean": ("Daily Mean", "mean_cd"), "low": ("Daily Minimum", "low_cd"),
    "ma_mean7": ("7DMADMean", "mean_cd"), "ma_mean30": ("30DMADMean", "mean_cd"), "ma_min7": ("7DMADMin", "low_cd"),
}


def _poison(value: str, days: int) -> str:
    return f"CASE WHEN count({value}) OVER f{days} = count(*) OVER f{days} THEN {moving_sql(value, days)} END"


@query("daily_value_stats", f"""
WITH dy AS (SELECT l_returnflag || l_linestatus AS site, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS dyMax,
                   nullif(min(l_quantity), 1) AS low, {mean_sql('l_quantity')} AS dyMean, 'A' AS mean_cd,
                   CASE WHEN max(l_quantity) = 50 THEN NULL ELSE 'P' END AS max_cd,
                   CASE WHEN min(l_quantity) = 2 THEN 'A e' ELSE 'A' END AS low_cd FROM lineitem GROUP BY ALL),
rn AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY date) AS row FROM dy),
mv AS (SELECT *, {_poison('dyMean', 7)} AS ma_mean7, {_poison('low', 7)} AS ma_min7, {_poison('dyMean', 30)} AS ma_mean30,
              CAST(date AS TIMESTAMP) AS dDTmin, CAST(date AS TIMESTAMP) AS dDTmax,
              CAST(min(date) OVER f7 AS TIMESTAMP) AS ana_startdate7, CAST(max(date) OVER f7 AS TIMESTAMP) AS ana_enddate7,
              CAST(min(date) OVER f30 AS TIMESTAMP) AS ana_startdate30,
              CAST(max(date) OVER f30 AS TIMESTAMP) AS ana_enddate30
       FROM rn {windows_sql('site', 'date', 7, 30)}),
lg AS ({" UNION ALL ".join(
    f"SELECT *, '{name}' AS StatisticalBasis, {column} AS Result, {flag} AS Qualcd FROM mv WHERE {column} IS NOT NULL"
    for column, (name, flag) in _DAY_PAIRS.items())}),
bs AS (SELECT *, {BASIS_SQL} AS RsltTimeBasis FROM lg WHERE Qualcd NOT IN ('P Eqp', 'P Dis', 'P Ssn', 'A e', 'P e'))
SELECT 'Dissolved oxygen (DO)' AS "CharID", {round_sql('Result', 1)} AS "Result", 'mg/L' AS "Unit", 'LUMIN' AS "Method",
       'Calculated' AS "RsltType", Qualcd, StatisticalBasis, RsltTimeBasis,
       CASE RsltTimeBasis WHEN '1 Day' THEN '' ELSE 'Generated by ORDEQ' END AS "DEQ_RsltComment",
       'FMC' AS "ActivityType", site AS "SiteID", 'ContinuousPrb' AS "SmplColMthd", 'Probe/Sensor' AS "SmplColEquip",
       '' AS "SmplDepth", '' AS "SmplDepthUnit", '' AS "SmplColEquipComment", '' AS "Samplers",
       'Continuous Probe' AS "SmplEquipID", 'Call' AS "Project", strftime(date, '%Y-%m-%d') AS "ActStartDate",
       '0:00' AS "ActStartTime", 'UTC' AS "ActStartTimeZone", strftime(date, '%Y-%m-%d') AS "ActEndDate",
       '0:00' AS "ActEndTime", 'UTC' AS "ActEndTimeZone", {bounds_sql('start', '%Y-%m-%d')} AS "AnaStartDate",
       {bounds_sql('start', '%H:%M:%S')} AS "AnaStartTime", 'UTC' AS "AnaStartTimeZone",
       {bounds_sql('end', '%Y-%m-%d')} AS "AnaEndDate", {bounds_sql('end', '%H:%M:%S')} AS "AnaEndTime",
       'UTC' AS "AnaEndTimeZone", '' AS "ActComment", concat_ws(':', site, strftime(date, '%Y%m%d'), 'FMC') AS "ActivityID"
FROM bs""")
def daily_values(t: Tables) -> DataFrame:
    low = F.col("dyMin")
    values = ship_days(t, "site_no").select(
        "site_no", F.col("date").alias("Date"),
        F.col("dyMax").alias("DO_Max"), F.when(F.col("dyMax") != 50, F.lit("P")).alias("DO_Max_cd"),
        F.col("dyMean").alias("DO"), F.lit("A").alias("DO_cd"),
        F.nullif(low, F.lit(1.0)).alias("DO_Min"),
        F.when(low == 2, F.lit("A e")).otherwise(F.lit("A")).alias("DO_Min_cd"),
    )
    rows = daily_value_template(
        values, K.DISSOLVED_OXYGEN, "mg/L", "LUMIN", "Call", OXYGEN_MOVING, OXYGEN_PAIRS
    )
    return text_dates(rows, "ActStartDate", "ActEndDate")


@query("daily_max_stats", f"""
WITH dy AS (SELECT l_returnflag AS site, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS dyMax
            FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL),
rn AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY date) AS row FROM dy),
mv AS (SELECT *, {_poison('dyMax', 7)} AS ma_max7, min(date) OVER f7 AS a7, max(date) OVER f7 AS b7
       FROM rn {windows_sql('site', 'date', 7)}),
lg AS ({long_sql('mv', 'site, date, a7, b7', {'dyMax': 'Daily Maximum', 'ma_max7': '7DMADMax'})})
SELECT 'Temperature, water' AS "CharID", {round_sql('Result', 1)} AS "Result", 'deg C' AS "Unit", 'T-170.1' AS "Method",
       'Calculated' AS "RsltType", 'Final' AS "Qualcd", StatisticalBasis, {BASIS_SQL} AS "RsltTimeBasis",
       CASE StatisticalBasis WHEN '7DMADMax' THEN 'Generated by ORDEQ' ELSE '' END AS "DEQ_RsltComment",
       'FMC' AS "ActivityType", site AS "SiteID", 'ContinuousPrb' AS "SmplColMthd", 'Probe/Sensor' AS "SmplColEquip",
       '' AS "SmplDepth", '' AS "SmplDepthUnit", '' AS "SmplColEquipComment", '' AS "Samplers",
       'Continuous Probe' AS "SmplEquipID", 'Call' AS "Project", strftime(date, '%Y-%m-%d') AS "ActStartDate",
       '0:00' AS "ActStartTime", 'PST' AS "ActStartTimeZone", strftime(date, '%Y-%m-%d') AS "ActEndDate",
       '0:00' AS "ActEndTime", 'PST' AS "ActEndTimeZone",
       strftime(CASE StatisticalBasis WHEN '7DMADMax' THEN a7 ELSE date END, '%Y-%m-%d') AS "AnaStartDate",
       strftime(date, '%H:%M:%S') AS "AnaStartTime", 'PST' AS "AnaStartTimeZone",
       strftime(CASE StatisticalBasis WHEN '7DMADMax' THEN b7 ELSE date END, '%Y-%m-%d') AS "AnaEndDate",
       strftime(date, '%H:%M:%S') AS "AnaEndTime", 'PST' AS "AnaEndTimeZone", '' AS "ActComment",
       concat_ws(':', site, strftime(date, '%Y%m%d'), 'FMC') AS "ActivityID"
FROM lg""")
def daily_max(t: Tables) -> DataFrame:
    days = ship_days(t).select(
        F.col("l_returnflag").alias("station_nbr"), F.date_format("date", "MM-dd-yyyy").alias("record_date"),
        F.col("dyMax").alias("Result_Value"),
        F.when(F.col("l_linestatus") == "F", F.lit(K.PUBLISHED)).otherwise(F.lit("PRO")).alias("published_status"),
    )
    flow = days.withColumns({"Result_Value": F.col("Result_Value") + 1000, "Characteristic_Name": F.lit("mean_daily_flow_cfs")})
    mixed = days.withColumn("Characteristic_Name", F.lit("daily_max_water_temp_C")).unionByName(flow)
    rows = daily_max_temperature(of_characteristics(published(mixed)), "Call")
    return text_dates(rows, "ActStartDate", "ActEndDate")


# events as portal readings; station `error` has a ready-made 7-day series, station `click` has not
_PORTAL_STATION = {"click": "click", "view": "view", "purchase": "view", "signup": "error", "error": "error"}
_PORTAL_CHAR = {
    "click": "Temperature.Primary", "view": "Dissolved oxygen.Primary", "purchase": "pH.Primary",
    "signup": "Temperature.7DADM", "error": "Temperature.Primary",
}


def portal_readings(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    return t.events.select(
        lookup(kind, _PORTAL_STATION).alias("Monitoring_Location_ID"), F.col("ts").alias("datetime"),
        lookup(kind, _PORTAL_CHAR).alias("Characteristic_Name"), lookup(kind, _UNIT).alias("Result_Unit"),
        F.col("value").alias("Result_Value"),
        F.when(F.col("value") > 200, F.lit(50.0)).otherwise(F.lit(100.0)).alias("Grade_Code"),
        F.lit(1200.0).alias("Approval_Level"), F.col("props").alias("Comment"),
    )


_PORTAL_COMMON = """'Calculated' AS "RsltType", 'FMC' AS "ActivityType", 'ContinuousPrb' AS "SmplColMthd",
       'Probe/Sensor' AS "SmplColEquip", '' AS "SmplDepth", '' AS "SmplDepthUnit", '' AS "SmplColEquipComment",
       '' AS "Samplers", 'Continuous Probe' AS "Equipment", '0:00' AS "ActStartTime", '0:00' AS "ActEndTime" """


def _portal_computed(source: str, stats: dict[str, str], char: str, unit: str, method: str) -> str:
    return f"""SELECT '{char}' AS "charID", {round_sql('Result', 2)} AS "Result", '{unit}' AS "Result_Unit",
       '{method}' AS "Result_Analytical_Method_ID", 'Final' AS "ResultStatusID", StatisticalBasis, RsltTimeBasis,
       'Generated by ORDEQ' AS cmnt, 'M-' || loc AS "Monitoring_Location_ID",
       strftime(date, '%Y-%m-%d') AS "ActStartDate", {bounds_sql('end', '%Y-%m-%d')} AS "ActEndDate",
       {bounds_sql('start', '%Y-%m-%d')} AS "AnaStartDate", {bounds_sql('start', '%H:%M:%S')} AS "AnaStartTime",
       {bounds_sql('end', '%Y-%m-%d')} AS "AnaEndDate", {bounds_sql('end', '%H:%M:%S')} AS "AnaEndTime"
FROM (SELECT *, {BASIS_SQL} AS RsltTimeBasis FROM ({long_sql(
    source, 'loc, date, dDTmin, dDTmax, ana_startdate7, ana_enddate7, ana_startdate30, ana_enddate30', stats)}))"""


_DAILY = {"dyMax": "Daily Maximum", "dyMin": "Daily Minimum", "dyMean": "Daily Mean"}
_ZONES = ", ".join(f"""'UTC' AS "{c}" """ for c in (
    "ActStartTimeZone", "ActEndTimeZone", "AnaStartTimeZone", "AnaEndTimeZone"))


@query("supplied_or_computed", f"""
WITH rd AS (SELECT {case_sql('event_type', _PORTAL_STATION)} AS loc, {case_sql('event_type', _PORTAL_CHAR)} AS char,
                   {case_sql('event_type', _UNIT)} AS unit, ts, value, props FROM events WHERE value <= 200),
fl AS (SELECT {case_sql('event_type', _PORTAL_STATION)} AS loc, bool_or(event_type = 'signup') AS supplied
       FROM events GROUP BY 1),
raw AS (SELECT rd.* FROM rd JOIN fl USING (loc)
        WHERE char = 'Dissolved oxygen.Primary' OR (char = 'Temperature.Primary' AND NOT supplied)),
hr AS ({hours_sql('raw', 'loc, char, unit', 'ts', 'value')}), dy AS ({days_sql('hr', 'loc, char')}),
kp AS (SELECT *, row_number() OVER (PARTITION BY loc, char ORDER BY date) AS row FROM dy WHERE hrNday >= 22),
mv AS (SELECT *, {moving_sql('dyMax', 7)} AS ma_max7, {moving_sql('dyMean', 7)} AS ma_mean7,
              {moving_sql('dyMin', 7)} AS ma_min7, {moving_sql('dyMean', 30)} AS ma_mean30,
              min(dDTmin) OVER f7 AS ana_startdate7, max(dDTmax) OVER f7 AS ana_enddate7,
              min(dDTmin) OVER f30 AS ana_startdate30, max(dDTmax) OVER f30 AS ana_enddate30
       FROM kp {windows_sql('loc, char', 'date', 7, 30)}),
oxy AS (SELECT * FROM mv WHERE char = 'Dissolved oxygen.Primary'),
tmp AS (SELECT * FROM mv WHERE char = 'Temperature.Primary'),
al AS ({_portal_computed('oxy', {**_DAILY, 'ma_min7': '7DMADMin', 'ma_mean7': '7DMADMean', 'ma_mean30': '30DMADMean'},
                         K.DISSOLVED_OXYGEN, 'mg/l', 'NFM 6.2.1-LUM')}
UNION ALL {_portal_computed('tmp', {**_DAILY, 'ma_max7': '7DMADMax'}, K.TEMPERATURE, 'deg C', 'T-170.1')}
UNION ALL SELECT 'Temperature, water', value, unit, 'T-170.1', '100', '7DMADMax', '7 day', props, 'M-' || loc,
       strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y-%m-%d'), strftime(CAST(ts AS DATE) - INTERVAL 6 DAYS, '%Y-%m-%d'),
       '0:00', strftime(ts, '%Y-%m-%d'), '0:00' FROM rd WHERE char = 'Temperature.7DADM')
SELECT *, {_PORTAL_COMMON}, {_ZONES}, 'Call' AS "Project", CAST(NULL AS VARCHAR) AS "ActivityID" FROM al""")
def supplied_or_computed(t: Tables) -> DataFrame:
    return portal_tables(t)["sumstats"]


def portal_tables(t: Tables) -> dict[str, DataFrame]:
    """Readings of another station come along that the inventory does not list, and of pH after its last day there."""
    readings = portal_readings(t)
    station, char = F.col("Monitoring_Location_ID").alias("station"), F.col("Characteristic_Name").alias("char")
    listed = readings.select(station, char).distinct()
    last = F.when(F.col("char") == "pH.Primary", F.lit("2024-01-28")).otherwise(F.lit("2024-01-31"))
    inventory = listed.select("*", F.lit("2024-01-01").alias("startdate"), F.lit("2024-01-20").alias("enddate")).unionByName(
        listed.select("*", F.lit("2024-01-15").alias("startdate"), last.alias("enddate"))
    )
    readings = readings.unionByName(readings.withColumn("Monitoring_Location_ID", F.lit("elsewhere")))
    crosswalk = inventory.select(
        F.col("station").alias("LocationIdentifier"), F.concat(F.lit("M-"), "station").alias("MLocID")
    ).distinct()
    return portal_stats(readings, inventory, crosswalk, "Call")


_PORTAL_GOOD = f"""
WITH rd AS (SELECT 'M-' || {case_sql('event_type', _PORTAL_STATION)} AS loc, event_type, ts, value, props
            FROM events WHERE value <= 200 AND (event_type <> 'purchase' OR CAST(ts AS DATE) <= DATE '2024-01-28')),
ex AS (SELECT loc, min(ts) AS a, max(ts) + INTERVAL 1 SECOND AS b FROM rd GROUP BY loc),
eq AS (SELECT *, concat_ws('-', loc, strftime(a, '%Y%m'), strftime(b, '%Y%m')) AS instrument FROM ex)"""


@query("portal_deployments", _PORTAL_GOOD + """
SELECT loc AS "Monitoring_Location_ID", a AS "Activity_start_date_time", b AS "Activity_end_date_time",
       'UTC' AS "Activity_start_end_time_Zone", instrument AS "Equipment_ID", 'Water' AS "Media",
       'Surface Water' AS "Media_subdivision", 'Call' AS "Project_ID", '' AS "Alternate_Project_ID",
       '' AS "Alternate_Project_ID2", '' AS "Frequency_on_minutes", '' AS "Depth_in_m"
FROM eq""")
def portal_deployed(t: Tables) -> DataFrame:
    return portal_tables(t)["deployments"]


@query("portal_ph", _PORTAL_GOOD + """
SELECT loc AS "Monitoring_Location_ID", strftime(ts, '%Y/%m/%d') AS "Activity_start_date",
       strftime(ts, '%H:%M:%S') AS "Activity_Start_Time", 'UTC' AS "Activity_Time_Zone",
       instrument AS "Equipment_ID", 'pH' AS "Characteristic_Name", value AS "Result_Value",
       'pH units' AS "Result_Unit", 100 AS "Result_Status_ID"
FROM rd LEFT JOIN eq ON rd.loc IS NOT DISTINCT FROM eq.loc WHERE event_type = 'purchase'""".replace(
    "SELECT loc AS", "SELECT rd.loc AS"))
def portal_ph(t: Tables) -> DataFrame:
    return portal_tables(t)["pH_continuous"]


_JSON_CHAR = {"click": "Temperature", "view": "Dissolved oxygen", "purchase": "pH"}


@query("portal_json_stats", f"""
WITH rd AS (SELECT 'PDX_BES-' || user_id AS loc, {case_sql('event_type', _JSON_CHAR)} AS char,
                   date_trunc('second', ts) AS ts, value, props FROM events
            WHERE (value > 200) IS NOT TRUE
              AND CAST(ts AS DATE) BETWEEN DATE '2024-02-01' - INTERVAL 30 DAYS AND DATE '2024-02-10'),
oxy AS (SELECT 'PDX_BES-FC8' AS loc, ts, value FROM rd WHERE char = 'Dissolved oxygen'),
hr AS ({hours_sql('oxy', 'loc', 'ts', 'value')}), dy AS ({days_sql('hr', 'loc')}),
kp AS (SELECT *, row_number() OVER (PARTITION BY loc ORDER BY date) AS row FROM dy WHERE hrNday >= 22),
mv AS (SELECT *, {moving_sql('dyMax', 7)} AS ma_max7, {moving_sql('dyMean', 7)} AS ma_mean7,
              {moving_sql('dyMin', 7)} AS ma_min7, {moving_sql('dyMean', 30)} AS ma_mean30
       FROM kp {windows_sql('loc', 'date', 7, 30)}),
lg AS ({long_sql('mv', 'loc, dDTmax', STATISTICS)}),
al AS (SELECT 'Dissolved oxygen (DO)' AS "charID", {round_sql('Result', 2)} AS "Result", 'mg/l' AS "Result_Unit",
              'NFM 6.2.1-LUM' AS "Result_Analytical_Method_ID", 'Final' AS "ResultStatusID", StatisticalBasis,
              {BASIS_SQL} AS "RsltTimeBasis", 'Generated by ORDEQ' AS cmnt, loc AS "Monitoring_Location_ID",
              dDTmax AS day FROM lg
       UNION ALL SELECT 'Temperature, water', value, 'deg C', 'FO SOP 1.05a', '900', '7DMADMax', '7 day', props, loc, ts
       FROM rd WHERE char = 'Temperature')
SELECT * EXCLUDE (day), {_PORTAL_COMMON}, 'PST' AS "ActStartTimeZone", 'PST' AS "ActEndTimeZone",
       '' AS "AnaStartDate", '' AS "AnaStartTime", '' AS "AnaStartTimeZone", '' AS "AnaEndDate", '' AS "AnaEndTime",
       '' AS "AnaEndTimeZone", 'Integrated Report - Call for Data' AS "Project",
       strftime(day, '%Y-%m-%d') AS "ActStartDate", strftime(day, '%Y-%m-%d') AS "ActEndDate",
       concat_ws(':', "Monitoring_Location_ID", strftime(day, '%Y%m%d'), 'FMC') AS "ActivityID"
FROM al""")
def portal_json(t: Tables) -> DataFrame:
    return text_dates(portal_json_tables(t)["sum_stats"], "ActStartDate", "ActEndDate")


def portal_json_tables(t: Tables) -> dict[str, DataFrame]:
    kind = F.col("event_type")
    points = t.events.select(
        F.when(kind == "view", F.lit("FC-8")).otherwise(F.col("user_id").cast("string")).alias("locationIdentifier"),
        lookup(kind, _JSON_CHAR).alias("parameter"),
        F.when(kind == "click", F.lit("7DADM")).otherwise(F.lit("Primary")).alias("label"),
        lookup(kind, {"click": "deg C"}, "mg/l").alias("unit"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "value",
        F.when(F.col("value") > 200, F.lit(50)).otherwise(F.lit(100)).alias("gradeCode"),
        F.lit(900).alias("approvalLevel"), F.col("props").alias("comment"),
    )
    # Every temperature series comes again as raw values, which nobody asked for, and so do other labels of the others.
    unasked = points.withColumn("label", F.when(F.col("label") == "7DADM", F.lit("Primary")).otherwise(F.lit("Field Visits")))
    return portal_json_stats(points.unionByName(unasked), "2024-02-01", "2024-02-10")


@query("portal_json_ph_deployments", """
SELECT 'PDX_BES-' || user_id AS "Monitoring_Location_ID", 'PDX_BES-' || user_id AS "Equipment_ID",
       min(date_trunc('second', ts)) AS "Activity_start_date_time",
       max(date_trunc('second', ts)) + INTERVAL 1 SECOND AS "Activity_end_date_time",
       'PST' AS "Activity_start_end_time_Zone", 'Water' AS "Media", 'Surface Water' AS "Media_subdivision",
       'Integrated Report - Call for Data' AS "Project_ID", '' AS "Alternate_Project_ID", '' AS "Alternate_Project_ID2",
       '' AS "Frequency_on_minutes", '' AS "Depth_in_m"
FROM events WHERE event_type = 'purchase' AND (value > 200) IS NOT TRUE
  AND CAST(ts AS DATE) BETWEEN DATE '2024-02-01' - INTERVAL 30 DAYS AND DATE '2024-02-10'
GROUP BY user_id""")
def portal_json_deployed(t: Tables) -> DataFrame:
    return portal_json_tables(t)["pH_deployments"]
