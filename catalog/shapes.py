"""Templates and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverstat import constants as K
from riverstat.functions import round_nearest
from riverstat.operators.reshape import any_of_long, flagged_long, stack, to_statistics
from riverstat.operators.template import (
    DAY_AND_MOVING,
    SUBMISSION,
    analysis_bounds,
    analytical_method,
    time_basis,
    to_template,
)
from riverstat.sources.services import explode_datasets

from .registry import BASIS_SQL, STATISTICS, Tables, long_sql, query, round_sql
from .series import SHIP_DAYS, SHIP_MOVED, ship_moved

_IDS = (
    "l_returnflag, l_linestatus, date, dDTmin, dDTmax, ana_startdate7, ana_enddate7, ana_startdate30, ana_enddate30"
)


def bounds_sql(side: str, pattern: str) -> str:
    day, week, month = {
        "start": ("dDTmin", "ana_startdate7", "ana_startdate30"),
        "end": ("dDTmax", "ana_enddate7", "ana_enddate30"),
    }[side]
    return (
        f"strftime(CASE RsltTimeBasis WHEN '1 Day' THEN {day} WHEN '7 Day' THEN {week} ELSE {month} END, '{pattern}')"
    )


TEMPLATE_SQL = f"""
    'Calculated' AS RsltType, StatisticalBasis, RsltTimeBasis, 'FMC' AS ActivityType,
    'ContinuousPrb' AS SmplColMthd, 'Probe/Sensor' AS SmplColEquip, '' AS SmplDepth, '' AS SmplDepthUnit,
    '' AS SmplColEquipComment, '' AS Samplers, {round_sql('Result', 2)} AS Result,
    strftime(date, '%Y-%m-%d') AS ActStartDate, '0:00' AS ActStartTime,
    {bounds_sql('end', '%Y-%m-%d')} AS ActEndDate, {bounds_sql('end', '%H:%M:%S')} AS ActEndTime,
    {bounds_sql('start', '%Y-%m-%d')} AS AnaStartDate, {bounds_sql('start', '%H:%M:%S')} AS AnaStartTime,
    {bounds_sql('end', '%Y-%m-%d')} AS AnaEndDate, {bounds_sql('end', '%H:%M:%S')} AS AnaEndTime"""


@query("stats_template", f"""WITH {SHIP_DAYS}, {SHIP_MOVED}, lg AS ({long_sql('mv', _IDS, STATISTICS)}),
bs AS (SELECT *, {BASIS_SQL} AS RsltTimeBasis FROM lg)
SELECT 'Turbidity' AS charID, 'NTU' AS Result_Unit, '180.1' AS Result_Analytical_Method_ID, 'Final' AS ResultStatusID,
       'Generated by ORDEQ' AS cmnt, l_returnflag AS Monitoring_Location_ID, l_linestatus AS Equipment,
       'Call' AS Project, 'Alt' AS alt_project, 'PST' AS ActStartTimeZone, 'PST' AS ActEndTimeZone,
       'PST' AS AnaStartTimeZone, 'PST' AS AnaEndTimeZone, {TEMPLATE_SQL}
FROM bs""")
def stats_template(t: Tables) -> DataFrame:
    moved = ship_moved(t)
    ids = [c for c in moved.columns if c not in K.STATISTIC_COLUMNS]
    basis = time_basis(F.col("StatisticalBasis"))
    bounds = analysis_bounds(basis, DAY_AND_MOVING)
    zones = ("ActStartTimeZone", "ActEndTimeZone", "AnaStartTimeZone", "AnaEndTimeZone")
    return to_template(
        to_statistics(moved, ids), SUBMISSION,
        {
            "charID": "Turbidity", "Result": round_nearest(F.col("Result"), 2), "Result_Unit": "NTU",
            "Result_Analytical_Method_ID": analytical_method(F.lit("Turbidity")), "ResultStatusID": K.FINAL,
            "RsltTimeBasis": basis, "cmnt": K.GENERATED_COMMENT, "Monitoring_Location_ID": F.col("l_returnflag"),
            "Equipment": F.col("l_linestatus"), "Project": "Call", "alt_project": "Alt",
            "ActStartDate": F.date_format("date", "yyyy-MM-dd"), "ActEndDate": bounds["AnaEndDate"],
            "ActEndTime": bounds["AnaEndTime"], **bounds, **dict.fromkeys(zones, "PST"),
        },
    )


_PAIRS = {"Temp": "l_quantity", "DO_mgl": "l_discount", "pH": "l_tax"}


@query("flagged_long", "WITH f AS (SELECT *, '<' || (l_linenumber - 2) || '>' AS F_Temp,"
       " '<' || l_linenumber || '> [' || l_returnflag || ']' AS F_DO_mgl, nullif(l_returnflag, 'N') AS F_pH"
       " FROM lineitem) " + " UNION ALL ".join(
           f"SELECT l_orderkey, l_linenumber, '{p}' AS parameter, {v} AS result, F_{p} AS qual FROM f"
           f" WHERE {v} IS NOT NULL AND regexp_matches(F_{p}, '<0>|<2>|<3>|<4>|<5>')"
           for p, v in _PAIRS.items()
       ))
def flagged(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    wide = t.lineitem.withColumns({
        "F_Temp": F.concat(F.lit("<"), line - 2, F.lit(">")),
        "F_DO_mgl": F.concat(F.lit("<"), line, F.lit("> ["), "l_returnflag", F.lit("]")),
        "F_pH": F.nullif("l_returnflag", F.lit("N")),
    })
    pairs = {p: (v, f"F_{p}") for p, v in _PAIRS.items()}
    long = flagged_long(wide, ["l_orderkey", "l_linenumber"], pairs, "parameter", "result", "qual")
    return long.filter(F.col("qual").rlike(K.LOGGER_FLAG_PATTERN))


@query("any_of_long", """
SELECT p_partkey, 'daily_max_water_temp_C' AS Characteristic_Name, CAST(p_size AS DOUBLE) AS Result_Value FROM part
UNION ALL SELECT p_partkey, 'mean_daily_flow_cfs', p_retailprice FROM part""")
def any_of(t: Tables) -> DataFrame:
    wide = t.part.withColumnsRenamed({"p_size": "daily_max_water_temp_C", "p_retailprice": "mean_daily_flow_cfs"})
    return any_of_long(wide, ["p_partkey"], K.HYDROLOGY_VALUE_COLUMNS, "Characteristic_Name", "Result_Value")


@query("stack_missing_cols", """
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier""")
def stack_missing(t: Tables) -> DataFrame:
    return stack(
        t.customer.selectExpr("c_custkey id", "c_name name", "c_nationkey nation", "c_mktsegment segment"),
        t.supplier.selectExpr("s_suppkey id", "s_name name", "s_nationkey nation"),
    )


@query("json_points", """
WITH e AS (SELECT event_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type AS "locationIdentifier", 'pH' AS parameter, event_id AS point, value FROM e
UNION ALL SELECT event_type, 'pH', event_id, CAST(k AS DOUBLE) FROM e""")
def json_points(t: Tables) -> DataFrame:
    k = F.from_json("props", "k long")["k"].cast("double")

    def point(value):
        return F.struct(F.col("event_id").alias("point"), value.alias("value"))

    envelopes = t.events.select(
        F.struct(F.col("event_type").alias("locationIdentifier"), F.lit("pH").alias("parameter")).alias("dataset"),
        F.array(point(F.col("value")), point(k)).alias("points"),
    )
    return explode_datasets(envelopes)
