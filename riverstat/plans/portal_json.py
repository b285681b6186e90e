"""City portal points from the JSON service -> statistics, continuous pH and deployments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import activity_id, lookup, round_nearest, wall_clock
from ..operators.deploy import IMPORT_NAMES, deployments, import_form
from ..operators.moving import MAX_7, MEAN_7, MEAN_30, MIN_7, moving
from ..operators.quality import date_window, keep_grades, station_identifier
from ..operators.reshape import stack, to_statistics
from ..operators.template import JSON_PORTAL, continuous_ph, time_basis, to_template
from .portal import portal_days


def wanted_sets(points: DataFrame) -> DataFrame:
    """Points of the data sets that are asked for: of a known parameter, and with that parameter's label."""
    return points.filter(F.col("label") == lookup(F.col("parameter"), K.JSON_PORTAL_LABELS))


def portal_json_stats(points: DataFrame, startdate: str, enddate: str) -> dict[str, DataFrame]:
    """All results of the exploded data sets (`sources.services.read_datasets`), 30 days of look-back included.

    Other data sets than those asked for are left out: a raw temperature is not a 7-day mean.
    """
    good = keep_grades(
        wanted_sets(points), "gradeCode", "approvalLevel", (K.GOOD_GRADE,), (K.WORKING_LEVEL, K.APPROVED_LEVEL)
    ).withColumns({
        "locationIdentifier": station_identifier(F.col("locationIdentifier")),
        "datetime": wall_clock(F.col("timestamp"), K.JSON_PORTAL_ZONE),
    })
    rows = date_window(good, F.col("datetime"), startdate, enddate, K.LOOK_BACK_DAYS)

    keys = ["locationIdentifier"]
    oxygen = rows.filter(F.col("parameter") == "Dissolved oxygen")
    days = portal_days(oxygen, keys, "datetime", "value", "unit")
    moved = moving(days, keys, "date", [MAX_7, MEAN_7, MIN_7, MEAN_30])
    ids = [c for c in moved.columns if c not in K.STATISTIC_COLUMNS]
    day = F.col("dDTmax").cast("date")
    computed = to_template(
        to_statistics(moved, ids), JSON_PORTAL,
        {
            "charID": K.DISSOLVED_OXYGEN,
            "Result": round_nearest(F.col("Result"), 2),
            "Result_Unit": "mg/l",
            "Result_Analytical_Method_ID": "NFM 6.2.1-LUM",
            "RsltTimeBasis": time_basis(F.col("StatisticalBasis")),
            "Monitoring_Location_ID": F.col("locationIdentifier"),
            "ActStartDate": day,
            "ActEndDate": day,
            "ActivityID": activity_id(F.col("locationIdentifier"), day, F.lit("FMC")),
        },
    )
    when = F.col("datetime").cast("date")
    supplied = to_template(
        rows.filter(F.col("parameter") == "Temperature"), JSON_PORTAL,
        {
            "charID": K.TEMPERATURE,
            "Result": F.col("value"),
            "Result_Unit": F.col("unit"),
            "Result_Analytical_Method_ID": "FO SOP 1.05a",
            "ResultStatusID": F.col("approvalLevel").cast("string"),
            "StatisticalBasis": K.MOVING_MAX_7,
            "RsltTimeBasis": "7 day",
            "cmnt": F.col("comment"),
            "Monitoring_Location_ID": F.col("locationIdentifier"),
            "ActStartDate": when,
            "ActEndDate": when,
            "ActivityID": activity_id(F.col("locationIdentifier"), when, F.lit("FMC")),
        },
    )
    ph = rows.filter(F.col("parameter") == "pH")
    location = F.col("locationIdentifier")
    deployed = deployments(
        ph.select(location.alias("Monitoring_Location_ID"), location.alias("Equipment_ID"), "datetime"),
        ["Monitoring_Location_ID", "Equipment_ID"], "datetime", F.lit("PST"), "1 SECOND", IMPORT_NAMES,
    )
    return {
        "sum_stats": stack(supplied, computed),
        "pH_raw": continuous_ph(
            ph, location, F.col("datetime"), F.lit("PST"), location, F.col("value"), F.col("unit"), F.col("gradeCode")
        ),
        "pH_deployments": import_form(deployed, K.JSON_PORTAL_PROJECT),
    }
