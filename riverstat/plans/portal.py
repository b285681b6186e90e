"""City portal readings -> statistics (ready-made or computed), continuous pH and deployments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import date_text, round_nearest
from ..operators.deploy import IMPORT_NAMES, attach_instrument, deployments, import_form, with_instrument_id
from ..operators.joins import null_safe_join
from ..operators.moving import MAX_7, MEAN_7, MEAN_30, MIN_7, moving
from ..operators.quality import keep_grades
from ..operators.reshape import stack, to_statistics
from ..operators.rollup import complete_days, daily, hourly
from ..operators.summary import stations_to_compute
from ..sources.requests import keep_inventoried
from ..operators.template import (
    DAY_AND_MOVING,
    PORTAL,
    analysis_bounds,
    continuous_ph,
    time_basis,
    to_template,
)

READY_MADE = "Temperature.7DADM"
RAW_TEMPERATURE = "Temperature.Primary"
RAW_OXYGEN = "Dissolved oxygen.Primary"
RAW_PH = "pH.Primary"


def portal_days(readings: DataFrame, keys: list[str], ts: str, value: str, unit: str) -> DataFrame:
    """Complete days of a series; hours are formed per unit, days over all of them."""
    hours = hourly(readings, [*keys, unit], ts, value)
    return complete_days(daily(hours, keys, cluster=keys))


def _ready_made(readings: DataFrame, project: str) -> DataFrame:
    """The portal's own 7-day series, which covers the six days before its date too."""
    day = date_text(F.col("datetime"))
    return to_template(
        readings.filter(F.col("Characteristic_Name") == READY_MADE), PORTAL,
        {
            "charID": K.TEMPERATURE,
            "Result": F.col("Result_Value"),
            "Result_Analytical_Method_ID": "T-170.1",
            "ResultStatusID": F.col("Grade_Code").cast("int").cast("string"),
            "StatisticalBasis": K.MOVING_MAX_7,
            "RsltTimeBasis": "7 day",
            "cmnt": F.col("Comment"),
            "Project": project,
            "ActStartDate": day,
            "ActEndDate": day,
            "AnaStartDate": date_text(F.date_sub(F.col("datetime").cast("date"), 6)),
            "AnaStartTime": "0:00",
            "AnaEndDate": day,
            "AnaEndTime": "0:00",
            "ActivityID": F.lit(None).cast("string"),
        },
    )


def _computed(readings: DataFrame, project: str) -> DataFrame:
    """Dissolved oxygen and raw temperature in one pass, the characteristic being part of the series."""
    keys = ["Monitoring_Location_ID", "Characteristic_Name"]
    name = F.col("Characteristic_Name")
    days = portal_days(readings, keys, "datetime", "Result_Value", "Result_Unit")
    moved = moving(days, keys, "date", [MAX_7, MEAN_7, MIN_7, MEAN_30], bounds=("dDTmin", "dDTmax"))
    moved = moved.withColumns({
        MAX_7.out: F.when(name == RAW_TEMPERATURE, F.col(MAX_7.out)),
        **{s.out: F.when(name == RAW_OXYGEN, F.col(s.out)) for s in (MEAN_7, MIN_7, MEAN_30)},
    })
    ids = [c for c in moved.columns if c not in K.STATISTIC_COLUMNS]
    basis = time_basis(F.col("StatisticalBasis"))
    bounds = analysis_bounds(basis, DAY_AND_MOVING)

    def by_name(oxygen: str, temperature: str) -> Column:
        return F.when(name == RAW_OXYGEN, F.lit(oxygen)).otherwise(F.lit(temperature))

    return to_template(
        to_statistics(moved, ids), PORTAL,
        {
            "charID": by_name(K.DISSOLVED_OXYGEN, K.TEMPERATURE),
            "Result": round_nearest(F.col("Result"), 2),
            "Result_Unit": by_name("mg/l", "deg C"),
            "Result_Analytical_Method_ID": by_name("NFM 6.2.1-LUM", "T-170.1"),
            "RsltTimeBasis": basis,
            "Project": project,
            "ActStartDate": date_text(F.col("date")),
            "ActEndDate": bounds["AnaEndDate"],
            **bounds,
            "ActivityID": F.lit(None).cast("string"),
        },
    )


def located(rows: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """The portal's station codes replaced by locations; NULL where the crosswalk has none."""
    ids = crosswalk.select(F.col("LocationIdentifier").alias("Monitoring_Location_ID"), "MLocID")
    return (
        rows.join(ids, "Monitoring_Location_ID", "left")
        .withColumn("Monitoring_Location_ID", F.col("MLocID"))
        .drop("MLocID")
    )


def portal_stats(
    readings: DataFrame, inventory: DataFrame, crosswalk: DataFrame, project: str
) -> dict[str, DataFrame]:
    """All results of portal readings that the inventory asks for. Without usable readings every table is empty.

    `inventory` has `station` and `char`, and may have `startdate` and `enddate`.
    Which stations lack a ready-made 7-day series is decided on the portal's own codes, before they are replaced.
    An instrument is named after its location's extent, so statistics are grouped by location alone and only the pH
    passthrough is joined to the instruments.
    """
    asked = keep_inventoried(readings, inventory, "Monitoring_Location_ID", "Characteristic_Name", F.col("datetime"))
    valued = asked.filter(F.col("Result_Value").isNotNull())
    good = keep_grades(valued, "Grade_Code", "Approval_Level", (K.GOOD_GRADE,), (K.APPROVED_LEVEL,))

    def deployed(rows: DataFrame, keys: list[str]) -> DataFrame:
        return import_form(
            deployments(rows, keys, "datetime", F.lit("UTC"), "1 SECOND", IMPORT_NAMES), project
        )

    name = F.col("Characteristic_Name")
    to_compute = stations_to_compute(inventory, "station", "char").select(
        F.col("station").alias("Monitoring_Location_ID"), F.lit(RAW_TEMPERATURE).alias("raw")
    )
    raw = null_safe_join(
        good.filter(name.isin(RAW_OXYGEN, RAW_TEMPERATURE)), to_compute, ["Monitoring_Location_ID"], "left"
    ).filter((name == RAW_OXYGEN) | (name == F.col("raw")))
    sumstats = stack(
        _computed(located(raw, crosswalk), project),
        _ready_made(located(good.filter(name == READY_MADE), crosswalk), project),
    )
    everywhere = located(good, crosswalk)
    extents = with_instrument_id(deployed(everywhere, ["Monitoring_Location_ID"]))
    ph = attach_instrument(everywhere.filter(name == RAW_PH), extents, "Monitoring_Location_ID")
    return {
        "deployments": extents,
        "sumstats": sumstats,
        "pH_continuous": continuous_ph(
            ph, F.col("Monitoring_Location_ID"), F.col("datetime"), F.lit("UTC"), F.col("Equipment_ID"),
            F.col("Result_Value"), F.col("Result_Unit"), F.col("Grade_Code").cast("int"),
        ),
        "pH_deployments": deployed(ph, ["Monitoring_Location_ID", "Equipment_ID"]),
    }
