"""The fixed import templates."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import date_text, lookup, time_text

# Column order of the templates.
_RESULT = (
    "charID", "Result", "Result_Unit", "Result_Analytical_Method_ID", "RsltType", "ResultStatusID",
    "StatisticalBasis", "RsltTimeBasis", "cmnt", "ActivityType", "Monitoring_Location_ID", "SmplColMthd",
    "SmplColEquip", "SmplDepth", "SmplDepthUnit", "SmplColEquipComment", "Samplers", "Equipment",
)
_PERIOD = (
    "ActStartDate", "ActStartTime", "ActStartTimeZone", "ActEndDate", "ActEndTime", "ActEndTimeZone",
    "AnaStartDate", "AnaStartTime", "AnaStartTimeZone", "AnaEndDate", "AnaEndTime", "AnaEndTimeZone",
)
SUBMISSION_COLUMNS = (*_RESULT, "Project", "alt_project", *_PERIOD)
LOGGER_COLUMNS = (*_RESULT, *_PERIOD)
PORTAL_COLUMNS = (*_RESULT, "Project", *_PERIOD, "ActivityID")
DAILY_VALUE_COLUMNS = (
    "CharID", "Result", "Unit", "Method", "RsltType", "Qualcd", "StatisticalBasis", "RsltTimeBasis",
    "DEQ_RsltComment", "ActivityType", "SiteID", "SmplColMthd", "SmplColEquip", "SmplDepth", "SmplDepthUnit",
    "SmplColEquipComment", "Samplers", "SmplEquipID", "Project", *_PERIOD, "ActComment", "ActivityID",
)
PH_COLUMNS = (
    "Monitoring_Location_ID", "Activity_start_date", "Activity_Start_Time", "Activity_Time_Zone", "Equipment_ID",
    "Characteristic_Name", "Result_Value", "Result_Unit", "Result_Status_ID",
)

# Constants every template row carries.
_SAMPLE = {
    "RsltType": "Calculated", "ActivityType": "FMC", "SmplColMthd": "ContinuousPrb", "SmplColEquip": "Probe/Sensor",
    "SmplDepth": "", "SmplDepthUnit": "", "SmplColEquipComment": "", "Samplers": "", "ActStartTime": "0:00",
}
_NO_ANALYSIS = dict.fromkeys(
    ("AnaStartDate", "AnaStartTime", "AnaStartTimeZone", "AnaEndDate", "AnaEndTime", "AnaEndTimeZone"), ""
)


def _zones(zone: str) -> dict[str, str]:
    return dict.fromkeys(("ActStartTimeZone", "ActEndTimeZone", "AnaStartTimeZone", "AnaEndTimeZone"), zone)


@dataclass(frozen=True)
class Profile:
    """Columns of a template in order, and the constants among them."""

    columns: tuple[str, ...]
    constants: Mapping[str, str] = field(default_factory=dict)


SUBMISSION = Profile(SUBMISSION_COLUMNS, _SAMPLE)
LOGGER = Profile(
    LOGGER_COLUMNS,
    {**_SAMPLE, **_zones("PST"), **_NO_ANALYSIS, "ActEndTime": "23:59", "Equipment": "ContinuousPrb"},
)
PORTAL = Profile(
    PORTAL_COLUMNS, {**_SAMPLE, **_zones("UTC"), "ActEndTime": "0:00", "Equipment": "Continuous Probe"}
)
JSON_PORTAL = Profile(
    PORTAL_COLUMNS,
    {
        **_SAMPLE, **_zones("PST"), **_NO_ANALYSIS, "ActEndTime": "0:00", "Equipment": "Continuous Probe",
        "Project": K.JSON_PORTAL_PROJECT,
    },
)
DAILY_VALUE = Profile(
    DAILY_VALUE_COLUMNS,
    {**_SAMPLE, **_zones("UTC"), "ActEndTime": "0:00", "SmplEquipID": "Continuous Probe", "ActComment": ""},
)
DAILY_MAX = Profile(DAILY_VALUE_COLUMNS, {**DAILY_VALUE.constants, **_zones("PST"), "Qualcd": K.FINAL})


def to_template(
    df: DataFrame, profile: Profile, values: Mapping[str, Column | str], extra: tuple[str, ...] = ()
) -> DataFrame:
    """Select the template's columns: from `values`, else the profile's constants, else the table.

    `extra` columns of the table (such as the file the rows came from) go in front.
    """

    def column(name: str) -> Column:
        if name in values:
            value = values[name]
            return (F.lit(value) if isinstance(value, str) else value).alias(name)
        if name in profile.constants:
            return F.lit(profile.constants[name]).alias(name)
        return F.col(name)

    return df.select(*extra, *(column(c) for c in profile.columns))


def time_basis(statistic: Column, seven_day: str = "7 Day") -> Column:
    return (
        F.when(statistic.isin(*K.SEVEN_DAY_STATISTICS), F.lit(seven_day))
        .when(statistic == K.MOVING_MEAN_30, F.lit("30 Day"))
        .otherwise(F.lit("1 Day"))
    )


def analytical_method(characteristic: Column) -> Column:
    return lookup(characteristic, K.METHOD_BY_CHARACTERISTIC, K.UNKNOWN)


def analysis_bounds(basis: Column, ranges: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """Analysis start and end, as date and time text, from the (start, end) columns of each time basis."""

    def pick(side: int) -> Column:
        case = None
        for name, columns in ranges.items():
            value = F.col(columns[side]).cast("timestamp_ntz")
            case = F.when(basis == name, value) if case is None else case.when(basis == name, value)
        return case

    start, end = pick(0), pick(1)
    return {
        "AnaStartDate": date_text(start), "AnaStartTime": time_text(start),
        "AnaEndDate": date_text(end), "AnaEndTime": time_text(end),
    }


DAY_AND_MOVING = {
    "1 Day": ("dDTmin", "dDTmax"),
    "7 Day": ("ana_startdate7", "ana_enddate7"),
    "30 Day": ("ana_startdate30", "ana_enddate30"),
}


def continuous_ph(
    df: DataFrame,
    location: Column,
    ts: Column,
    zone: Column,
    equipment: Column,
    value: Column,
    unit: Column,
    status: Column,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Readings passed through in the 9 columns of the continuous import (no aggregation, no shuffle)."""
    return df.select(
        *extra,
        location.alias("Monitoring_Location_ID"),
        date_text(ts, "/").alias("Activity_start_date"),
        time_text(ts).alias("Activity_Start_Time"),
        zone.alias("Activity_Time_Zone"),
        equipment.alias("Equipment_ID"),
        F.lit(K.PH).alias("Characteristic_Name"),
        value.alias("Result_Value"),
        unit.alias("Result_Unit"),
        status.alias("Result_Status_ID"),
    )
