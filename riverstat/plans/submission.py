"""Submitted readings -> statistics, continuous pH, deployments and value distribution."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import iso_datetime, round_nearest
from ..operators.deploy import deployments
from ..operators.joins import attach_scalar
from ..operators.moving import MAX_7, MEAN_7, MEAN_30, MIN_7, moving
from ..operators.quality import drop_rejected, normalise_units
from ..operators.reshape import to_statistics
from ..operators.rollup import daily, hourly
from ..operators.summary import value_distribution
from ..operators.template import (
    DAY_AND_MOVING,
    SUBMISSION,
    analysis_bounds,
    analytical_method,
    continuous_ph,
    time_basis,
    to_template,
)

MOVING_CHARACTERISTICS = (K.DISSOLVED_OXYGEN, K.TEMPERATURE)

# Keys of a series that are often one text for a whole submission.
SHARED_KEYS = ("Activity_Time_Zone", "Result_Unit", "r_units")


def daily_statistics(readings: DataFrame, keys: list[str], ts: str, value: str, characteristic: str) -> DataFrame:
    """Daily and moving statistics of all characteristics in one pass, the characteristic being part of the key.

    Dissolved oxygen has 7-day means of the mean and minimum and a 30-day mean, temperature a 7-day mean of the maximum;
    both drop incomplete days. Other characteristics keep all days and have no moving statistics. Series are placed by
    all keys but zones and units, which are often the same for all.
    """
    name = F.col(characteristic)
    days = daily(hourly(readings, keys, ts, value), keys, cluster=[k for k in keys if k not in SHARED_KEYS])
    kept = days.filter((F.col("hrNday") >= K.COMPLETE_HOURS) | ~name.isin(*MOVING_CHARACTERISTICS))
    moved = moving(kept, keys, "date", [MAX_7, MEAN_7, MIN_7, MEAN_30], bounds=("dDTmin", "dDTmax"))
    oxygen, temperature = name == K.DISSOLVED_OXYGEN, name == K.TEMPERATURE
    return moved.withColumns({
        MAX_7.out: F.when(temperature, F.col(MAX_7.out)),
        **{s.out: F.when(oxygen, F.col(s.out)) for s in (MEAN_7, MIN_7, MEAN_30)},
    })


def _statistics(
    clean: DataFrame, project: str, with_alternate: Callable[[DataFrame], DataFrame], extra: tuple[str, ...]
) -> DataFrame:
    keys = [
        *extra, "Monitoring_Location_ID", "Equipment_ID", "Characteristic_Name", "Activity_Time_Zone", "Result_Unit",
        "r_units",
    ]
    moved = daily_statistics(clean, keys, "datetime", "r", "Characteristic_Name")
    ids = [c for c in moved.columns if c not in K.STATISTIC_COLUMNS]
    basis = time_basis(F.col("StatisticalBasis"))
    bounds = analysis_bounds(basis, DAY_AND_MOVING)
    zones = ("ActStartTimeZone", "ActEndTimeZone", "AnaStartTimeZone", "AnaEndTimeZone")
    values = {
        "charID": F.col("Characteristic_Name"),
        "Result": round_nearest(F.col("Result"), 2),
        "Result_Unit": F.col("r_units"),
        "Result_Analytical_Method_ID": analytical_method(F.col("Characteristic_Name")),
        "RsltTimeBasis": basis,
        "Equipment": F.col("Equipment_ID"),
        "Project": project,
        "ActStartDate": F.col("date"),
        "ActEndDate": bounds["AnaEndDate"],
        "ActEndTime": bounds["AnaEndTime"],
        **bounds,
        **dict.fromkeys(zones, F.col("Activity_Time_Zone")),
    }
    return to_template(with_alternate(to_statistics(moved, ids)), SUBMISSION, values, extra)


def _extra(readings: DataFrame) -> tuple[str, ...]:
    return ("source_file",) if "source_file" in readings.columns else ()


def timed_readings(readings: DataFrame) -> DataFrame:
    return readings.withColumn(
        "datetime", iso_datetime(F.col("Activity_Start_Date"), F.col("Activity_Start_Time"))
    )


def accepted_readings(readings: DataFrame) -> DataFrame:
    """Readings with their time and the value in deg C, rejected ones dropped."""
    return normalise_units(drop_rejected(timed_readings(readings)))


def _with_alternate(
    project: DataFrame | str | None, is_salem: bool
) -> Callable[[DataFrame], DataFrame]:
    """Adds `alt_project` to the statistics: a text, the first cell of a table, or the table's text for the file."""
    if isinstance(project, DataFrame) and not is_salem:
        if "source_file" in project.columns:
            return lambda stats: stats.join(project.select("source_file", "alt_project"), "source_file", "left")
        return lambda stats: attach_scalar(stats, project, "alt_project")
    text = K.SALEM_PROJECT if is_salem else project
    return lambda stats: stats.withColumn("alt_project", F.lit(text).cast("string"))


def _tables(
    clean: DataFrame, deployed_from: DataFrame, project: str, with_alternate: Callable[[DataFrame], DataFrame],
    extra: tuple[str, ...],
) -> dict[str, DataFrame]:
    if not isinstance(project, str):
        raise ValueError("project must be one text")
    location, zone = F.col("Monitoring_Location_ID"), F.col("Activity_Time_Zone")
    return {
        "statistics": _statistics(clean, project, with_alternate, extra),
        "continuous_ph": continuous_ph(
            clean.filter(F.col("Characteristic_Name") == K.PH), location, F.col("datetime"), zone, location,
            F.col("Result_Value"), F.col("Result_Unit"), F.col("Result_Status_ID"), extra,
        ),
        "deployments": deployments(
            deployed_from, [*extra, "Monitoring_Location_ID", "Equipment_ID"], "datetime", zone, "5 MINUTES"
        ),
    }


def submission_stats(
    readings: DataFrame,
    project: str,
    alternate_project: DataFrame | str | None = None,
    is_salem: bool = False,
    deployments_after_filter: bool = False,
) -> dict[str, DataFrame]:
    """All results of submitted readings (columns of `schemas.READINGS`, `source_file` optional).

    A whole folder is one job: where there is a `source_file`, each file is a series of its own and its name is carried
    along, ready for `sinks.write_by_source`. `alternate_project` is text, a one-row table (`read_project`), or a table
    with a text per file (`read_projects`).
    """
    clean = accepted_readings(readings)
    deployed_from = clean if deployments_after_filter else timed_readings(readings)
    return _tables(clean, deployed_from, project, _with_alternate(alternate_project, is_salem), _extra(readings))


def multi_part_submission_stats(
    readings: DataFrame,
    project: str,
    alternate_project: DataFrame | str | None = None,
    is_salem: bool = False,
) -> dict[str, DataFrame]:
    """The multi-part form: a converted reading loses its original unit, so deg F and deg C readings of one instrument
    are one series, and deployments count accepted readings only."""
    clean = accepted_readings(readings).withColumn("Result_Unit", F.col("r_units"))
    return _tables(clean, clean, project, _with_alternate(alternate_project, is_salem), _extra(readings))


def submission_distribution(readings: DataFrame) -> DataFrame:
    """Distribution of the accepted values per characteristic and location."""
    keys = [*_extra(readings), "Characteristic_Name", "Monitoring_Location_ID"]
    return value_distribution(accepted_readings(readings), keys, "r")
