"""Jobs from landed files to written results.

Each reads a folder (or several), runs one data flow over all of it and writes one folder per result table. Readers,
flows and sinks can be combined in other ways; these are the usual ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from . import constants as K
from . import plans, schemas, sinks
from .operators.deploy import instrument_is_location
from .operators.reconcile import drop_existing, new_deployments, stored_results
from .sources import files, loggers, services, submissions


def _write_by_file(tables: dict[str, DataFrame], out: str) -> None:
    for name, table in tables.items():
        if "source_file" in table.columns:
            sinks.write_by_source(table, f"{out}/{name}")
        else:
            sinks.write_csv(table, f"{out}/{name}")


def submission_files(
    spark: SparkSession, path: str, project: str, out: str, projects_path: str | None = None, is_salem: bool = False
) -> None:
    """A submission, or a whole folder of them, each file processed as a series of its own."""
    readings = submissions.read_readings(spark, path)
    alternate = submissions.read_projects(spark, projects_path) if projects_path else None
    tables = plans.submission_stats(readings, project, alternate, is_salem)
    _write_by_file({**tables, "distribution": plans.submission_distribution(readings)}, out)


def multi_part_files(
    spark: SparkSession, path: str, project: str, out: str, project_path: str | None = None, is_salem: bool = False
) -> None:
    """One submission in several parts."""
    readings = submissions.read_multi_part(spark, path)
    alternate = submissions.read_project(spark, project_path) if project_path else None
    tables = plans.multi_part_submission_stats(readings, project, alternate, is_salem)
    sinks.write_tables({**tables, "distribution": plans.submission_distribution(readings)}, out)


def logger_files(spark: SparkSession, path: str, out: str) -> None:
    """A folder of logger files."""
    _write_by_file(plans.logger_folder_stats(loggers.read_logger_folder(spark, path)), out)


def daily_value_files(
    spark: SparkSession, temperature: str, oxygen: str, ph: str, sites: str, counties: str, project: str, out: str,
    split_file: bool = True, existing: DataFrame | None = None, fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """A state's daily values; with `existing`, only new results are written as such and the others apart."""
    tables = plans.daily_value_stats(
        services.read_daily_values(spark, temperature, "00010", fmt),
        services.read_daily_values(spark, oxygen, "00300", fmt),
        services.read_instant_ph(spark, ph),
        files.read_lookup(spark, sites, schemas.SITES),
        files.read_lookup(spark, counties, schemas.COUNTIES),
        project,
        existing,
        sinks.hold,
    )
    results = tables["sumstats"] if existing is None else tables["non_duplicates"]
    if split_file:
        sinks.write_bounded(results, f"{out}/sumstats", "SiteID")
    else:
        sinks.write_csv(results, f"{out}/sumstats", sort=("SiteID", "ActStartDate"))
    sinks.write_bounded(tables["pH_continuous"], f"{out}/pH_continuous", "Monitoring_Location_ID")
    others = ("pH_deployments", "monitoring_locations", "suspected_dups", "suspected_updates", "stored_matches")
    sinks.write_tables({name: tables[name] for name in others if name in tables}, out)
    return tables


def portal_files(
    spark: SparkSession, path: str, requests: DataFrame, inventory: DataFrame, crosswalk: DataFrame, project: str,
    out: str,
) -> dict[str, DataFrame]:
    """Landed exports of the city portal."""
    readings = services.read_portal(spark, path, requests)
    tables = plans.portal_stats(readings, inventory, crosswalk, project)
    sinks.write_bounded(tables["sumstats"], f"{out}/sumstats", "Monitoring_Location_ID")
    sinks.write_bounded(tables["pH_continuous"], f"{out}/pH_continuous", "Monitoring_Location_ID")
    sinks.write_tables({name: tables[name] for name in ("deployments", "pH_deployments")}, out)
    return tables


def portal_json_files(
    spark: SparkSession, path: str, startdate: str, enddate: str, out: str, catalogue: str | None = None
) -> dict[str, DataFrame]:
    """Landed data sets of the city portal's JSON service; with `catalogue`, only sets that are in it under an asked label."""
    points = services.read_datasets(spark, path)
    if catalogue is not None:
        labels = sorted(set(K.JSON_PORTAL_LABELS.values()))
        points = services.wanted_datasets(points, *(services.read_catalogue(spark, catalogue, name) for name in labels))
    tables = plans.portal_json_stats(points, startdate, enddate)
    sinks.write_tables(tables, out)
    return tables


def hydrology_files(
    spark: SparkSession, paths: dict[str, str], project: str, out: str, characteristics: Sequence[str] = K.DAILY_MAX_CELSIUS
) -> DataFrame:
    """Landed daily maximum temperatures of the state hydrology service, published ones only.

    Other characteristics of the files are left out.
    """
    rows = plans.of_characteristics(plans.published(services.read_hydrology(spark, paths)), characteristics)
    stats = plans.daily_max_temperature(rows, project)
    sinks.write_bounded(stats, f"{out}/sumstats", "SiteID")
    return stats


def air_files(spark: SparkSession, paths: Sequence[str], out: str, data_types: tuple[str, ...] = ("TMAX",)) -> None:
    """Landed daily climate records of many stations as one table."""
    sinks.write_csv(plans.air_temperature(spark, *paths, data_types=data_types), out, sort=("STATION", "DATE"))


def without_stored(
    spark: SparkSession, new: DataFrame, existing: DataFrame, organization: str, startdate: str, enddate: str, out: str
) -> None:
    """Import rows that the results store does not hold yet, compared with what it holds between the two dates."""
    sinks.write_csv(drop_existing(new, stored_results(existing, new, organization, startdate, enddate)), out)


def new_deployment_files(
    spark: SparkSession, deployed: DataFrame, known: DataFrame, out: str, organization: str | None = None
) -> None:
    """Deployments at locations that the store has no equipment for."""
    sinks.write_csv(new_deployments(deployed, known, organization), out)


def name_instruments_after_locations(spark: SparkSession, path: str, out: str, glob: str = "*pH*") -> None:
    """Continuous pH imports of a folder with the location as instrument, one folder per file."""
    fixed = instrument_is_location(submissions.read_continuous_ph(spark, path, glob))
    sinks.write_by_source(fixed, out)


__all__ = [
    "air_files",
    "daily_value_files", "hydrology_files", "logger_files", "multi_part_files", "name_instruments_after_locations",
    "new_deployment_files",
    "portal_files", "portal_json_files", "submission_files", "without_stored",
]
