"""Daily values that the service has already aggregated -> moving statistics, pH, sites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import activity_id, lookup, null_to_blank, number_text, round_nearest
from ..operators.deploy import IMPORT_NAMES, deployments, import_form, instrument_is_location
from ..operators.moving import MovingMean, day_cells, moving
from ..operators.quality import drop_qualifiers, keep_site_types
from ..operators.reconcile import check_duplicates
from ..operators.reshape import flagged_long, stack
from ..operators.template import DAILY_VALUE, PH_COLUMNS, analysis_bounds, continuous_ph, time_basis, to_template

TEMPERATURE_MOVING = (MovingMean("ma_max7", "Wtemp_Max", 7),)
TEMPERATURE_PAIRS = {
    K.DAILY_MAX: ("Wtemp_Max", "Wtemp_Max_cd"),
    K.DAILY_MEAN: ("Wtemp", "Wtemp_cd"),
    K.DAILY_MIN: ("Wtemp_Min", "Wtemp_Min_cd"),
    K.MOVING_MAX_7: ("ma_max7", "Wtemp_Max_cd"),
}
OXYGEN_MOVING = (
    MovingMean("ma_mean7", "DO", 7), MovingMean("ma_min7", "DO_Min", 7), MovingMean("ma_mean30", "DO", 30),
)
OXYGEN_PAIRS = {
    K.DAILY_MAX: ("DO_Max", "DO_Max_cd"),
    K.DAILY_MEAN: ("DO", "DO_cd"),
    K.DAILY_MIN: ("DO_Min", "DO_Min_cd"),
    K.MOVING_MEAN_7: ("ma_mean7", "DO_cd"),
    K.MOVING_MEAN_30: ("ma_mean30", "DO_cd"),
    K.MOVING_MIN_7: ("ma_min7", "DO_Min_cd"),
}


def daily_value_template(
    values: DataFrame, characteristic: str, unit: str, method: str, project: str,
    moving_means: tuple[MovingMean, ...], pairs: dict[str, tuple[str, str]],
) -> DataFrame:
    """Template rows of one parameter's daily values: the values themselves, and the moving means over them.

    A statistic carries the qualifier of the daily value it is made of. A day that lacks a value leaves the moving mean
    of every frame it is in empty. The values pass through without a shuffle; only the columns the means need are moved.
    """
    computed = {s.out for s in moving_means}
    daily_pairs = {n: p for n, p in pairs.items() if p[0] not in computed}
    moving_pairs = {n: p for n, p in pairs.items() if p[0] in computed}
    flags = list(dict.fromkeys(flag for _, flag in moving_pairs.values()))
    cells = day_cells(values, ["site_no"], "Date", list(dict.fromkeys(s.value for s in moving_means)), flags)
    moved = moving(cells, ["site_no"], "Date", moving_means, bounds=("Date", "Date"), null_poison=True)
    periods = {f"{s.days} Day": (f"ana_startdate{s.days}", f"ana_enddate{s.days}") for s in moving_means}
    ids = ["site_no", "Date"]
    bounds = [c for pair in periods.values() for c in pair]

    def template(long: DataFrame, comment: str, ranges: dict[str, tuple[str, str]]) -> DataFrame:
        basis = time_basis(F.col("StatisticalBasis"))
        return to_template(
            drop_qualifiers(long, "Qualcd"), DAILY_VALUE,
            {
                "CharID": characteristic,
                "Result": round_nearest(F.col("Result"), 1),
                "Unit": unit,
                "Method": method,
                "RsltTimeBasis": basis,
                "DEQ_RsltComment": comment,
                "SiteID": F.col("site_no"),
                "Project": project,
                "ActStartDate": F.col("Date"),
                "ActEndDate": F.col("Date"),
                "ActivityID": activity_id(F.col("site_no"), F.col("Date"), F.lit("FMC")),
                **analysis_bounds(basis, ranges),
            },
        )

    own = flagged_long(values, ids, daily_pairs, "StatisticalBasis", "Result", "Qualcd")
    means = flagged_long(moved, [*ids, *bounds], moving_pairs, "StatisticalBasis", "Result", "Qualcd")
    return stack(template(own, "", {"1 Day": ("Date", "Date")}), template(means, K.GENERATED_COMMENT, periods))


def site_records(sites: DataFrame, counties: DataFrame) -> DataFrame:
    """Monitoring locations in the import's form, NULLs blank."""
    kind = lookup(F.col("site_tp_cd"), K.SITE_TYPE_NAMES, K.UNKNOWN)
    well = kind == "Well"

    def of_well(value):
        return F.when(well, value).otherwise(F.lit(""))

    blank = F.lit("")
    columns = {
        "Stationkey": F.col("site_no"), "Desc": F.col("station_nm"), "SiteComments": blank, "MonLocType": kind,
        "COUNTY": F.col("county_nm"), "STATE": F.lit("OR"), "Country": F.lit("US"), "HUC8": F.col("huc_cd"),
        "HUC12": blank, "TribalLand": blank, "TribalName": blank, "CreateDate": blank, "T_R_S": blank,
        "Lat": number_text(F.col("dec_lat_va")), "Long": number_text(F.col("dec_long_va")),
        "Datum": F.col("dec_coord_datum_cd"),
        "CollMethod": F.lit("Interpolation-Digital Map Source"), "MapScale": number_text(F.col("map_scale_fc")),
        "Comments": blank, "WellType": of_well(F.lit("Monitoring")), "WellForm": blank,
        "WellAquiferName": of_well(F.col("nat_aqfr_cd")),
        "WellDepth": of_well(number_text(F.col("well_depth_va"))), "WellDepthUnit": F.lit("ft"),
        "AltLocID": blank, "AltLocName": blank, "EcoRegion3": blank, "EcoRegion4": blank, "Reachcode": blank,
        "GNIS_Name": blank, "AU_ID": blank,
    }
    joined = sites.join(counties, "county_cd", "left")
    return joined.select(*(null_to_blank(c).alias(name) for name, c in columns.items()))


def daily_value_stats(
    temperature: DataFrame,
    oxygen: DataFrame,
    ph: DataFrame,
    sites: DataFrame,
    counties: DataFrame,
    project: str,
    existing: DataFrame | None = None,
    hold: Callable[[DataFrame], DataFrame] = lambda table: table,
) -> dict[str, DataFrame]:
    """All results of a state's daily values; with `existing` also the comparison with the results store.

    Statistics, pH and the classified rows each feed several tables. `hold` is applied to them: `sinks.hold` writes each
    once and reads it from there, so that writing all tables computes nothing twice.
    """
    wanted = keep_site_types(sites, "site_tp_cd")
    site_ids = wanted.select("site_no")
    sumstats = hold(stack(
        daily_value_template(
            temperature.join(site_ids, "site_no", "left_semi"), K.TEMPERATURE, "deg C", "THM01", project,
            TEMPERATURE_MOVING, TEMPERATURE_PAIRS,
        ),
        daily_value_template(
            oxygen.join(site_ids, "site_no", "left_semi"), K.DISSOLVED_OXYGEN, "mg/L", "LUMIN", project,
            OXYGEN_MOVING, OXYGEN_PAIRS,
        ),
    ))
    approved = ph.join(site_ids, "site_no", "left_semi").filter(F.col("pH_Inst_cd") == "A")
    continuous = hold(continuous_ph(
        approved, F.col("site_no"), F.col("dateTime"), F.col("tz_cd"), F.col("site_no"), F.col("pH_Inst"),
        F.lit("pH Units"), F.col("pH_Inst_cd"),
    ))
    deployed = import_form(
        deployments(
            instrument_is_location(continuous.select(*PH_COLUMNS)), ["Monitoring_Location_ID", "Equipment_ID"],
            "Activity_start_date", F.col("Activity_Time_Zone"), names=IMPORT_NAMES,
        ),
        project,
    )
    used = sumstats.select("SiteID").union(continuous.select("Monitoring_Location_ID")).distinct()
    records = site_records(
        sites.join(used.withColumnRenamed("SiteID", "site_no"), "site_no", "left_semi"), counties
    )
    tables = {
        "sumstats": sumstats,
        "pH_continuous": continuous,
        "pH_deployments": deployed,
        "monitoring_locations": records,
    }
    if existing is not None:
        tables.update(check_duplicates(sumstats, existing, hold=hold))
    return tables
