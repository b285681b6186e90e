"""Wide logger files -> statistics, continuous pH and deployments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import date_text, lookup, round_nearest, strip_blanks
from ..operators.deploy import deployments, first_deployment
from ..operators.moving import MAX_7, MEAN_7, MEAN_30, MIN_7, moving
from ..operators.reshape import flagged_long, to_statistics
from ..operators.rollup import daily, hourly
from ..operators.template import LOGGER, analytical_method, continuous_ph, time_basis, to_template

PAIRS = {
    "Temp": ("Temp", "F_Temp"),
    "DO_Pct": ("DO_Pct", "F_DO_Pct"),
    "DO_mgl": ("DO_mgl", "F_DO_mgl"),
    "pH": ("pH", "F_pH"),
}


def logger_long(wide: DataFrame) -> DataFrame:
    """One row per reading with its own flag; only flags of usable data stay."""
    ids = [c for c in ("source_file", "StationCode", "DateTimeStamp") if c in wide.columns]
    long = flagged_long(wide, ids, PAIRS, "parameter", "result", "qual", keep_null=True)
    return long.filter(F.col("qual").rlike(K.LOGGER_FLAG_PATTERN))


def logger_folder_stats(wide: DataFrame, instruments: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All results of a folder of logger files in one job, each file a series of its own."""
    instruments = K.LOGGER_INSTRUMENTS if instruments is None else instruments
    extra = ("source_file",) if "source_file" in wide.columns else ()
    long = logger_long(wide)

    keys = [*extra, "StationCode", "parameter"]
    days = daily(hourly(long.filter(~F.col("parameter").contains("pH")), keys, "DateTimeStamp", "result"), keys,
                 cluster=keys)
    complete = days.filter(F.col("hrNday") >= K.COMPLETE_HOURS)
    moved = moving(complete, keys, "date", [MAX_7, MEAN_7, MIN_7, MEAN_30])
    oxygen = F.col("parameter").contains("DO")
    moved = moved.withColumns({
        MAX_7.out: F.when(F.col("parameter") == "Temp", F.col(MAX_7.out)),
        **{s.out: F.when(oxygen, F.col(s.out)) for s in (MEAN_7, MIN_7, MEAN_30)},
    })
    ids = [c for c in moved.columns if c not in K.STATISTIC_COLUMNS]
    name = lookup(F.col("parameter"), {p: c for p, (c, _) in K.LOGGER_PARAMETERS.items()}, K.UNKNOWN)
    statistics = to_template(
        to_statistics(moved, ids), LOGGER,
        {
            "charID": name,
            "Result": round_nearest(F.col("Result"), 2),
            "Result_Unit": lookup(F.col("parameter"), {p: u for p, (_, u) in K.LOGGER_PARAMETERS.items()}, K.UNKNOWN),
            "Result_Analytical_Method_ID": analytical_method(name),
            "RsltTimeBasis": time_basis(F.col("StatisticalBasis")),
            "Monitoring_Location_ID": F.col("StationCode"),
            "ActStartDate": date_text(F.col("dDTmax")),
            "ActEndDate": date_text(F.col("dDTmax")),
        },
        extra,
    )

    station = strip_blanks(F.col("StationCode"))
    readings = long.filter(F.col("parameter") == "pH").withColumns({
        "StationCode": station,
        "Equipment_ID": lookup(station, instruments, F.lit(None).cast("string")),
    })
    ph = continuous_ph(
        readings, F.col("StationCode"), F.col("DateTimeStamp"), F.lit("PST"), F.col("Equipment_ID"), F.col("result"),
        F.lit("pH units"), F.lit(K.FINAL), extra,
    )
    deployed = deployments(
        readings.withColumnRenamed("StationCode", "Monitoring_Location_ID"),
        ["Monitoring_Location_ID", "Equipment_ID"], "DateTimeStamp", F.lit("PST"),
    )
    return {
        "statistics": statistics,
        "continuous_ph": ph,
        "deployments": first_deployment(deployed, "Monitoring_Location_ID", "startdate"),
    }
