"""Air temperature: landed climate files of many stations as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.services import read_air


def air_temperature(spark: SparkSession, *paths: str, data_types: tuple[str, ...] = ("TMAX",)) -> DataFrame:
    """One row per station and day, with the day as a date and the asked data types as numbers."""
    rows = read_air(spark, *paths, data_types=data_types)
    return rows.withColumns({
        "DATE": F.col("DATE").try_cast("date"),
        **{c: F.col(c).try_cast("double") for c in ("LATITUDE", "LONGITUDE", "ELEVATION", *data_types)},
    })
