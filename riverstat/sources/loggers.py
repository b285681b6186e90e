"""Wide logger files of the estuary stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import mdy_datetime
from .files import require_rows, source_name


def read_logger_folder(spark: SparkSession, path: str, glob: str = "*wq*.csv") -> DataFrame:
    """All water-quality files of a folder; the 10 columns are picked by name before anything is parsed."""
    try:
        raw = spark.read.option("pathGlobFilter", glob).csv(path, header=True)
    except Exception as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise FileNotFoundError(f"no file like {glob} in {path}") from error
        raise
    require_rows(raw, f"no file like {glob} in {path}")
    values = ("Temp", "DO_Pct", "DO_mgl", "pH")
    return raw.select(*schemas.LOGGER_COLUMNS, source_name().alias("source_file")).withColumns({
        "DateTimeStamp": mdy_datetime(F.col("DateTimeStamp")),
        **{v: F.col(v).try_cast("double") for v in values},
    })
