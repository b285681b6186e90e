"""Submitted readings: one file per submission, or one submission in several parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .. import schemas
from ..operators.quality import repair_characteristic
from .files import source_name


def read_readings(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """A file or a folder of files in the 9-column form; columns are taken by position, whatever the header says."""
    return (
        spark.read.schema(schemas.READINGS)
        .option("pathGlobFilter", glob)
        .csv(path, header=True, enforceSchema=True)
        .select("*", source_name().alias("source_file"))
    )


def read_project(spark: SparkSession, path: str, is_salem: bool = False) -> DataFrame:
    """One row: the alternate project, which is the first cell of the project file (or the fixed one)."""
    first = spark.read.csv(path, header=True).limit(1)
    value = F.lit(K.SALEM_PROJECT) if is_salem else F.col(first.columns[0])
    return first.select(value.alias("alt_project"))


def read_multi_part(spark: SparkSession, path: str, glob: str = "*Results*") -> DataFrame:
    """All parts named like `Results`, internal columns dropped, the others named by position and stacked."""
    raw = spark.read.option("pathGlobFilter", glob).csv(path, header=True)
    kept = raw.drop(*schemas.MULTI_PART_DROPPED).toDF(*schemas.MULTI_PART_COLUMNS)
    typed = kept.withColumns({
        "Activity_Start_Date": F.col("Activity_Start_Date").try_cast("date"),
        "Result_Value": F.col("Result_Value").try_cast("double"),
    })
    return repair_characteristic(typed, "Characteristic_Name", {"Temperature,water": K.TEMPERATURE})


def read_projects(spark: SparkSession, path: str, suffix: str = "-project", glob: str = "*.csv") -> DataFrame:
    """Alternate project per submission: the first cell of each file `<submission><suffix>.csv` of a folder."""
    raw = spark.read.option("pathGlobFilter", glob).csv(path, header=True)
    named = raw.select(
        source_name().alias("file"), F.col(raw.columns[0]).alias("cell"), F.monotonically_increasing_id().alias("line")
    )
    first = named.groupBy("file").agg(F.min_by("cell", "line").alias("alt_project"))
    return first.select(F.regexp_replace("file", f"{suffix}$", "").alias("source_file"), "alt_project")


def read_continuous_ph(spark: SparkSession, path: str, glob: str = "*pH*") -> DataFrame:
    """Continuous pH imports of a folder, to correct them in one go."""
    raw = spark.read.option("pathGlobFilter", glob).csv(path, header=True)
    return raw.select("*", source_name().alias("source_file"))
