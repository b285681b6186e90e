"""Landed files of the data services."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from .. import schemas
from ..operators.reshape import stack, with_missing
from . import json_records
from .files import source_name


def read_portal(spark: SparkSession, path: str, requests: DataFrame) -> DataFrame:
    """Portal exports, each tagged with the station, characteristic and unit of its request.

    `requests` has `file_name` (without extension), `station`, `char`, `unit`. The first line of a file is a banner, the next
    names the columns (a first cell that begins with date or timestamp, and no number); all others are rows, also those
    whose time does not parse (it is NULL then). A file that no request names is an error.
    """
    raw = spark.read.schema(schemas.PORTAL_CSV).csv(path, mode="PERMISSIVE", header=True)
    numbers = [f.name for f in schemas.PORTAL_CSV if f.dataType.simpleString() == "double"]
    named = F.lower("datetime").rlike("^(timestamp|date)") & F.coalesce(*numbers).isNull()
    rows = raw.select("*", source_name().alias("file_name")).filter(~F.coalesce(named, F.lit(False)))
    tags = requests.select(
        "file_name", F.col("station").alias("Monitoring_Location_ID"),
        F.col("char").alias("Characteristic_Name"), F.col("unit").alias("Result_Unit"), F.lit(True).alias("asked"),
    )
    unknown = F.raise_error(F.concat(F.lit("no request names the file "), F.col("file_name"))).cast("string")
    return (
        rows.join(tags, "file_name", "left")
        .withColumn("Monitoring_Location_ID", F.when(F.col("asked").isNull(), unknown).otherwise(F.col("Monitoring_Location_ID")))
        .withColumn("datetime", F.col("datetime").try_cast("timestamp_ntz"))
        .select(*schemas.PORTAL_COLUMNS)
    )


def read_hydrology(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Tab-separated exports as one long table: one row per known value column that a file has, NULL values included.

    Headers differ from file to file, so no schema is taken from them: each file's header line (it has a station or a date
    column; dots in names do not count) is a row of names that the file's other lines are joined with. So any number of
    files and layouts is one plan. A file without a header, or without a known value column, is an error.
    """
    ids = ("station_nbr", "record_date", "time_observed", "published_status", "download_date")
    unquoted = F.transform(F.split("value", "\t", -1), lambda cell: F.regexp_replace(cell, '^"(.*)"$', "$1"))
    lines = spark.read.text(list(paths.values())).select(
        unquoted.alias("cells"), F.col("_metadata.file_path").alias("file"), "value"
    ).filter(F.trim("value") != "")
    names = F.transform("cells", lambda cell: F.replace(cell, F.lit("."), F.lit("")))
    is_header = F.arrays_overlap(names, F.array(*map(F.lit, ids[:2])))
    headers = lines.filter(is_header).select("file", names.alias("names")).distinct()
    named = lines.filter(~is_header).select("file", "cells").join(headers, "file", "left")

    def cell(name: Column) -> Column:
        return F.nullif(F.get("cells", F.array_position("names", name).cast("int") - 1), F.lit(""))

    def error(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(text), F.col("file"))).cast("array<string>")

    present = F.array_intersect(F.array(*map(F.lit, K.HYDROLOGY_VALUE_COLUMNS)), "names")
    known = (
        F.when(F.col("names").isNull(), error("no header in "))
        .when(F.size(present) == 0, error("none of the known value columns is present in ")).otherwise(present)
    )
    long = named.select("names", "cells", F.explode(known).alias("Characteristic_Name"))
    columns = {name: cell(F.lit(name)) for name in ids}
    value = cell(F.col("Characteristic_Name")).try_cast("double")
    return long.select(
        *(columns[name].alias(name) for name in ids[:3]), "Characteristic_Name", value.alias("Result_Value"),
        *(columns[name].alias(name) for name in ids[3:]),
    )


def read_air(spark: SparkSession, *paths: str, data_types: tuple[str, ...] = ("TMAX",)) -> DataFrame:
    """Daily climate records of all paths in one read: each landed file is one JSON array, the answer to one request.

    A data type that a station does not report is NULL. A file of any size is read by many tasks (`json_records`).
    """
    return json_records.parsed(json_records.elements(json_records.read_objects(spark, *paths)), schemas.air_schema(data_types))


def explode_datasets(envelopes: DataFrame) -> DataFrame:
    """One row per point, the attributes of its data set in front; data sets without points give no row."""
    return (
        envelopes.filter(F.size("points") > 0)
        .select("dataset.*", F.explode("points").alias("point"))
        .select(*(c for c in envelopes.schema["dataset"].dataType.names), "point.*")
    )


def read_datasets(spark: SparkSession, path: str) -> DataFrame:
    """One row per point of all landed envelopes, the attributes of its data set in front.

    A landed file is one envelope: an object with an array `points` and an object `dataset`, in any order. The points of a
    large one are read by many tasks (`json_records`) and joined with the one row of their file's data set.
    """
    envelope = {f.name: f.dataType for f in schemas.PORTAL_JSON}
    objects = json_records.read_objects(spark, path)
    points = json_records.parsed(json_records.elements(objects, "points"), envelope["points"].elementType, "file")
    several = F.raise_error(F.concat(F.lit("more than one data set in "), F.col("file"))).cast(envelope["dataset"])
    sets = (
        json_records.named(objects, "dataset").groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.max("object").alias("object"))
        .select("file", F.when(F.col("n") > 1, several).otherwise(F.from_json("object", envelope["dataset"])).alias("dataset"))
    )
    return points.join(sets, "file", "left").select("dataset.*", *(F.col(c) for c in points.columns if c != "file"))


def read_catalogue(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Identifiers of the data sets with the given label."""
    raw = spark.read.schema(schemas.CATALOGUE_JSON).json(path, multiLine=True)
    return (
        raw.select(F.explode("features.properties").alias("p"))
        .filter(F.col("p.dataSetLabel") == label)
        .select(F.col("p.dataSetIdentifier").alias("dataSetIdentifier"))
    )


def wanted_datasets(points: DataFrame, *catalogues: DataFrame) -> DataFrame:
    """Points of the data sets that one of the catalogues names."""
    names = stack(*catalogues).select(F.col("dataSetIdentifier").alias("identifier"))
    return points.join(names, "identifier", "left_semi")


def name_daily_values(df: DataFrame, parameter: str) -> DataFrame:
    """Give the coded columns of the service (`X_00010_00001`, `..._cd`) their names."""
    renames = {}
    for statistic, name in K.DAILY_VALUE_COLUMNS[parameter].items():
        renames[f"X_{parameter}_{statistic}"] = name
        renames[f"X_{parameter}_{statistic}_cd"] = f"{name}_cd"
    return df.withColumnsRenamed(renames)


def read_daily_values(spark: SparkSession, path: str, parameter: str, fmt: str = "parquet") -> DataFrame:
    """Daily values of one parameter, with all statistic columns present and typed."""
    schema = schemas.daily_value_schema(tuple(K.DAILY_VALUE_COLUMNS[parameter].values()))
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    named = name_daily_values(reader.load(path), parameter)
    full = with_missing(named, {f.name: f.dataType.simpleString() for f in schema})
    return full.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))


def read_instant_ph(spark: SparkSession, *paths: str) -> DataFrame:
    """Instantaneous values; all landed parts in one read."""
    return spark.read.schema(schemas.INSTANT_PH).csv(list(paths), header=True)


def read_existing(source: DataFrame, columns: tuple[str, ...] = tuple(schemas.EXISTING_RESULTS.names)) -> DataFrame:
    """The results store as the reconcile operators use it, from any source (Parquet, or `spark.read.jdbc(...)`).

    Only a projection: filters put on top of it, like the projection itself, are pushed into the source by Spark.
    """
    return source.select(*(c for c in columns if c in source.columns))
