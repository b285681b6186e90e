"""Tables of what to fetch: one row per request. Fetching itself is not done here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import base_identifier, lookup


def _combinations(stations: DataFrame, station: str, names: Sequence[str], known: Sequence[str]) -> DataFrame:
    """Every station with every name: the names are a fixed list, so each row just repeats for them."""
    unknown = sorted(set(names) - set(known))
    if unknown:
        raise ValueError(f"not a known characteristic: {', '.join(unknown)}")
    return stations.select(
        F.col(station).cast("string").alias("station"), F.explode(F.array(*map(F.lit, names))).alias("char")
    )


def portal_requests(
    stations: DataFrame, station: str, startdate: str, enddate: str, chars: Sequence[str], base_url: str
) -> DataFrame:
    """Requests of the city portal: `url, station, char, unit`, and the `file_name` under which an answer is landed.

    The table is what `services.read_portal` tags the landed files with.
    """
    units = {c: u for c, u in K.PORTAL_UNITS.items() if u is not None}
    rows = _combinations(stations, station, chars, list(K.PORTAL_UNITS)).withColumn(
        "unit", lookup(F.col("char"), units, F.lit(None).cast("string"))
    )
    url = F.concat(
        F.lit(base_url), F.lit("DataSet="), F.replace(F.col("char"), F.lit(" "), F.lit("%20")), F.lit("%40"),
        F.col("station"),
        F.lit(f"&StartTime={startdate}%2000:00:0%20&EndTime={enddate}%2000:00:0%20"),
        F.lit("&ExportFormat=csv&Compressed=false&Unit="), F.coalesce(F.col("unit"), F.lit("NA")),
        F.lit("&Timezone=-8"),
    )
    return rows.select(url.alias("url"), "station", "char", "unit", landed_name(F.col("station"), F.col("char")).alias("file_name"))


def landed_name(station: Column, characteristic: Column) -> Column:
    """Name of a landed file, without extension: what is not a letter, digit, `-` or `.` becomes `_`."""
    return F.regexp_replace(F.concat(station, F.lit("@"), characteristic), "[^A-Za-z0-9.-]", "_")


def hydrology_requests(
    stations: DataFrame, station: str, startdate: str, enddate: str, chars: Sequence[str], base_url: str
) -> DataFrame:
    """Requests of the state hydrology service; temperatures are asked for in deg C."""
    rows = _combinations(
        stations, station, chars, (*K.HYDROLOGY_FLOW_SETS, *K.HYDROLOGY_TEMPERATURE_SETS)
    )
    suffix = F.when(F.col("char").isin(*K.HYDROLOGY_FLOW_SETS), F.lit("&format=tab")).otherwise(
        F.lit("&format=tab&units=C")
    )
    query = F.concat(
        F.lit(base_url), F.lit("station_nbr="), F.col("station"),
        F.lit(f"&start_date={startdate}%2012:00:00%20AM&end_date={enddate}%2012:00:00%20AM&dataset="),
        F.col("char"), suffix,
    )
    return rows.select(query.alias("query"), "station", "char")


def air_requests(
    stations: DataFrame, station: str, startdate: str, enddate: str, base_url: str, data_type: str = "TMAX"
) -> DataFrame:
    query = F.concat(
        F.lit(f"{base_url}&dataTypes={data_type}&startDate={startdate}&endDate={enddate}&stations="), F.col(station)
    )
    return stations.select(query.alias("query"), F.col(station).alias("station"))


def inventory_from_catalogue(
    catalogue: DataFrame, startdate: str, enddate: str,
    chars: Sequence[str] = K.PORTAL_INVENTORY_CHARACTERISTICS,
) -> DataFrame:
    """Inventory of the data sets of a catalogue (`LocationIdentifier, Identifier`), wanted characteristics only."""
    return catalogue.select(
        F.col("LocationIdentifier").alias("station"),
        F.lit(startdate).alias("startdate"),
        F.lit(enddate).alias("enddate"),
        base_identifier(F.col("Identifier")).alias("char"),
    ).filter(F.col("char").isin(*chars))


def keep_inventoried(
    readings: DataFrame, inventory: DataFrame, station: str, characteristic: str, date: Column
) -> DataFrame:
    """Readings that some inventory row asks for: its station, its characteristic, inside its dates.

    An inventory without dates asks for all times. The intervals of a station and characteristic are first joined into
    disjoint ones, in the order of their days, and become one row; so a reading meets at most one row, however many
    intervals overlap, and a station that dominates the readings makes no pairs.
    """
    dated = {"startdate", "enddate"} <= set(inventory.columns)
    named = inventory.select(F.col("station").alias("_station"), F.col("char").alias("_char"), *(
        [F.col("startdate").cast("date").alias("_from"), F.col("enddate").cast("date").alias("_to")] if dated else []
    ))
    same = (F.col(station) == F.col("_station")) & (F.col(characteristic) == F.col("_char"))
    if not dated:
        return readings.join(named.distinct(), same, "left_semi")
    disjoint = disjoint_intervals(named.filter("_from <= _to"), ["_station", "_char"], "_from", "_to")
    wanted = disjoint.groupBy("_station", "_char").agg(F.collect_list(F.struct("_from", "_to")).alias("_spans"))
    day = date.cast("date")
    inside = F.exists("_spans", lambda span: day.between(span["_from"], span["_to"]))
    return readings.join(wanted, same).filter(inside).drop("_station", "_char", "_spans")


def disjoint_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """The days of a key's intervals as the fewest intervals; those that overlap or follow one another are one."""
    by_start = Window.partitionBy(*keys).orderBy(start)
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.max(end).over(before) < F.date_sub(start, 1), F.lit(True)).cast("int")
    numbered = (
        df.select(*keys, start, end).distinct().withColumn("_opens", opens)
        .withColumn("_number", F.sum("_opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return numbered.groupBy(*keys, "_number").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_number")
