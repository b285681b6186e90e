"""Reports on readings: share per status, distribution, presence per station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import round_nearest
from .joins import null_safe_join
from .ordering import place_in_slices, running_total


def status_share(df: DataFrame, status: str) -> DataFrame:
    """Rows per status and their percentage of all rows."""
    counts = df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("per_status", round_nearest(F.col("n") * F.lit(100.0) / total, 2))


def value_distribution(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact quartiles, whiskers (1.5 times the quartile range) and number of outliers per key.

    Equal values are counted first; the distinct ones are then ranked in range-partitioned slices, so a key that holds
    most of the rows is spread over many tasks and no task ever holds a whole key.
    """
    cells = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cells = place_in_slices(cells, [*keys, "v"])
    ranked = running_total(cells, [*keys, "v"], "n", group=keys).withColumnRenamed("total", "size")

    def between(low: Column, high: Column, at: Column) -> Column:
        share = at - F.floor(at)
        return F.when(low == high, low).otherwise((1 - share) * low + share * high)

    quantiles = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    found = []
    for name, p in quantiles.items():
        at = (F.col("size") - 1) * F.lit(p)
        for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            holds = (rank >= F.col("running") - F.col("n")) & (rank < F.col("running"))
            found.append(F.max(F.when(holds, F.col("v"))).alias(f"{name}_{side}"))
    corners = ranked.groupBy(*keys).agg(F.max("size").alias("size"), *found)
    boxes = corners.select(
        *keys,
        "size",
        *(
            between(F.col(f"{name}_lo"), F.col(f"{name}_hi"), (F.col("size") - 1) * F.lit(p)).alias(name)
            for name, p in quantiles.items()
        ),
    )
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = (F.col("v") >= F.col("q1") - reach) & (F.col("v") <= F.col("q3") + reach)
    spread = null_safe_join(cells, boxes.drop("size"), keys)
    return spread.groupBy(*keys, *quantiles).agg(
        F.sum("n").alias("n"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("outliers"),
    )


def presence_flags(inventory: DataFrame, station: str, characteristic: str) -> DataFrame:
    """Per station: is there any temperature, and any ready-made 7-day series?"""
    name = F.col(characteristic)
    return inventory.groupBy(station).agg(
        F.bool_or(name.contains("Temperature")).alias("temp_in_group"),
        F.bool_or(name.contains("Temperature.7DADM")).alias("dadm7_in_group"),
    )


def stations_to_compute(inventory: DataFrame, station: str, characteristic: str) -> DataFrame:
    """Stations whose 7-day temperature has to be computed from raw readings."""
    flags = presence_flags(inventory, station, characteristic)
    return flags.filter(F.col("temp_in_group") & ~F.col("dadm7_in_group")).select(station)


def site_extent(df: DataFrame, site: str, date: str, characteristic: str) -> DataFrame:
    """Per site: first and last date and the names of its characteristics.

    Reduced to one row per site and name first, so only distinct names of a fixed vocabulary are gathered.
    """
    named = df.groupBy(site, characteristic).agg(F.min(date).alias("first"), F.max(date).alias("last"))
    return named.groupBy(site).agg(
        F.min("first").alias("min_date"),
        F.max("last").alias("max_date"),
        F.array_join(F.sort_array(F.collect_set(characteristic)), ", ").alias("chars"),
    )
