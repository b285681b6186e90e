"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (its smallest node) for every node of the links, which may repeat, in any direction.

    Each round hangs the larger neighbours of a node below its smallest neighbour, and then its smaller neighbours too;
    components become stars after a number of rounds that grows with the logarithm of their diameter. A round reads and
    writes one row per edge, its two minima are taken in each task before the shuffle, and its edges go to the shared folder.
    """
    edges = cut(
        links.filter(F.col(a) != F.col(b))
        .select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).distinct()
    )
    state = _state(edges)
    while True:
        above = cut(edges.groupBy("hi").agg(F.min("lo").alias("top")))
        large = cut(
            edges.join(above.withColumnRenamed("hi", "lo"), "lo", "left")
            .select(F.coalesce("top", "lo").alias("lo"), "hi").distinct()
        )
        least = cut(large.groupBy("hi").agg(F.min("lo").alias("top")))
        small = large.join(least, "hi").filter(F.col("lo") != F.col("top")).select(
            F.col("top").alias("lo"), F.col("lo").alias("hi")
        )
        edges = cut(least.select(F.col("top").alias("lo"), "hi").unionByName(small).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    below = edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return cut(below.unionByName(roots))
