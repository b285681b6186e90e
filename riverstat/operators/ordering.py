"""Running totals in a global order, without a single sorted task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join


# Rows of the sample per slice, and the most slices.
PER_SLICE, MOST_SLICES = 16, 4096


def place_in_slices(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Cut the rows into slices of about the same size of a global order, numbered in `_slice`.

    `order` identifies a row, so no value can dominate a slice. Bounds come from a sample of `PER_SLICE` rows a slice, those
    of the smallest hash in as many groups of hashes. So they depend on the rows alone: every use, and every task that is
    run again, has the same slices, and nothing has to be run or written while the plan is built. There are as many slices
    as shuffle partitions, up to `MOST_SLICES`.
    """
    slices = min(slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_SLICES)
    key, mixed = F.struct(*order), F.xxhash64(*order)
    # All columns are carried, so that the sample is taken from the same exchange that the rows come from.
    sample = df.groupBy(F.pmod(mixed, F.lit(slices * PER_SLICE)).alias("group")).agg(
        F.min_by(F.struct(key.alias("key"), *df.columns), mixed)["key"].alias("key")
    )
    every = f"greatest(1, ceil(size(ordered) / {slices}))"
    bounds = sample.agg(F.sort_array(F.collect_list("key")).alias("ordered")).selectExpr(
        f"filter(ordered, (x, i) -> i % {every} = {every} - 1) AS bounds"
    ).scalar()

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get("_bounds", at + step - 1) < key, at + step).otherwise(at)

    steps = F.array(*(F.lit(1 << i) for i in reversed(range(slices.bit_length()))))
    return df.withColumn("_bounds", bounds).withColumn("_slice", F.reduce(steps, F.lit(0), further)).drop("_bounds")


def running_total(placed: DataFrame, order: Sequence[str], amount: str, group: Sequence[str] = ()) -> DataFrame:
    """Add `running`, the total of `amount` up to and including the row, and `total`, that of its whole group.

    `placed` comes from `place_in_slices` with an order that starts with `group`. Each slice is summed on its own; what
    went before it, and the group's total, come from one row per slice and group in it.
    """
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = placed.groupBy(*group, "_slice").agg(F.sum(amount).alias("_sum")).select(
        *group, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_sum").over(whole).alias("total"),
    )
    in_slice = (
        Window.partitionBy("_slice", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = placed.withColumn("_inside", F.sum(amount).over(in_slice))
    return (
        null_safe_join(summed, per_slice, [*group, "_slice"])
        .withColumn("running", F.col("_inside") + F.col("_before"))
        .drop("_slice", "_inside", "_before")
    )
