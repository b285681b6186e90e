"""Moving statistics over calendar days."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import PARTS, grouped, limb_sums, mean_sql, with_limbs


@dataclass(frozen=True)
class MovingMean:
    """`out` = mean of `value` over the `days` calendar days that end on the row's day."""

    out: str
    value: str
    days: int


MAX_7 = MovingMean("ma_max7", "dyMax", 7)
MEAN_7 = MovingMean("ma_mean7", "dyMean", 7)
MIN_7 = MovingMean("ma_min7", "dyMin", 7)
MEAN_30 = MovingMean("ma_mean30", "dyMean", 30)


def moving(
    df: DataFrame,
    keys: Sequence[str],
    day: str,
    stats: Sequence[MovingMean],
    bounds: tuple[str, str] | None = None,
    null_poison: bool = False,
) -> DataFrame:
    """Add moving means to a daily series (one row per series and day).

    The frame is a range of days, so missing days shrink it. A mean needs `days - 1` rows in its frame and the series
    must have reached its `days`-th row (column `row`). With `null_poison` a NULL in the frame makes the mean NULL.
    `bounds` = (start, end) columns adds the frame's earliest start and latest end as `ana_startdate<days>` and
    `ana_enddate<days>`.

    Each row carries the running totals of its series up to its day, and those up to the day before its frame; a mean is
    their difference, so a row costs the same whatever the length of the frame. The totals are whole numbers
    (`functions.exact`), which lose nothing when they are subtracted. Both are frames without a beginning, which Spark
    extends row by row. The window holds one series at daily grain: at most 366 rows per year of record, whatever the
    number of readings.
    """
    series = ", ".join(f"`{k}`" for k in keys)
    by_day = f"PARTITION BY {series} ORDER BY unix_date(`{day}`) RANGE BETWEEN"

    def between(total: str, days: int) -> str:
        until = f"OVER ({by_day} UNBOUNDED PRECEDING AND"
        return f"coalesce({total} {until} CURRENT ROW), 0) - coalesce({total} {until} {days} PRECEDING), 0)"

    parts = {"row": f"count(1) OVER ({by_day} UNBOUNDED PRECEDING AND CURRENT ROW)"}
    for days in sorted({s.days for s in stats}):
        frame = f"OVER ({by_day} {days - 1} PRECEDING AND CURRENT ROW)"
        parts[f"_rows{days}"] = between("count(1)", days)
        for value in dict.fromkeys(s.value for s in stats if s.days == days):
            sums = limb_sums(value)
            # Doubles lose digits when they are subtracted; there are some only in numbers of 2^63 or more.
            big = f"{sums.pop('big')} {frame}"
            parts |= {**{f"_{value}{days}_{p}": between(s, days) for p, s in sums.items()}, f"_{value}{days}_big": big}
        if bounds:
            parts[f"ana_startdate{days}"] = f"min(`{bounds[0]}`) {frame}"
            parts[f"ana_enddate{days}"] = f"max(`{bounds[1]}`) {frame}"
    dated = with_limbs(df.filter(F.col(day).isNotNull()), *(s.value for s in stats))
    summed = dated.selectExpr("*", *(f"{sql} AS `{n}`" for n, sql in parts.items()))
    made = {}
    for stat in stats:
        names = {p: f"_{stat.value}{stat.days}_{p}" for p in PARTS}
        enough = f"_rows{stat.days} >= {stat.days - 1} AND row >= {stat.days}"
        if null_poison:
            enough += f" AND `{names['n']}` = _rows{stat.days}"
        made[stat.out] = mean_sql(names, enough)
    kept = [*df.columns, *(c for c in parts if not c.startswith("_"))]
    return summed.selectExpr(*(f"`{c}`" for c in kept), *(f"{sql} AS `{out}`" for out, sql in made.items()))


def day_cells(
    df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """Daily grain of a table that comes with one row per series and day.

    A day that occurs more than once counts once, with the mean of its values (NULL if one of them is) and the smallest
    of the `carried` texts. This keeps the windows bounded by the calendar whatever the table holds, and the rows of a
    series that dominates the table are reduced before they meet.
    """
    # NaN counts as missing in a mean, and as a value here.
    return grouped(
        df.filter(F.col(day).isNotNull()), [*keys, day], {v: v for v in values}, *(F.min(c).alias(c) for c in carried),
        rule=lambda v: F.count(v) == F.count(F.lit(1)),
    )
