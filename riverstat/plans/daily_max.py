"""Published daily maximum temperatures -> 7-day statistics in the daily-value template."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import activity_id, mdy_date, round_nearest
from ..operators.moving import MovingMean, day_cells, moving
from ..operators.reshape import stack
from ..operators.template import DAILY_MAX, analysis_bounds, time_basis, to_template


def published(df: DataFrame) -> DataFrame:
    return df.filter(F.col("published_status") == K.PUBLISHED)


def of_characteristics(df: DataFrame, names: Sequence[str] = K.DAILY_MAX_CELSIUS) -> DataFrame:
    """Rows of the asked characteristics; other value columns of the same files are not temperatures."""
    return df.filter(F.col("Characteristic_Name").isin(*names))


def daily_max_temperature(df: DataFrame, project: str = "") -> DataFrame:
    """Template rows of daily maxima (`station_nbr, record_date, Result_Value`) and of the 7-day means over them."""
    keys, day = ["station_nbr"], "Date"
    dated = df.select(*keys, mdy_date(F.col("record_date")).alias(day), "Result_Value")
    cells = day_cells(dated, keys, day, ["Result_Value"])
    moved = moving(
        cells, keys, day, [MovingMean("ma_max7", "Result_Value", 7)], bounds=(day, day), null_poison=True
    )
    periods = {"1 Day": (day, day), "7 Day": ("ana_startdate7", "ana_enddate7")}

    def template(long: DataFrame, name: str, comment: str) -> DataFrame:
        basis = time_basis(F.lit(name))
        ranges = {b: c for b, c in periods.items() if c[0] in long.columns}
        return to_template(
            long.filter(F.col("Result").isNotNull()), DAILY_MAX,
            {
                "CharID": K.TEMPERATURE,
                "Result": round_nearest(F.col("Result"), 1),
                "Unit": "deg C",
                "Method": "T-170.1",
                "StatisticalBasis": name,
                "RsltTimeBasis": basis,
                "DEQ_RsltComment": comment,
                "SiteID": F.col("station_nbr"),
                "Project": project,
                "ActStartDate": F.col(day),
                "ActEndDate": F.col(day),
                "ActivityID": activity_id(F.col("station_nbr"), F.col(day), F.lit("FMC")),
                **analysis_bounds(basis, ranges),
            },
        )

    return stack(
        template(dated.withColumnRenamed("Result_Value", "Result"), K.DAILY_MAX, ""),
        template(moved.withColumnRenamed("ma_max7", "Result"), K.MOVING_MAX_7, K.GENERATED_COMMENT),
    )
