"""Numbers: rounding, unit conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def round_nearest(value: Column, digits: int) -> Column:
    """Round to the nearer of the two neighbours with `digits` decimals; an exact tie goes to the even one.

    The distance is measured on the doubles themselves, so 2.675 (stored just below) becomes 2.67 and 0.25 becomes 0.2.
    """
    power = F.lit(float(10**digits))
    scaled = value * power
    down = F.floor(scaled)
    lower = down / power
    upper = F.ceil(scaled) / power
    to_lower = value - lower
    to_upper = upper - value
    nearest = F.when((to_lower < to_upper) | ((to_lower == to_upper) & (down % 2 == 0)), lower).otherwise(upper)
    # beyond 2^52 a double has no decimals left to round
    return F.when(F.abs(scaled) < F.lit(float(2**52)), nearest).otherwise(value)


def fahrenheit_to_celsius(value: Column) -> Column:
    return round_nearest((value - F.lit(32.0)) * F.lit(5.0 / 9.0), 2)
