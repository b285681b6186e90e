"""Sums and means of doubles that are the same in every order.

A double is cut, without rounding, into whole numbers of 32 bits at fixed places: multiples of 2^32, 1, 2^-32, 2^-64 and 2^-96.
Each place is summed as a long, which has no order; a group's five sums are put together once, with their carries, so a
mean does not depend on partitioning, retries or task order, and running totals can be subtracted from one another without
loss. All bits of values between 2^-44 and 2^63 lie at these places. Bits below 2^-96 and values of 2^63 or more are not
lost: they are added as doubles, so only there the last digit of a sum could depend on the order. Up to 2^31 rows fit a
group whatever their values; beyond, an overflow is an error. NULL and NaN are missing; infinities stay infinite.

The cutting is a chain of columns, each used by the next, so that a row pays for it once: `with_limbs` adds them, `limb_sums`
are the aggregates over them, `mean_sql` puts these together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Aggregates of a mean, by the end of their column's name.
PLACES = ("p32", "p0", "m32", "m64", "m96")
DOUBLES = ("rest", "big")
PARTS = ("n", *PLACES, *DOUBLES)


def _power(exponent: int) -> str:
    return f"{2.0 ** exponent!r}D"


def _name(value: str, part: str) -> str:
    return f"_{value}_{part}"


def limb_columns(value: str) -> dict[str, str]:
    """SQL of the columns that cut a value, in an order in which each may use those before it."""

    def c(part: str) -> str:
        return f"`{_name(value, part)}`"

    x, left = c("x"), c("y")
    columns = {
        "x": f"nanvl(CAST(`{value}` AS DOUBLE), CAST(NULL AS DOUBLE))",
        "y": f"CASE WHEN abs({x}) < {_power(63)} THEN {x} ELSE 0D END",
        "big": f"CASE WHEN abs({x}) >= {_power(63)} THEN {x} END",
    }
    # Multiples of powers of two and what is left of a number are exact; what is left is only ever scaled up.
    columns["p32"] = f"CAST({left} * {_power(-32)} AS BIGINT)"
    columns["lp32"] = f"{left} - {c('p32')} * {_power(32)}"
    left = c("lp32")
    for place in ("p0", "m32", "m64"):
        columns[place] = f"CAST({left} AS BIGINT)"
        columns[f"l{place}"] = f"({left} - {c(place)}) * {_power(32)}"
        left = c(f"l{place}")
    columns["m96"] = f"CAST({left} AS BIGINT)"
    columns["rest"] = f"({left} - {c('m96')}) * {_power(-96)}"
    return {_name(value, part): sql for part, sql in columns.items()}


def with_limbs(df: DataFrame, *values: str) -> DataFrame:
    """Add the columns that cut the values; `limb_sums` needs them."""
    made = {n: sql for v in dict.fromkeys(values) for n, sql in limb_columns(v).items()}
    return df.selectExpr("*", *(f"{sql} AS `{n}`" for n, sql in made.items()))


def limb_sums(value: str) -> dict[str, str]:
    """SQL of the aggregates of a value's mean by part; each may be taken over a window."""
    places = {p: f"sum(`{_name(value, p)}`)" for p in (*PLACES, *DOUBLES)}
    return {"n": f"count(`{_name(value, 'x')}`)", **places}


def mean_sql(parts: Mapping[str, str], usable: str = "true") -> str:
    """SQL that puts a group's sums (columns named by part) together to its mean; NULL unless `usable`.

    Each sum is parted into its upper bits, which go to the next place, and its lower 32, from -2^31 to 2^31; so no place
    cancels much of a higher one. What lies above the point is added to what lies below it with the digits that this
    addition loses, so the sum is rounded once where it is below 2^53, and is within its last digit beyond. It is a plain
    formula in which few terms repeat, whatever a filter on the mean is pushed through.
    """

    def given(part: str) -> str:
        return f"coalesce(`{parts[part]}`, 0)"

    def upper(place: str) -> str:
        return f"shiftright({given(place)} + 2147483648L, 32)"

    def term(place: str, below: str | None, exponent: int) -> str:
        lower = f"{given(place)} - shiftleft({upper(place)}, 32)"
        return f"({lower}{f' + {upper(below)}' if below else ''}) * {_power(exponent)}"

    whole = f"({upper('p32')} * {_power(64)} + {term('p32', 'p0', 32)} + {term('p0', 'm32', 0)})"
    part = f"({term('m32', 'm64', -32)})"
    low = f"({term('m64', 'm96', -64)} + ({term('m96', None, -96)} + {given('rest')}))"
    total = f"(({whole} + {part}) + (({part} - (({whole} + {part}) - {whole})) + {low}) + {given('big')})"
    return f"CASE WHEN {usable} AND `{parts['n']}` > 0 THEN {total} / `{parts['n']}` END"


def grouped(
    df: DataFrame, keys: Sequence[str | Column], means: Mapping[str, str], *others: Column,
    rule: Callable[[str], Column] | None = None,
) -> DataFrame:
    """groupBy(keys).agg(others) with the exact mean of a value for each `out: value`.

    `rule` may make a condition, an aggregate, of a value; where it is false the mean is NULL. It is one aggregation, with
    the usual part in each task before the shuffle.
    """
    values = list(dict.fromkeys(means.values()))
    sums = {f"_{v}_sum_{p}": F.expr(s) for v in values for p, s in limb_sums(v).items()}
    ruled = {f"_{v}_rule": rule(v) for v in values} if rule else {}
    rows = with_limbs(df, *values).groupBy(*keys).agg(*others, *(s.alias(n) for n, s in {**sums, **ruled}.items()))
    kept = [c for c in rows.columns if c not in sums and c not in ruled]
    made = {
        out: mean_sql({p: f"_{v}_sum_{p}" for p in PARTS}, f"`_{v}_rule`" if rule else "true") for out, v in means.items()
    }
    return rows.selectExpr(*(f"`{c}`" for c in kept), *(f"{sql} AS `{out}`" for out, sql in made.items()))
