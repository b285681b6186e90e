"""Exact sums: against fractions, in any order, at all magnitudes."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from riverstat.functions import grouped


def mean(spark, *values):
    return grouped(spark.createDataFrame([(v,) for v in values], "x double"), [], {"m": "x"}).first()[0]


def test_against_fractions(spark):
    """Rounded once wherever the bits lie between 2^-96 and 2^53, whatever the signs and magnitudes that meet."""
    rng = random.Random(1)
    kinds = [
        lambda: round(rng.uniform(0, 500), 2), lambda: rng.uniform(-1, 1), lambda: float(rng.randint(-10**12, 10**12)),
        lambda: rng.uniform(-1e-3, 1e-3) * 2**-30, lambda: rng.choice([3e12, -3e12, 1.0, 1e-9]),
    ]
    rows, expected = [], {}
    for g in range(500):
        values = [kinds[g % len(kinds)]() for _ in range(rng.randint(1, 40))]
        rows += [(g, v) for v in values]
        expected[g] = float(sum(map(Fraction, values))) / len(values)
    df = spark.createDataFrame(rows, "g long, x double").repartition(7)
    assert {r.g: r.m for r in grouped(df, ["g"], {"m": "x"}).collect()} == expected


def test_does_not_depend_on_order(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.uniform(-9, 15) for _ in range(3000)]
    means = set()
    for parts in (1, 3, 8):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        means.add(grouped(df, [], {"m": "x"}).first()[0])
    assert len(means) == 1
    assert math.isclose(means.pop(), math.fsum(values) / len(values), rel_tol=1e-15)


def test_has_no_limits(spark):
    assert mean(spark, 1e-19, 3e-19) == 2e-19
    assert mean(spark, 1e-10, 3e-10) == 2e-10
    assert mean(spark, 0.1234567891234, 0.1234567891239) == float(Fraction(0.1234567891234) + Fraction(0.1234567891239)) / 2
    assert mean(spark, *[3.9e9] * 6) == 3.9e9
    assert mean(spark, 9e19, 9e19) == 9e19
    assert mean(spark, 1e300, 3e300) == 2e300
    assert mean(spark, 5e-324) == 5e-324
    assert mean(spark, 1e22, 1.0, -1e22) == 1 / 3
    assert mean(spark, math.inf, 1.0) == math.inf
    assert mean(spark, None, 2.0, math.nan) == 2.0
    assert mean(spark, None, None) is None and mean(spark) is None
    assert mean(spark, 0.0, -0.0) == 0.0


def test_decimals_and_whole_numbers(spark):
    df = spark.sql("select cast(v as decimal(12,2)) x, cast(v * 10 as int) i from values (1.10), (2.20), (3.40) as t(v)")
    row = grouped(df, [], {"m": "x", "n": "i"}).first()
    assert math.isclose(row.m, 6.7 / 3, rel_tol=1e-15) and row.n == 67 / 3


@pytest.mark.parametrize("name", ["a b", "x.y", "n"])
def test_odd_names_and_a_rule(spark, name):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, 4.0)], ["k", name])
    plain = {r.k: r.m for r in grouped(df, ["k"], {"m": name}).collect()}
    ruled = {r.k: r.m for r in grouped(df, ["k"], {"m": name}, rule=lambda v: F.count(F.lit(1)) == 1).collect()}
    assert plain == {1: 2.0, 2: 4.0} and ruled == {1: None, 2: 4.0}


def test_one_hash_aggregation(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("x"))
    plan = grouped(df, ["k"], {"m": "x"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan and "partial_sum" in plan
