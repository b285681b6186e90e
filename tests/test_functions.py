import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from riverstat.functions import (
    activity_id,
    base_identifier,
    blank_to_null,
    clock_hhmm,
    date_text,
    fahrenheit_to_celsius,
    hour_key,
    iso_datetime,
    lookup,
    mdy_date,
    mdy_datetime,
    month_text,
    months_instrument_id,
    null_to_blank,
    round_nearest,
    strip_blanks,
    time_text,
    wall_clock,
)


def one(spark, column, **values):
    kinds = {int: "bigint", float: "double", str: "string", dt.date: "date", dt.datetime: "timestamp_ntz"}
    schema = ", ".join(f"{k} {kinds.get(type(v), 'string')}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("value", "digits", "expected"),
    [
        (2.675, 2, 2.67), (0.15, 1, 0.1), (0.25, 1, 0.2), (0.35, 1, 0.3), (0.45, 1, 0.4), (0.65, 1, 0.7),
        (1.005, 2, 1.0), (-2.675, 2, -2.67), (-0.25, 1, -0.2), (12.344, 2, 12.34), (12.346, 2, 12.35), (5.0, 2, 5.0),
        (1e300, 2, 1e300), (None, 2, None),
    ],
)
def test_round_nearest(spark, value, digits, expected):
    got = spark.createDataFrame([(value,)], "x double").select(round_nearest(F.col("x"), digits)).first()[0]
    assert got == expected


def test_fahrenheit(spark):
    assert one(spark, fahrenheit_to_celsius(F.col("x")), x=64.4) == 18.0
    assert one(spark, fahrenheit_to_celsius(F.col("x")), x=-40.0) == -40.0


def test_clock(spark):
    day = dt.date(2020, 7, 1)
    assert one(spark, iso_datetime(F.col("d"), F.col("t")), d=day, t="13:30:05") == dt.datetime(2020, 7, 1, 13, 30, 5)
    assert one(spark, iso_datetime(F.col("d"), F.col("t")), d=day, t="9:05") == dt.datetime(2020, 7, 1, 9, 5)
    assert one(spark, iso_datetime(F.col("d"), F.col("t")), d=day, t="late") is None
    assert one(spark, mdy_datetime(F.col("t")), t="7/4/2020 0:15") == dt.datetime(2020, 7, 4, 0, 15)
    assert one(spark, mdy_datetime(F.col("t")), t="2020") is None
    assert one(spark, mdy_date(F.col("t")), t="07-04-2020") == dt.date(2020, 7, 4)
    assert one(spark, mdy_date(F.col("t")), t="7/4/2020") == dt.date(2020, 7, 4)
    assert one(spark, hour_key(F.col("t")), t=dt.datetime(2020, 2, 1, 5, 59)) == "2020-032-05"
    for text in ("0:00", "00:00:00", "0:00:00"):
        assert one(spark, clock_hhmm(F.col("t")), t=text) == "00:00"
    assert one(spark, clock_hhmm(F.col("t")), t="13:05:59") == "13:05"


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_wall_clock(spark, session_zone):
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        zone = "America/Los_Angeles"
        expected = {
            "2024-01-01T00:00:00-08:00": dt.datetime(2024, 1, 1),
            "2024-07-01T08:30:00Z": dt.datetime(2024, 7, 1, 1, 30),
            "2024-07-01 08:30:00": dt.datetime(2024, 7, 1, 8, 30),
            "2024-03-10 02:30:00": dt.datetime(2024, 3, 10, 2, 30),
        }
        for text, wall in expected.items():
            assert one(spark, wall_clock(F.col("t"), zone), t=text) == wall
        skipped = dt.datetime(2024, 3, 10, 2, 30, 5)  # a clock time that daylight saving leaves out
        assert one(spark, time_text(F.col("t")), t=skipped) == "02:30:05"
        assert one(spark, date_text(F.col("t"), "/"), t=skipped) == "2024/03/10"
        assert one(spark, hour_key(F.col("t")), t=skipped) == "2024-070-02"
        assert one(spark, month_text(F.col("t")), t=dt.date(2024, 3, 10)) == "202403"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_text(spark):
    assert one(spark, activity_id(F.col("s"), F.col("d"), F.lit("FMC")), s="A", d=dt.date(2020, 7, 1)) == (
        "A:20200701:FMC"
    )
    assert one(spark, base_identifier(F.col("s")), s="pH.Primary@FC-8@x") == "pH.Primary"
    assert one(spark, strip_blanks(F.col("s")), s=" so wq ") == "sowq"
    assert one(spark, blank_to_null(F.col("s")), s="") is None
    assert one(spark, null_to_blank(F.col("s")), s=None) == ""
    assert one(spark, lookup(F.col("s"), {"a": "b"}, "z"), s="q") == "z"
    month = months_instrument_id(F.col("s"), F.col("a"), F.col("b"))
    assert one(spark, month, s="FC8", a=dt.datetime(2019, 4, 1), b=dt.datetime(2020, 12, 1)) == "FC8-201904-202012"
