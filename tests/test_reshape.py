import pytest
from pyspark.sql import functions as F

from riverstat.operators.reshape import any_of_long, flagged_long, stack, to_statistics, with_missing
from riverstat.operators.template import (
    DAILY_VALUE_COLUMNS,
    LOGGER_COLUMNS,
    PORTAL_COLUMNS,
    SUBMISSION,
    SUBMISSION_COLUMNS,
    to_template,
)


def test_unpivot_has_one_row_per_value(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 2.0, 5.0)], "id int, dyMax double, ma_max7 double")
    long = to_statistics(df, ["id"])
    assert long.count() == 3
    assert {(r.id, r.StatisticalBasis, r.Result) for r in long.collect()} == {
        (1, "Daily Maximum", 1.0), (3, "Daily Maximum", 2.0), (3, "7DMADMax", 5.0)
    }


def test_flags_travel_with_their_value(spark):
    df = spark.createDataFrame([(1, 1.0, "<0>", 2.0, "<1>")], "id int, a double, fa string, b double, fb string")
    long = flagged_long(df, ["id"], {"a": ("a", "fa"), "b": ("b", "fb"), "b2": ("b", "fa")}, "name", "value", "flag")
    assert {(r.name, r.value, r.flag) for r in long.collect()} == {
        ("a", 1.0, "<0>"), ("b", 2.0, "<1>"), ("b2", 2.0, "<0>")
    }


def test_any_of_needs_one_known_column(spark):
    df = spark.createDataFrame([(1, 5)], "id int, unknown int")
    with pytest.raises(ValueError):
        any_of_long(df, ["id"], ["known"], "n", "v")


def test_missing_columns(spark):
    df = with_missing(spark.range(1), {"id": "bigint", "x": "string"})
    assert df.dtypes == [("id", "bigint"), ("x", "string")]
    one = spark.createDataFrame([(1,)], "id int")
    both = stack(one, one.withColumn("y", F.lit("a")))
    assert both.columns == ["id", "y"] and both.filter("y is null").count() == 1


def test_template_widths():
    assert (len(SUBMISSION_COLUMNS), len(LOGGER_COLUMNS), len(PORTAL_COLUMNS), len(DAILY_VALUE_COLUMNS)) == (
        32, 30, 32, 33
    )


def test_template_refuses_a_forgotten_column(spark):
    with pytest.raises(Exception, match="charID"):
        to_template(spark.range(1), SUBMISSION, {})
