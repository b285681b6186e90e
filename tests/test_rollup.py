import datetime as dt

from pyspark.sql import functions as F

from riverstat.operators.rollup import complete_days, daily, hourly

START = dt.datetime(2020, 7, 1)


def readings(spark, rows):
    return spark.createDataFrame(rows, "station string, ts timestamp_ntz, value double")


def test_completeness_thresholds(spark):
    rows = [
        (f"s{n}", START + dt.timedelta(hours=h), float(h)) for n in (24, 22, 21, 20, 19) for h in range(n)
    ]
    days = {r.station: r for r in daily(hourly(readings(spark, rows), ["station"], "ts", "value"), ["station"]).collect()}
    assert [days[f"s{n}"].hrNday for n in (22, 21, 20, 19)] == [22, 21, 20, 19]
    assert days["s22"].ResultStatusID == "Final" and days["s22"].cmnt == "Generated by ORDEQ"
    assert days["s21"].ResultStatusID == "Rejected"
    assert days["s21"].cmnt == "Generated by ORDEQ; Estimated - 21 hrs with valid data in day"
    assert days["s20"].cmnt == "Generated by ORDEQ; Estimated - 20 hrs with valid data in day"
    assert days["s19"].cmnt == "Generated by ORDEQ; Rejected - 19 hrs with valid data in day"
    full = daily(hourly(readings(spark, rows), ["station"], "ts", "value"), ["station"])
    assert {r.station for r in complete_days(full).collect()} == {"s24", "s22"}


def test_mean_of_hourly_means_and_null_hours(spark):
    at = lambda h, m: START + dt.timedelta(hours=h, minutes=m)
    rows = [("a", at(0, 0), 1.0), ("a", at(0, 30), 3.0), ("a", at(1, 0), 10.0), ("a", at(2, 0), None),
            ("a", at(3, 0), None), ("a", at(3, 30), 4.0), ("a", None, 99.0)]
    hours = hourly(readings(spark, rows), ["station"], "ts", "value").orderBy("hour").collect()
    assert [(h.hour, h.hrN, h.hrMean) for h in hours] == [(0, 2, 2.0), (1, 1, 10.0), (3, 1, 4.0)]
    assert hours[2].hrDTmin == at(3, 0)
    day = daily(hourly(readings(spark, rows), ["station"], "ts", "value"), ["station"]).first()
    assert (day.hrNday, day.dyN, day.dyMin, day.dyMax) == (3, 4, 1.0, 10.0)
    assert abs(day.dyMean - 16 / 3) < 1e-9
    assert (day.dDTmin, day.dDTmax) == (at(0, 0), at(3, 30))


def test_two_units_and_zones_are_series_of_their_own(spark):
    df = readings(spark, [("a", START, 1.0), ("a", START, 2.0)]).withColumn(
        "unit", F.when(F.col("value") == 1, "deg C").otherwise("mg/l")
    )
    keys = ["station", "unit"]
    assert daily(hourly(df, keys, "ts", "value"), keys).count() == 2


def test_clustered_days_equal_unclustered(spark):
    rows = [("a" if i % 3 else "b", START + dt.timedelta(minutes=37 * i), float(i % 17)) for i in range(900)]
    hours = hourly(readings(spark, rows), ["station"], "ts", "value")
    assert sorted(daily(hours, ["station"], cluster=["station"]).collect()) == sorted(daily(hours, ["station"]).collect())


def test_empty(spark):
    assert daily(hourly(readings(spark, []), ["station"], "ts", "value"), ["station"]).count() == 0


def test_dominating_station(spark):
    """A third of all rows in one series, even in one hour, is pre-aggregated and counted in full."""
    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 1000)).alias("station"),
        F.lit("2020-07-01 00:30:00").cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).cast("double").alias("value"),
    )
    hours = hourly(df, ["station"], "ts", "value")
    assert hours.filter("station = 'hot'").first().hrN == n // 3
    assert hours.agg(F.sum("hrN")).first()[0] == n
    plan = hours._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.index("partial_min") > plan.index("Exchange hashpartitioning")
