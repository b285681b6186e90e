import datetime as dt
import math
import random

from pyspark.sql import functions as F

from riverstat.operators.moving import MEAN_30, MovingMean, day_cells, moving
from riverstat.operators.rollup import daily, hourly

DAY = dt.date(2020, 7, 1)
MAX = MovingMean("ma_max7", "dyMax", 7)


def series(spark, days, values=None, station="a"):
    values = values or [float(i) for i, _ in enumerate(days)]
    rows = [(station, DAY + dt.timedelta(days=d), v) for d, v in zip(days, values, strict=True)]
    return spark.createDataFrame(rows, "station string, date date, dyMax double")


def result(df, column="ma_max7"):
    return [r[column] for r in df.orderBy("date").collect()]


def test_warm_up_counts_rows(spark):
    got = result(moving(series(spark, range(9)), ["station"], "date", [MAX]))
    assert got[:6] == [None] * 6
    assert got[6:] == [3.0, 4.0, 5.0]


def test_six_rows_are_enough_and_five_are_not(spark):
    # day 8 is missing: its frame has 6 rows; days 12 and 13 are missing too: 5 rows and fewer
    days = [0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 14]
    rows = {r.date: r.ma_max7 for r in moving(series(spark, days), ["station"], "date", [MAX]).collect()}
    assert rows[DAY + dt.timedelta(days=9)] is not None
    assert rows[DAY + dt.timedelta(days=14)] is None


def test_gap_longer_than_the_window(spark):
    days = [*range(8), *range(20, 27)]
    got = result(moving(series(spark, days), ["station"], "date", [MAX]))
    # after the gap the series is past its warm-up: the sixth day of the new run has its 6 rows
    assert got[8:13] == [None] * 5
    assert got[13] is not None


def test_thirty_days(spark):
    stat = [MovingMean("ma_mean30", "dyMax", 30)]
    got = result(moving(series(spark, range(31)), ["station"], "date", stat), "ma_mean30")
    assert got[28] is None and got[29] == 14.5 and got[30] == 15.5
    # 29 rows inside the frame and 30 in the series are enough
    days = [*range(15), *range(16, 32)]
    got = result(moving(series(spark, days), ["station"], "date", stat), "ma_mean30")
    assert got[28] is None and got[29] is not None


def test_null_poison(spark):
    values = [1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0]
    plain = result(moving(series(spark, range(10), values), ["station"], "date", [MAX]))
    poisoned = result(moving(series(spark, range(10), values), ["station"], "date", [MAX], null_poison=True))
    assert plain[6] is not None
    assert poisoned[6:9] == [None] * 3 and poisoned[9] == 7.0


def test_bounds(spark):
    df = series(spark, [0, 1, 2, 5, 6, 7, 8]).withColumns({"first": F.col("date"), "last": F.col("date")})
    row = moving(df, ["station"], "date", [MAX], bounds=("first", "last")).orderBy(F.desc("date")).first()
    assert row.ana_startdate7 == DAY + dt.timedelta(days=2)
    assert row.ana_enddate7 == DAY + dt.timedelta(days=8)


def test_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for station in "abc":
        for d in sorted(rng.sample(range(120), 90)):
            rows.append((station, DAY + dt.timedelta(days=d), float(rng.randrange(100))))
    df = spark.createDataFrame(rows, "station string, date date, dyMax double")
    stats = [MAX, MovingMean("ma30", "dyMax", 30)]
    got = {(r.station, r.date): (r.ma_max7, r.ma30) for r in moving(df, ["station"], "date", stats).collect()}
    for station, day, _ in rows:
        own = sorted((d, v) for s, d, v in rows if s == station)
        expected = []
        for length in (7, 30):
            frame = [v for d, v in own if day - dt.timedelta(days=length - 1) <= d <= day]
            number = sum(d <= day for d, _ in own)
            enough = len(frame) >= length - 1 and number >= length
            expected.append(sum(frame) / len(frame) if enough else None)
        assert all(
            (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)
            for a, b in zip(got[station, day], expected, strict=True)
        )


def test_two_shuffles_from_readings_to_moving_means(spark):
    df = spark.createDataFrame([("a", dt.datetime(2020, 7, 1), 1.0)], "station string, ts timestamp_ntz, value double")
    days = daily(hourly(df, ["station"], "ts", "value"), ["station"], cluster=["station"])
    plan = moving(days, ["station"], "date", [MAX, MEAN_30])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2
    assert plan.count("+- Window") == 1
    assert "UNBOUNDED" in plan.upper()


def test_a_huge_value_harms_only_its_own_frames(spark):
    values = [1.1, 2.2, 3.3, 1e300, 5.5, 6.6, 7.7, 8.8, 9.9, 0.1, 0.2, 0.3, 0.4]
    got = result(moving(series(spark, range(13), values), ["station"], "date", [MAX]))
    assert got[6] == 1e300 / 7 and got[9] == 1e300 / 7
    assert got[10:] == [math.fsum(values[i - 6:i + 1]) / 7 for i in (10, 11, 12)]


def test_a_filter_on_means_keeps_the_plan_small(spark):
    df = series(spark, range(40)).withColumns({"dyMean": F.lit(1.0), "dyMin": F.lit(2.0)})
    moved = moving(moving(df, ["station"], "date", [MAX]).drop("row"), ["station"], "date", [MEAN_30, MovingMean("of", "ma_max7", 7)])
    assert moved.filter("ma_mean30 = 1.0 AND of > 0").count() == 11


def test_repeated_days_count_once(spark):
    once = series(spark, range(9))
    twice = once.union(once)
    cells = day_cells(twice, ["station"], "date", ["dyMax"])
    assert result(moving(cells, ["station"], "date", [MAX])) == result(moving(once, ["station"], "date", [MAX]))
    mixed = day_cells(series(spark, [0, 0, 1, 1], [1.0, 3.0, 5.0, None]), ["station"], "date", ["dyMax"])
    assert result(mixed, "dyMax") == [2.0, None]


def test_dominating_station_is_reduced_to_its_days(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("station"),
        F.date_add(F.lit(DAY), (F.col("id") % 40).cast("int")).alias("date"), F.lit(1.0).alias("dyMax"),
    )
    cells = day_cells(df, ["station"], "date", ["dyMax"])
    assert cells.groupBy("station").count().agg(F.max("count")).first()[0] <= 40
    hot = moving(cells, ["station"], "date", [MAX]).filter("station = 'hot'")
    assert hot.filter("ma_max7 = 1.0").count() == 34
