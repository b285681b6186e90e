"""Whole data flows on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riverstat import plans, schemas
from riverstat.operators import template

START = dt.datetime(2020, 7, 1)
HOURS = range(24)


def hours(days, hours_per_day=HOURS):
    return [START + dt.timedelta(days=d, hours=h) for d in range(days) for h in hours_per_day]


def readings(spark, *groups):
    """groups: (location, equipment, characteristic, value, unit, status, times)"""
    rows = [
        (loc, t.date(), t.strftime("%H:%M:%S"), "PST", equip, char, value(t) if callable(value) else value, unit, status)
        for loc, equip, char, value, unit, status, times in groups for t in times
    ]
    return spark.createDataFrame(rows, schemas.READINGS)


def stat(df, name, **where):
    rows = df.filter(F.col("StatisticalBasis") == name)
    for k, v in where.items():
        rows = rows.filter(F.col(k) == v)
    return [r.Result for r in rows.orderBy("ActStartDate").collect()]


def test_submission(spark):
    day_value = lambda t: float(t.day)
    df = readings(
        spark,
        ("L1", "E1", "Temperature, water", 64.4, "deg F", "Final", hours(8)),
        ("L1", "E1", "Temperature, water", 10.0, "deg C", "Final", hours(1, range(21))),
        ("L1", "E2", "Dissolved oxygen (DO)", day_value, "mg/l", "Final", hours(31)),
        ("L1", "E3", "Turbidity", 3.0, "NTU", "Final", hours(1, range(20))),
        ("L1", "E4", "pH", 7.5, "pH units", "Final", hours(1, range(2))),
        ("L1", "E4", "pH", 9.9, "pH units", "Rejected", [START + dt.timedelta(hours=5)]),
        ("L1", "E4", "pH", 9.9, "pH units", None, [START + dt.timedelta(hours=6)]),
        ("L1", "E5", "Salinity", 1.0, None, "Final", hours(1, range(3))),
    )
    project = spark.createDataFrame([("ALT",)], "p string")
    tables = plans.submission_stats(df, "Call", project)
    stats = tables["statistics"].cache()
    assert tuple(stats.columns) == template.SUBMISSION_COLUMNS
    assert stat(stats, "Daily Maximum", charID="Temperature, water") == [18.0] * 8
    assert stat(stats, "7DMADMax", charID="Temperature, water") == [18.0] * 2
    assert stat(stats, "7DMADMax", charID="Dissolved oxygen (DO)") == []
    assert stat(stats, "7DMADMean")[:2] == [4.0, 5.0] and len(stat(stats, "7DMADMin")) == 25
    assert len(stat(stats, "30DMADMean")) == 2
    turbidity = stats.filter("charID = 'Turbidity' and StatisticalBasis = 'Daily Mean'").first()
    assert (turbidity.ResultStatusID, turbidity.Result_Analytical_Method_ID, turbidity.alt_project) == (
        "Rejected", "180.1", "ALT"
    )
    assert turbidity.cmnt == "Generated by ORDEQ; Estimated - 20 hrs with valid data in day"
    week = stats.filter("StatisticalBasis = '7DMADMax'").orderBy("ActStartDate").first()
    assert (week.Result_Unit, week.RsltTimeBasis, week.AnaStartDate, week.AnaStartTime, week.ActEndDate,
            week.ActEndTime, week.ActStartTime) == (
        "deg C", "7 Day", "2020-07-01", "00:00:00", "2020-07-07", "23:00:00", "0:00"
    )
    assert stats.filter("charID = 'Salinity'").isEmpty()  # no unit, no value
    stats.unpersist()

    ph = tables["continuous_ph"].collect()
    assert [(r.Activity_start_date, r.Activity_Start_Time, r.Equipment_ID, r.Result_Value) for r in ph] == [
        ("2020/07/01", "00:00:00", "L1", 7.5), ("2020/07/01", "01:00:00", "L1", 7.5)
    ]
    before = {r.Equipment_ID: r.enddate for r in tables["deployments"].collect()}
    assert before["E4"] == START + dt.timedelta(hours=6, minutes=5)
    after = plans.submission_stats(df, "Call", "A", deployments_after_filter=True)["deployments"]
    assert {r.Equipment_ID: r.enddate for r in after.collect()}["E4"] == START + dt.timedelta(hours=1, minutes=5)
    assert plans.submission_stats(df, "Call", is_salem=True)["statistics"].first().alt_project == "CoSContinuousWQ"
    with pytest.raises(ValueError):
        plans.submission_stats(df, ["Call"])


def test_files_of_a_folder_are_separate_series(spark):
    one = readings(spark, ("L1", "E1", "Temperature, water", 10.0, "deg C", "Final", hours(4)))
    later = [t + dt.timedelta(days=4) for t in hours(4)]
    two = readings(spark, ("L1", "E1", "Temperature, water", 10.0, "deg C", "Final", later))
    folder = one.withColumn("source_file", F.lit("a")).union(two.withColumn("source_file", F.lit("b")))
    tables = plans.submission_stats(folder, "Call")
    assert stat(tables["statistics"], "7DMADMax") == []
    assert {r.source_file for r in tables["deployments"].collect()} == {"a", "b"}
    assert stat(plans.submission_stats(one.union(two), "Call")["statistics"], "7DMADMax") == [10.0] * 2


def test_multi_part_merges_units(spark):
    df = readings(
        spark,
        ("L1", "E1", "Temperature, water", 64.4, "deg F", "Final", hours(1, range(12))),
        ("L1", "E1", "Temperature, water", 20.0, "deg C", "Final", hours(1, range(12, 24))),
        ("L1", "E1", "pH", 7.0, None, "Final", hours(1, range(1))),
    )
    tables = plans.multi_part_submission_stats(df, "Call")
    assert stat(tables["statistics"], "Daily Maximum") == [20.0]
    assert stat(tables["statistics"], "Daily Mean") == [19.0]
    assert stat(plans.submission_stats(df, "Call")["statistics"], "Daily Mean") == []
    assert tables["continuous_ph"].first().Result_Value == 7.0


def test_submission_distribution(spark):
    df = readings(spark, ("L1", "E1", "pH", lambda t: float(t.hour), "pH units", "Final", hours(1)))
    row = plans.submission_distribution(df).first()
    assert (row.minimum, row.median, row.maximum, row.n) == (0.0, 11.5, 23.0, 24)


def test_empty_submission(spark):
    tables = plans.submission_stats(spark.createDataFrame([], schemas.READINGS), "Call")
    assert all(t.isEmpty() for t in tables.values())


def logger_rows(spark, code, source, times, flag="<0>"):
    rows = [(source, code, t, 9.0, flag, 95.0, "<-3> [x]", 8.0, "<4>", 7.5, flag) for t in times]
    return spark.createDataFrame(
        rows, "source_file string, StationCode string, DateTimeStamp timestamp_ntz, Temp double, F_Temp string,"
        " DO_Pct double, F_DO_Pct string, DO_mgl double, F_DO_mgl string, pH double, F_pH string")


def test_logger_folder(spark):
    wide = logger_rows(spark, "so schwq", "a", hours(8)).union(logger_rows(spark, "other", "b", hours(1), "<1> [s]"))
    tables = plans.logger_folder_stats(wide)
    stats = tables["statistics"]
    assert tuple(stats.columns) == ("source_file", *template.LOGGER_COLUMNS)
    assert len(stat(stats, "7DMADMax", charID="Temperature, water")) == 2
    assert len(stat(stats, "7DMADMean", charID="Dissolved oxygen (DO)")) == 2
    assert stats.filter("charID = 'Dissolved oxygen saturation'").isEmpty()
    ph = tables["continuous_ph"]
    assert {(r.Monitoring_Location_ID, r.Equipment_ID) for r in ph.collect()} == {("soschwq", "soschwq_010116-123119")}
    assert [(r.startdate, r.enddate, r.TZ) for r in tables["deployments"].collect()] == [(START, "", "PST")]


def test_logger_folder_without_oxygen_or_temperature(spark):
    wide = logger_rows(spark, "x", "a", hours(8)).withColumn("F_Temp", F.lit("<1>"))
    assert {r.charID for r in plans.logger_folder_stats(wide)["statistics"].collect()} == {"Dissolved oxygen (DO)"}


def daily_tables(spark):
    days = [START.date() + dt.timedelta(days=d) for d in range(35)]
    temperature = spark.createDataFrame(
        [("AG", s, d, 20.0, "P Eqp" if i == 0 else "A", 15.0, None, None, "A") for s in ("01", "gw")
         for i, d in enumerate(days)], schemas.daily_value_schema(("Wtemp_Max", "Wtemp", "Wtemp_Min")))
    oxygen = spark.createDataFrame(
        [("AG", "02", d, 9.0, "A", 8.0, "A", None if i == 20 else 7.0, "P e" if i == 34 else "A")
         for i, d in enumerate(days)], schemas.daily_value_schema(("DO_Max", "DO", "DO_Min")))
    ph = spark.createDataFrame(
        [("03", START, "PDT", 7.1, "A"), ("03", START + dt.timedelta(days=1), "PST", 7.2, "P"),
         ("03", START - dt.timedelta(hours=1), "PST", 7.3, "A")], schemas.INSTANT_PH)
    sites = spark.createDataFrame(
        [(s, f"n{s}", kind, "001", "17", "NAD83", "aq", 44.5, -123.0, None, 12.0)
         for s, kind in (("01", "ST"), ("02", None), ("03", "LK"), ("gw", "GW"), ("unused", "ST"))], schemas.SITES)
    counties = spark.createDataFrame([("001", "Benton")], schemas.COUNTIES)
    return temperature, oxygen, ph, sites, counties


def test_daily_values(spark):
    existing = spark.createDataFrame(
        [("O", "01", "Temperature, water", START.date() + dt.timedelta(days=1), "00:00:00", "THM01", None, "Maximum",
          20.0, 20.0, "deg C", "u1", "a", None),
         ("O", "01", "Temperature, water", START.date() + dt.timedelta(days=2), "00:00:00", "THM01", None, "Maximum",
          19.0, 19.0, "deg C", "u2", "a", None)], schemas.EXISTING_RESULTS)
    tables = plans.daily_value_stats(*daily_tables(spark), "Call", existing)
    stats = tables["sumstats"].cache()
    assert tuple(stats.columns) == template.DAILY_VALUE_COLUMNS
    assert {r.SiteID for r in stats.collect()} == {"01", "02"}
    assert len(stat(stats, "Daily Maximum", SiteID="01")) == 34  # the first day's qualifier is dropped
    assert stat(stats, "Daily Mean", SiteID="01") == []  # no qualifier
    assert len(stat(stats, "7DMADMax")) == 29
    assert len(stat(stats, "7DMADMean")) == 29
    assert len(stat(stats, "7DMADMin")) == 29 - 7 - 1  # the missing day's frames, the last qualifier
    assert len(stat(stats, "30DMADMean")) == 6
    row = stats.filter("StatisticalBasis = '7DMADMax'").orderBy("ActStartDate").first()
    assert (row.AnaStartDate, row.AnaEndDate, row.AnaStartTime, row.DEQ_RsltComment, row.ActivityID, row.Qualcd) == (
        "2020-07-01", "2020-07-07", "00:00:00", "Generated by ORDEQ", "01:20200707:FMC", "A"
    )
    assert stats.filter("RsltTimeBasis = '1 Day'").first().DEQ_RsltComment == ""
    assert tables["non_duplicates"].count() == stats.count() - 2
    assert [r.stored_uid for r in tables["suspected_dups"].collect()] == ["u1"]
    assert [(r.stored_uid, r.stored_result) for r in tables["suspected_updates"].collect()] == [("u2", 19.0)]
    stats.unpersist()
    assert [r.Result_Value for r in tables["pH_continuous"].orderBy("Result_Value").collect()] == [7.1, 7.3]
    deployed = tables["pH_deployments"].first()
    assert (deployed.Equipment_ID, deployed.Activity_start_date_time, deployed.Activity_end_date_time,
            deployed.Activity_start_end_time_Zone) == ("03", "2020/06/30", "", "PST")
    sites = {r.Stationkey: r for r in tables["monitoring_locations"].collect()}
    assert set(sites) == {"01", "02", "03"}
    assert (sites["01"].MonLocType, sites["02"].MonLocType, sites["01"].COUNTY, sites["01"].WellDepth) == (
        "River/Stream", "ERROR", "Benton", ""
    )
    assert (sites["01"].Lat, sites["01"].Long) == ("44.5", "-123")
    assert sites["01"].MapScale == "" and len(tables["monitoring_locations"].columns) == 31


def portal(spark, *groups):
    rows = [(station, t, None, char, "u", 9.0, 1.0, grade, 1200.0, "c") for station, char, grade, times in groups
            for t in times]
    return spark.createDataFrame(
        rows, "Monitoring_Location_ID string, datetime timestamp_ntz, Event_Timestamp string, Characteristic_Name string,"
        " Result_Unit string, Result_Value double, Interpolation_Type double, Grade_Code double, Approval_Level double,"
        " Comment string")


def test_portal(spark):
    readings_ = portal(
        spark,
        ("A", "Temperature.Primary", 100.0, hours(8)),
        ("B", "Temperature.Primary", 100.0, hours(8)),
        ("B", "Temperature.7DADM", 100.0, [START + dt.timedelta(days=6)]),
        ("B", "Dissolved oxygen.Primary", 100.0, hours(8)),
        ("B", "pH.Primary", 100.0, hours(1, range(2))),
        ("C", "Temperature.Primary", 50.0, hours(8)),
    )
    inventory = readings_.select(F.col("Monitoring_Location_ID").alias("station"),
                                 F.col("Characteristic_Name").alias("char")).distinct()
    crosswalk = spark.createDataFrame([("A", "MA"), ("B", "MB"), ("C", "MC")], schemas.STATION_CROSSWALK)
    tables = plans.portal_stats(readings_, inventory, crosswalk, "Call")
    stats = tables["sumstats"]
    assert tuple(stats.columns) == template.PORTAL_COLUMNS
    week = stats.filter("StatisticalBasis = '7DMADMax'")
    assert week.filter("Monitoring_Location_ID = 'MA'").count() == 2
    ready = week.filter("Monitoring_Location_ID = 'MB'").collect()
    assert [(r.ActStartDate, r.AnaStartDate, r.RsltTimeBasis, r.ResultStatusID) for r in ready] == [
        ("2020-07-07", "2020-07-01", "7 day", "100")
    ]
    assert len(stat(stats, "7DMADMean", Monitoring_Location_ID="MB")) == 2
    assert stats.filter("Monitoring_Location_ID = 'MC'").isEmpty()
    extents = {r.Monitoring_Location_ID: r for r in tables["deployments"].collect()}
    assert set(extents) == {"MA", "MB"}
    assert extents["MA"].Equipment_ID == "MA-202007-202007"
    assert extents["MA"].Activity_end_date_time == START + dt.timedelta(days=7, hours=23, seconds=1)
    ph = tables["pH_continuous"].collect()
    assert {(r.Monitoring_Location_ID, r.Equipment_ID, r.Result_Status_ID) for r in ph} == {
        ("MB", "MB-202007-202007", 100)
    }
    assert tables["pH_deployments"].first().Activity_start_end_time_Zone == "UTC"


def test_portal_without_usable_readings(spark):
    bad = portal(spark, ("A", "pH.Primary", 50.0, hours(1)))
    inventory = spark.createDataFrame([("A", "pH.Primary")], "station string, char string")
    crosswalk = spark.createDataFrame([], schemas.STATION_CROSSWALK)
    assert all(t.isEmpty() for t in plans.portal_stats(bad, inventory, crosswalk, "Call").values())


def test_json_portal(spark):
    def points(station, parameter, times, grade=100, level=900, label=None):
        label = label or ("7DADM" if parameter == "Temperature" else "Primary")
        return [(station, parameter, label, "u", t.strftime("%Y-%m-%dT%H:%M:%S-07:00"), 9.0, grade, level, "c") for t in times]

    rows = [
        *points("FC-8", "Dissolved oxygen", hours(8)),
        *points("JC1", "Temperature", [START, START - dt.timedelta(days=30), START - dt.timedelta(days=31)]),
        *points("JC1", "Temperature", hours(1), label="Primary"),
        *points("FC-8", "Dissolved oxygen", hours(20), label="Daily mean"),
        *points("TC-4", "pH", hours(1, range(2)), level=1200),
        *points("TC-4", "pH", hours(1, range(3, 5)), level=950),
        *points("TC-4", "pH", hours(1, range(3, 5)), grade=50),
    ]
    df = spark.createDataFrame(
        rows, "locationIdentifier string, parameter string, label string, unit string, timestamp string, value double, gradeCode int,"
        " approvalLevel int, comment string")
    tables = plans.portal_json_stats(df, "2020-07-01", "2020-07-31")
    stats = tables["sum_stats"]
    assert {r.Monitoring_Location_ID for r in stats.collect()} == {"PDX_BES-FC8", "PDX_BES-JC-1"}
    oxygen = stats.filter("charID = 'Dissolved oxygen (DO)'")
    assert {n: len(stat(oxygen, n)) for n in ("7DMADMax", "7DMADMean", "7DMADMin", "30DMADMean")} == {
        "7DMADMax": 2, "7DMADMean": 2, "7DMADMin": 2, "30DMADMean": 0
    }
    supplied = stats.filter("charID = 'Temperature, water'").orderBy("ActStartDate").collect()
    assert [(r.ActStartDate, r.ResultStatusID, r.ActivityID) for r in supplied] == [
        (dt.date(2020, 6, 1), "900", "PDX_BES-JC-1:20200601:FMC"), (dt.date(2020, 7, 1), "900", "PDX_BES-JC-1:20200701:FMC")
    ]
    assert [r.Activity_Start_Time for r in tables["pH_raw"].collect()] == ["00:00:00", "01:00:00"]
    assert tables["pH_deployments"].first().Activity_end_date_time == START + dt.timedelta(hours=1, seconds=1)
    nothing = plans.portal_json_stats(df.limit(0), "2020-07-01", "2020-07-31")
    assert all(t.isEmpty() for t in nothing.values())


def test_daily_max(spark):
    rows = [("S", (START + dt.timedelta(days=d)).strftime("%m-%d-%Y"), None if d == 9 else 18.25, "PUB")
            for d in range(12)] + [("S", "7/20/2020", 30.0, "PRO")]
    df = spark.createDataFrame(rows, "station_nbr string, record_date string, Result_Value double, published_status string")
    from riverstat.plans.daily_max import published

    stats = plans.daily_max_temperature(published(df), "Call")
    assert tuple(stats.columns) == template.DAILY_VALUE_COLUMNS
    assert stat(stats, "Daily Maximum") == [18.2] * 11
    assert stat(stats, "7DMADMax") == [18.2] * 3  # the frames of days 6 to 8; later ones hold the missing value
    row = stats.first()
    assert (row.Qualcd, row.ActStartTimeZone, row.Method, row.Project) == ("Final", "PST", "T-170.1", "Call")


def test_a_submission_moves_twice_up_to_its_moving_means(spark):
    """Once by hour and once by series, also where zone and unit are literals."""
    df = readings(spark, ("L1", "E1", "pH", lambda t: float(t.hour), "pH units", "Final", hours(1)))
    stats = plans.submission_stats(df.withColumn("Activity_Time_Zone", F.lit("PST")), "Call")["statistics"]
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
