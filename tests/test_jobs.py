"""From landed files to written folders."""

import datetime as dt
import json
import os

from test_files import HEADER, LOGGER, put

from riverstat import jobs, plans, schemas, sinks
from riverstat.operators.reshape import with_missing
from riverstat.sources import requests


def read(spark, path):
    return spark.read.csv(str(path), header=True)


def hourly_lines(days, make):
    return "".join(make(f"2020-07-{d + 1:02d}", f"{h:02d}:00:00") for d in range(days) for h in range(24))


def test_submission_folder(spark, tmp_path):
    for name in ("one", "two"):
        put(tmp_path, f"in/{name}.csv", HEADER + hourly_lines(
            7, lambda d, t: f'L1,{d},{t},PST,E1,"Temperature, water",64.4,deg F,Final\n'))
        put(tmp_path, f"projects/{name}-project.csv", f"Project ID\nALT-{name}\n")
    out = tmp_path / "out"
    jobs.submission_files(spark, str(tmp_path / "in"), "Call", str(out), str(tmp_path / "projects"))
    stats = read(spark, out / "statistics")
    assert stats.filter("StatisticalBasis = '7DMADMax'").count() == 2
    assert {(r.source_file, r.alt_project, r.Result) for r in stats.filter("StatisticalBasis = '7DMADMax'").collect()} == {
        ("one", "ALT-one", "18.0"), ("two", "ALT-two", "18.0")
    }
    assert read(spark, out / "deployments").count() == 2
    assert read(spark, out / "distribution").first().median == "18.0"


def test_multi_part(spark, tmp_path):
    head = "Loc,Date,Time,Zone,Char,Equip,Value,Unit,Status,OBJECTID,TEMP_GUID,SAMPLE_GUID,BLM_ORG_CD\n"
    put(tmp_path, "in/Results1.csv", head + hourly_lines(1, lambda d, t: f"L1,{d},{t[:5]},PST,pH,E1,7,pH units,Final,,,,\n"))
    project = put(tmp_path, "Projects.csv", "p\nALT\n")
    jobs.multi_part_files(spark, str(tmp_path / "in"), "Call", str(tmp_path / "out"), project)
    assert {r.alt_project for r in read(spark, tmp_path / "out" / "statistics").collect()} == {"ALT"}
    assert read(spark, tmp_path / "out" / "continuous_ph").count() == 24


def test_logger_files(spark, tmp_path):
    rows = "".join(f"x,soschwq,7/{d}/2020 {h}:00,9,<0>,90,<0>,8,<0>,7,<0>\n" for d in range(1, 8) for h in range(24))
    put(tmp_path, "in/soschwq2020.csv", LOGGER + rows)
    jobs.logger_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out" / "statistics")
    assert read(spark, tmp_path / "out" / "continuous_ph").count() == 7 * 24
    assert read(spark, tmp_path / "out" / "deployments").count() == 1


def test_daily_value_files(spark, tmp_path):
    lines = "".join(f"AG,01,2020-07-{d:02d},18.5,A,17,A\n" for d in range(1, 9))
    head = "agency_cd,site_no,Date,X_{0}_00001,X_{0}_00001_cd,X_{0}_00003,X_{0}_00003_cd\n"
    temperature = put(tmp_path, "t.csv", head.format("00010") + lines)
    oxygen = put(tmp_path, "o.csv", head.format("00300") + lines)
    ph = put(tmp_path, "p.csv", "s,d,t,p,c\n01,2020-07-01 00:15:00,PST,7.1,A\n")
    sites = put(tmp_path, "s.csv", ",".join(schemas.SITES.names) + "\n01,River,ST,001,17,NAD83,,44.5,-123.0,,\n")
    counties = put(tmp_path, "c.csv", "county_cd,county_nm\n001,Benton\n")
    out = tmp_path / "out"
    jobs.daily_value_files(spark, temperature, oxygen, ph, sites, counties, "Call", str(out), fmt="csv")
    stats = read(spark, out / "sumstats")
    assert stats.filter("StatisticalBasis = '7DMADMax'").count() == 2
    assert {r.file_no for r in stats.collect()} == {1} or {r.file_no for r in stats.collect()} == {"1"}
    assert read(spark, out / "monitoring_locations").first().COUNTY == "Benton"
    assert read(spark, out / "pH_continuous").count() == 1


def test_portal_files(spark, tmp_path):
    body = "Temperature.Primary@FC-8\nTimestamp,Value,Grade,Approval,Interpolation,Event,Comment\n"
    body += hourly_lines(7, lambda d, t: f"{d}T{t},9.5,100,1200,1,,ok\n")
    put(tmp_path, "in/req1.csv", body)
    asked = spark.createDataFrame([("req1", "FC-8", "Temperature.Primary", "degC")],
                                  "file_name string, station string, char string, unit string")
    inventory = asked.select("station", "char")
    crosswalk = spark.createDataFrame([("FC-8", "M1")], schemas.STATION_CROSSWALK)
    jobs.portal_files(spark, str(tmp_path / "in"), asked, inventory, crosswalk, "Call", str(tmp_path / "out"))
    stats = read(spark, tmp_path / "out" / "sumstats")
    assert stats.filter("StatisticalBasis = '7DMADMax'").first().Monitoring_Location_ID == "M1"
    assert not (tmp_path / "out" / "pH_deployments").exists()


def test_from_requests_to_portal_files(spark, tmp_path):
    """What is landed under the requests' names is read, and only what the inventory asks for is used."""
    stations = spark.createDataFrame([("FC-8",), ("VNB",)], "station string")
    asked = requests.portal_requests(stations, "station", "2020-07-01", "2020-07-31", ["pH.Field Visits", "pH.Primary"], "u?")
    names = [r.file_name for r in asked.collect()]
    assert names[0] == "FC-8_pH.Field_Visits" and len(set(names)) == 4
    head = "banner\nTimestamp,Value,Grade,Approval,Interpolation,Event,Comment\n"
    for name in names:
        put(tmp_path, f"in/{name}.csv", head + "2020-07-01T10:00:00,7.5,100,1200,1,,\n2020-07-09T10:00:00,7.9,100,1200,1,,\n")
    inventory = spark.createDataFrame(
        [("FC-8", "pH.Primary", "2020-07-01", "2020-07-03"), ("FC-8", "pH.Primary", "2020-07-02", "2020-07-05"),
         ("FC-8", "pH.Primary", None, "2020-08-01"), ("VNB", "pH.Primary", "2021-01-01", "2021-02-01")],
        "station string, char string, startdate string, enddate string")
    crosswalk = spark.createDataFrame([("FC-8", "M1"), ("VNB", "M2")], schemas.STATION_CROSSWALK)
    jobs.portal_files(spark, str(tmp_path / "in"), asked, inventory, crosswalk, "Call", str(tmp_path / "out"))
    ph = read(spark, tmp_path / "out" / "pH_continuous").collect()
    assert [(r.Monitoring_Location_ID, float(r.Result_Value)) for r in ph] == [("M1", 7.5)]


def test_portal_json_files(spark, tmp_path):
    points = [{"timestamp": "2024-01-01T00:00:00-08:00", "value": 7.5, "gradeCode": 100, "approvalLevel": 900}]
    data_set = {"locationIdentifier": "FC-8", "parameter": "pH", "unit": "pH", "label": "Primary", "identifier": "pH@1"}
    raw = {"locationIdentifier": "FC-8", "parameter": "Temperature", "unit": "degC", "label": "Primary", "identifier": "T@1"}
    put(tmp_path, "in/b.json", json.dumps({"numPoints": [1], "points": points, "dataset": raw}))
    put(tmp_path, "in/c.json", json.dumps({"numPoints": [1], "points": points, "dataset": {**data_set, "locationIdentifier": "X", "identifier": "pH@2"}}))
    listed = {"properties": {"dataSetLabel": "Primary", "dataSetIdentifier": "pH@1"}}
    catalogue = put(tmp_path, "catalogue.json", json.dumps({"features": [listed]}))
    put(tmp_path, "in/a.json", json.dumps({"numPoints": [1], "points": points, "dataset": data_set}))
    jobs.portal_json_files(spark, str(tmp_path / "in"), "2024-01-01", "2024-02-01", str(tmp_path / "out"), catalogue)
    assert [r.Monitoring_Location_ID for r in read(spark, tmp_path / "out" / "pH_raw").collect()] == ["PDX_BES-FC8"]
    assert sorted(os.listdir(tmp_path / "out")) == ["pH_deployments", "pH_raw"]


def test_hydrology_files(spark, tmp_path):
    rows = "".join(f"14335500\t07-{d:02d}-2020\t18.5\t{'PUB' if d < 9 else 'PRO'}\n" for d in range(1, 12))
    path = put(tmp_path, "max.txt", "station_nbr\trecord_date\tdaily_max_water_temp_C\tpublished_status\n" + rows)
    flow = put(tmp_path, "flow.txt", "station_nbr\trecord_date\tmean_daily_flow_cfs\tpublished_status\n" + rows.replace("18.5", "500"))
    jobs.hydrology_files(spark, {"WTEMP_MAX": path, "MDF": flow}, "Call", str(tmp_path / "out"))
    stats = read(spark, tmp_path / "out" / "sumstats")
    assert (stats.count(), stats.filter("StatisticalBasis = '7DMADMax'").count()) == (10, 2)
    assert {float(r.Result) for r in stats.collect()} == {18.5}


def test_instrument_fix(spark, tmp_path):
    put(tmp_path, "in/a-cont_pH.csv", "Monitoring_Location_ID,Equipment_ID,Result_Value\nL1,E9,7\n")
    put(tmp_path, "in/other.csv", "Monitoring_Location_ID,Equipment_ID,Result_Value\nL2,E9,7\n")
    jobs.name_instruments_after_locations(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    rows = read(spark, tmp_path / "out").collect()
    assert [(r.source_file, r.Equipment_ID) for r in rows] == [("a-cont_pH", "L1")]


def test_without_stored(spark, tmp_path):
    import datetime as dt

    new = spark.createDataFrame(
        [("T", 1.0, "C", "Daily Mean", "A", dt.date(2020, 7, 1), "x"), ("T", 2.0, "C", "Daily Mean", "A", dt.date(2020, 7, 2), "y")],
        "CharID string, Result double, Unit string, StatisticalBasis string, SiteID string, ActStartDate date, ActivityID string")
    existing = spark.createDataFrame(
        [("O", "A", "x", dt.date(2020, 7, 1), "T", 1.0, "C", "Mean")],
        "OrganizationID string, MLocID string, act_id string, SampleStartDate date, Char_Name string,"
        " Result_Numeric double, Result_Unit string, Statistical_Base string")
    jobs.without_stored(spark, new, existing, "O", "2020-01-01", "2024-12-31", str(tmp_path / "out"))
    assert [r.ActivityID for r in read(spark, tmp_path / "out").collect()] == ["y"]


def test_new_deployment_files(spark, tmp_path):
    deployed = spark.createDataFrame([("A", "E1"), ("B", "E2")], "Monitoring_Location_ID string, Equipment_ID string")
    known = spark.createDataFrame([("O", "A"), ("P", "B")], "OrganizationID string, MLocID string")
    jobs.new_deployment_files(spark, deployed, known, str(tmp_path / "out"), "O")
    assert [(r.Monitoring_Location_ID, r.Equipment_ID) for r in read(spark, tmp_path / "out").collect()] == [("B", "B")]


def test_air_files(spark, tmp_path):
    paths = [put(tmp_path, f"{s}.json", json.dumps([{"STATION": s, "DATE": "2020-07-01", "TMAX": t}])) for s, t in (("A", "80"), ("B", ""))]
    jobs.air_files(spark, paths, str(tmp_path / "out"))
    assert sorted((r.STATION, r.DATE, r.TMAX) for r in read(spark, tmp_path / "out").collect()) == [
        ("A", "2020-07-01", "80.0"), ("B", "2020-07-01", None)
    ]

def test_daily_values_with_a_store_are_computed_once(spark, tmp_path):
    """All tables of the flow are written, and the source's rows pass twice: as they are, and into the moving means."""
    sites = spark.createDataFrame([("01", "River", "ST", "001")], "site_no string, station_nm string, site_tp_cd string, county_cd string")
    sites = with_missing(sites, {f.name: f.dataType.simpleString() for f in schemas.SITES}).select(*schemas.SITES.names)
    columns = schemas.daily_value_schema(("Wtemp_Max", "Wtemp", "Wtemp_Min"))
    days = spark.createDataFrame(
        [("AG", "01", dt.date(2020, 7, d), 18.0 + d, "A", 17.0, "A", None, None) for d in range(1, 11)], columns
    )
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    oxygen = spark.createDataFrame([], schemas.daily_value_schema(("DO_Max", "DO", "DO_Min")))
    ph = spark.createDataFrame([("01", dt.datetime(2020, 7, 1, 0, 15), "PST", 7.1, "A")], schemas.INSTANT_PH)
    counties = spark.createDataFrame([("001", "Benton")], schemas.COUNTIES)
    plain = plans.daily_value_stats(days, oxygen, ph, sites, counties, "Call")["sumstats"]
    daily = [r for r in plain.collect() if r.StatisticalBasis == "Daily Maximum"]
    stored = [
        ("OR", r.SiteID, r.CharID, r.ActStartDate, r.ActStartTime, r.Method, None, "Maximum",
         float(r.Result) + (i == 1), float(r.Result), "deg C", f"u{i}", "a", None)
        for i, r in enumerate(sorted(daily, key=lambda r: r.ActStartDate)[:2])
    ]
    existing = spark.createDataFrame(stored, schemas.EXISTING_RESULTS)
    tables = plans.daily_value_stats(
        days.mapInPandas(count, days.schema), oxygen, ph, sites, counties, "Call", existing, sinks.hold
    )
    names = sinks.write_tables(tables, str(tmp_path / "out"))
    assert passed.value == 2 * 10
    assert set(names) == set(tables)
    assert {n: tables[n].count() for n in ("suspected_dups", "suspected_updates", "stored_matches")} == {
        "suspected_dups": 1, "suspected_updates": 1, "stored_matches": 2}
    assert tables["non_duplicates"].count() == plain.count() - 2
