"""Readers of landed files, and sinks."""

import datetime as dt
import json
import os

import duckdb
import pytest
from compare import differences
from pyspark.sql import functions as F

from catalog import ORACLES, QUERIES
from riverstat import plans, sinks, schemas
from riverstat.sources import files, loggers, requests, services, submissions


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


HEADER = "a,b,c,d,e,f,g,h,i\n"


def test_folder_of_submissions(spark, tmp_path):
    put(tmp_path, "one.csv", HEADER + "L1,2020-07-01,13:30:00,PST,E1,pH,7.5,pH units,Final\n")
    put(tmp_path, "two.x.csv", HEADER + "L2,2020-07-02,0:05,PST,E2,pH,,pH units,\n")
    put(tmp_path, "notes.txt", "x\n")
    df = submissions.read_readings(spark, str(tmp_path))
    assert df.columns == [*schemas.READINGS.names, "source_file"]
    rows = {r.source_file: r for r in df.collect()}
    assert set(rows) == {"one", "two.x"}
    assert rows["one"].Result_Value == 7.5 and rows["one"].Activity_Start_Date == dt.date(2020, 7, 1)
    assert rows["two.x"].Result_Value is None and rows["two.x"].Result_Status_ID is None


def test_project(spark, tmp_path):
    path = put(tmp_path, "projects.csv", "Project ID,Name\nALT-1,x\n")
    assert submissions.read_project(spark, path).first().alt_project == "ALT-1"
    assert submissions.read_project(spark, path, is_salem=True).first().alt_project == "CoSContinuousWQ"


def test_multi_part(spark, tmp_path):
    head = "OBJECTID,TEMP_GUID,Loc,Date,Time,Zone,Char,Equip,Value,Unit,Status,SAMPLE_GUID,BLM_ORG_CD\n"
    put(tmp_path, "Results1.csv", head + '1,g,L1,2020-07-01,0:05,PST,"Temperature,water",E1,50,deg F,Final,s,b\n')
    put(tmp_path, "More Results.csv", head + "2,g,L1,2020-07-01,0:20,PST,pH,E1,7,pH units,Final,s,b\n")
    put(tmp_path, "Projects.csv", "x\ny\n")
    rows = submissions.read_multi_part(spark, str(tmp_path)).collect()
    assert {(r.Characteristic_Name, r.Equipment_ID, r.Result_Value) for r in rows} == {
        ("Temperature, water", "E1", 50.0), ("pH", "E1", 7.0)
    }


LOGGER = ("Station,StationCode,DateTimeStamp,Temp,F_Temp,DO_Pct,F_DO_Pct,DO_mgl,F_DO_mgl,pH,F_pH\n")


def test_logger_folder(spark, tmp_path):
    put(tmp_path, "soswq2020.csv", LOGGER + "x,sos wq,1/2/2020 0:15,9.5,<0>,,<-2>,8.1,<1> [x],7.9,<4>\n")
    put(tmp_path, "sosmet2020.csv", LOGGER + "x,met,1/2/2020 0:15,9.5,<0>,,<-2>,8.1,<1>,7.9,<4>\n")
    row = loggers.read_logger_folder(spark, str(tmp_path)).collect()
    assert len(row) == 1
    assert (row[0].StationCode, row[0].DateTimeStamp, row[0].Temp, row[0].DO_Pct, row[0].source_file) == (
        "sos wq", dt.datetime(2020, 1, 2, 0, 15), 9.5, None, "soswq2020"
    )


def test_logger_folder_without_files(spark, tmp_path):
    put(tmp_path, "met.csv", "a,b\n1,2\n")
    with pytest.raises(FileNotFoundError):
        loggers.read_logger_folder(spark, str(tmp_path))


def test_portal_exports(spark, tmp_path):
    body = ("Temperature.Primary@FC-8\nTimestamp,Value,Grade,Approval,Interpolation,Event,Comment\n"
            "2019-04-01T00:15:00,9.5,100,1200,1,,ok\n2019-04-01T00:30:00,,50,900,1,,\n")
    put(tmp_path, "req1.csv", body)
    put(tmp_path, "req2.csv", body)
    asked = spark.createDataFrame(
        [("req1", "FC-8", "Temperature.Primary", "degC"), ("req2", "VNB", "Temperature.Primary", "degC")],
        "file_name string, station string, char string, unit string",
    )
    put(tmp_path, "more/req2.csv", body.replace("2019-04-01T00:30:00", "soon"))
    odd = services.read_portal(spark, str(tmp_path / "more"), asked)
    assert (odd.count(), odd.filter("datetime IS NULL").count()) == (2, 1)
    put(tmp_path, "more2/req2.csv", body.replace("2019-04-01T00:15:00", "date unknown"))
    odd = services.read_portal(spark, str(tmp_path / "more2"), asked)
    assert (odd.count(), odd.filter("datetime IS NULL AND Result_Value = 9.5").count()) == (2, 1)
    put(tmp_path, "unasked/other.csv", body)
    with pytest.raises(Exception, match="no request names the file other"):
        services.read_portal(spark, str(tmp_path / "unasked"), asked).collect()
    df = services.read_portal(spark, str(tmp_path), asked)
    assert tuple(df.columns) == schemas.PORTAL_COLUMNS
    assert df.count() == 4
    row = df.filter("Monitoring_Location_ID = 'VNB' and Result_Value is not null").first()
    assert (row.datetime, row.Grade_Code, row.Result_Unit) == (dt.datetime(2019, 4, 1, 0, 15), 100.0, "degC")


def test_hydrology_exports(spark, tmp_path):
    a = put(tmp_path, "max.txt", "station.nbr\trecord.date\tdaily_max_water_temp_C\tpublished_status\n".replace(".", "_")
            + "14335500\t07-01-2020\t18.5\tPUB\n14335500\t07-02-2020\tICE\tPUB\n")
    b = put(tmp_path, "flow.txt", "station_nbr\trecord_date\ttime_observed\tmean_daily_flow_.cfs\tpublished_status\n"
            "14335500\t07-01-2020\t00:00\t120\tPRO\n")
    df = services.read_hydrology(spark, {"WTEMP_MAX": a, "MDF": b})
    assert {(r.Characteristic_Name, r.Result_Value, r.time_observed, r.published_status) for r in df.collect()} == {
        ("daily_max_water_temp_C", 18.5, None, "PUB"), ("daily_max_water_temp_C", None, None, "PUB"), ("mean_daily_flow_cfs", 120.0, "00:00", "PRO")
    }


def test_air_records(spark, tmp_path):
    a = put(tmp_path, "a.json", json.dumps([{"STATION": "S1", "DATE": "2020-07-01", "TMAX": "80"}]))
    b = put(tmp_path, "b.json", json.dumps([{"STATION": "S2", "DATE": "2020-07-01", "TMAX": "70", "TMIN": "50"}]))
    df = plans.air_temperature(spark, a, b, data_types=("TMAX", "TMIN"))
    assert {(r.STATION, r.TMAX, r.TMIN) for r in df.collect()} == {("S1", 80.0, None), ("S2", 70.0, 50.0)}
    assert {str(r.DATE) for r in df.collect()} == {"2020-07-01"}


def test_json_data_sets(spark, tmp_path):
    point = {"timestamp": "2024-01-01T00:00:00-08:00", "value": 7.5, "gradeCode": 100, "approvalLevel": 900}
    full = {"numPoints": [1], "points": [point, point], "dataset": {"locationIdentifier": "FC-8", "parameter": "pH"}}
    empty = {"numPoints": [0], "points": [], "dataset": {"locationIdentifier": "X", "parameter": "pH"}}
    put(tmp_path, "a.json", json.dumps(full))
    put(tmp_path, "b.json", json.dumps(empty))
    rows = services.read_datasets(spark, str(tmp_path)).collect()
    assert [(r.locationIdentifier, r.value, r.gradeCode) for r in rows] == [("FC-8", 7.5, 100)] * 2


def test_catalogue(spark, tmp_path):
    def feature(label, name):
        return {"geometry": {"type": "Point"}, "properties": {"dataSetLabel": label, "dataSetIdentifier": name}}

    path = put(tmp_path, "c.json", json.dumps({"features": [feature("7DADM", "T@1"), feature("Primary", "T@2")]}))
    points = spark.createDataFrame([("T@1", 1), ("T@2", 2), ("T@2", 3), ("T@3", 4), (None, 5)], "identifier string, value int")
    names = [services.read_catalogue(spark, path, label) for label in ("7DADM", "Primary")]
    assert sorted(r.value for r in services.wanted_datasets(points, *names).collect()) == [1, 2, 3]
    assert [r.value for r in services.wanted_datasets(points, names[0]).collect()] == [1]


def test_daily_values(spark, tmp_path):
    path = put(tmp_path, "dv.csv", "agency_cd,site_no,Date,X_00010_00001,X_00010_00001_cd,X_00010_00003\n"
               "AG,0141,2020-07-01,18.5,A,17.1\n")
    df = services.read_daily_values(spark, path, "00010", "csv")
    assert df.columns == ["agency_cd", "site_no", "Date", "Wtemp_Max", "Wtemp_Max_cd", "Wtemp", "Wtemp_cd",
                          "Wtemp_Min", "Wtemp_Min_cd"]
    row = df.first()
    assert (row.site_no, row.Date, row.Wtemp_Max, row.Wtemp, row.Wtemp_Min) == (
        "0141", dt.date(2020, 7, 1), 18.5, 17.1, None
    )


def test_instant_ph_and_lookups(spark, tmp_path):
    a = put(tmp_path, "a.csv", "s,d,t,p,c\n01,2020-07-01 00:15:00,PST,7.1,A\n")
    b = put(tmp_path, "b.csv", "s,d,t,p,c\n02,2020-07-01 00:15:00,PST,7.2,P\n")
    df = services.read_instant_ph(spark, a, b)
    assert {(r.site_no, r.pH_Inst, r.dateTime) for r in df.collect()} == {
        ("01", 7.1, dt.datetime(2020, 7, 1, 0, 15)), ("02", 7.2, dt.datetime(2020, 7, 1, 0, 15))
    }
    stations = put(tmp_path, "s.csv", '"STATION","NAME","LATITUDE","LONGITUDE"\n"U1","A, OR US","42.5","-124.1"\n')
    row = files.read_lookup(spark, stations, schemas.AIR_STATIONS).first()
    assert (row.NAME, row.LATITUDE) == ("A, OR US", 42.5)


def test_existing_results_are_pruned_and_filtered_at_the_source(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("O", "A", dt.date(2020, 7, 1), "junk"), ("P", "A", dt.date(2020, 7, 1), "junk")]
    spark.createDataFrame(rows, "OrganizationID string, MLocID string, SampleStartDate date, other string").write.parquet(path)
    kept = services.read_existing(spark.read.parquet(path)).filter("OrganizationID = 'O'").select("MLocID")
    assert kept.count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(OrganizationID,O)" in plan and "ReadSchema: struct<OrganizationID:string,MLocID:string>" in plan


def test_requests(spark):
    stations = spark.createDataFrame([("FC-8",), ("VNB",)], "station string")
    rows = requests.portal_requests(
        stations, "station", "2019-04-01", "2019-12-31", ["Temperature.Primary", "pH.Field Visits"], "u?"
    ).collect()
    assert len(rows) == 4
    assert rows[1].url == ("u?DataSet=pH.Field%20Visits%40FC-8&StartTime=2019-04-01%2000:00:0%20&EndTime=2019-12-31"
                           "%2000:00:0%20&ExportFormat=csv&Compressed=false&Unit=pH&Timezone=-8")
    with pytest.raises(ValueError, match="Salinity"):
        requests.portal_requests(stations, "station", "a", "b", ["pH.Primary", "Salinity"], "u?")
    asked = requests.hydrology_requests(stations, "station", "a", "b", ["MDF", "WTEMP_MIN"], "u?").collect()
    assert asked[0].query.endswith("dataset=MDF&format=tab")
    assert asked[1].query.endswith("dataset=WTEMP_MIN&format=tab&units=C")


def test_manifest_stacks_the_requests_of_all_services(spark, tmp_path):
    suppliers = spark.createDataFrame([(1,), (1,), (70,), (None,)], "s_suppkey int")
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    assert differences(spark, con, QUERIES["manifest"], ORACLES["manifest"], str(tmp_path)) == []
    made = QUERIES["manifest"](spark, str(tmp_path))
    assert made.columns == ["url", "station", "char", "unit"] and made.filter("station = '1'").count() == 2 * (4 + 2 + 1)


def test_inventory(spark):
    catalogue = spark.createDataFrame(
        [("FC-8", "pH.Primary@FC-8"), ("FC-8", "Salinity.Primary@FC-8")], "LocationIdentifier string, Identifier string"
    )
    inventory = requests.inventory_from_catalogue(catalogue, "2019-01-01", "2019-12-31")
    assert [(r.station, r.char) for r in inventory.collect()] == [("FC-8", "pH.Primary")]
    readings = spark.createDataFrame(
        [("FC-8", "pH.Primary", dt.datetime(2019, 12, 31, 23)), ("FC-8", "pH.Primary", dt.datetime(2020, 1, 1)),
         ("X", "pH.Primary", dt.datetime(2019, 5, 1))], "s string, c string, t timestamp_ntz")
    kept = requests.keep_inventoried(readings, inventory, "s", "c", F.col("t"))
    assert [r.t for r in kept.collect()] == [dt.datetime(2019, 12, 31, 23)]


def test_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("a", 3, "")], "source_file string, n int, t string")
    sinks.write_by_source(df, str(tmp_path / "by"))
    assert sorted(d for d in os.listdir(tmp_path / "by") if "=" in d) == ["source_file=a", "source_file=b"]
    back = spark.read.csv(str(tmp_path / "by"), header=True, inferSchema=True)
    assert {(r.source_file, r.n) for r in back.collect()} == {("a", 1), ("b", 2), ("a", 3)}
    part = next((tmp_path / "by" / "source_file=a").glob("*.csv")).read_text()
    assert "null" not in part and '""' not in part
    assert sinks.write_if_any(df.limit(0), str(tmp_path / "none")) is False
    assert not (tmp_path / "none").exists()
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(len(batch))
            yield batch

    for rows, name in ((df.filter("n > 5"), "nothing"), (df, "some")):
        assert sinks.write_if_any(rows.repartition(3).mapInPandas(count, df.schema), str(tmp_path / name)) is (name == "some")
        assert (tmp_path / name).exists() is (name == "some")
    assert counted.value == 3  # each row once: the table is not computed to look whether it is empty
    assert sinks.write_if_any(df, str(tmp_path / "more"), "append") is True
    assert sinks.write_if_any(df.limit(0), str(tmp_path / "more"), "append") is False
    assert spark.read.csv(str(tmp_path / "more"), header=True).count() == 3
    assert sinks.write_tables({"x": df, "empty": df.limit(0)}, str(tmp_path / "tables")) == ["x"]
    sinks.write_csv(df, str(tmp_path / "sorted"), sort=("n",))
    assert spark.read.csv(str(tmp_path / "sorted"), header=True).count() == 3


def test_bounded_sink(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 10).alias("site"), "id")
    sinks.write_bounded(df, str(tmp_path / "split"), "site", 25)
    back = spark.read.csv(str(tmp_path / "split"), header=True)
    assert back.count() == 100
    assert sorted(r["count"] for r in back.groupBy("file_no").count().collect()) == [10, 30, 30, 30]
    keyless = df.limit(7).withColumn("site", F.lit(None).cast("long"))
    sinks.write_bounded(df.unionByName(keyless), str(tmp_path / "keyless"), "site", 25)
    back = spark.read.csv(str(tmp_path / "keyless"), header=True)
    assert sorted(r["count"] for r in back.groupBy("file_no").count().collect()) == [7, 10, 30, 30, 30]


def test_large_source_is_written_by_several_tasks(spark, tmp_path):
    """The rebalance in front of the write lets AQE split a source that dominates."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(200_000).select(
            F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.lit("cold")).alias("source_file"),
            F.sha2(F.col("id").cast("string"), 256).alias("x"),
        )
        sinks.write_by_source(df, str(tmp_path / "hot"))
        assert len(list((tmp_path / "hot" / "source_file=hot").glob("*.csv"))) > 3
        assert spark.read.csv(str(tmp_path / "hot"), header=True).count() == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_hydrology_layouts_in_one_plan(spark, tmp_path):
    put(tmp_path, "a.txt", "station_nbr\trecord_date\tdaily_max_water_temp_C\n1\t07-01-2020\t18.5\n\n2\t07-01-2020\t\n")
    put(tmp_path, "b.txt", "\"published.status\"\t\"record_date\"\t\"station_nbr\"\tmeasured_stage_ft\tinstananteous_flow_cfs\n"
        "PUB\t07-02-2020\t\"3\"\t1.5\t2.5\nPRO\t07-03-2020\t4\n")
    put(tmp_path, "only_header.txt", "station_nbr\trecord_date\tmean_daily_flow_cfs\n")
    df = services.read_hydrology(spark, {"all": str(tmp_path)})
    assert sorted((r.station_nbr, r.Characteristic_Name, r.Result_Value, r.published_status) for r in df.collect()) == [
        ("1", "daily_max_water_temp_C", 18.5, None), ("2", "daily_max_water_temp_C", None, None),
        ("3", "instananteous_flow_cfs", 2.5, None), ("3", "measured_stage_ft", 1.5, None),
        ("4", "instananteous_flow_cfs", None, None), ("4", "measured_stage_ft", None, None),
    ]


@pytest.mark.parametrize("text, message", [
    ("1\t07-01-2020\t18.5\n", "no header in"), ("station_nbr\trecord_date\tother\n1\t07-01-2020\t2\n", "none of the known"),
])
def test_hydrology_files_that_cannot_be_read(spark, tmp_path, text, message):
    path = put(tmp_path, "x.txt", text)
    with pytest.raises(Exception, match=message):
        services.read_hydrology(spark, {"x": path}).collect()
