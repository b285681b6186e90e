import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from riverstat.operators.reconcile import (
    Columns,
    check_duplicates,
    classify_duplicates,
    drop_existing,
    new_deployments,
    prefilter_existing,
    stored_results,
)
from riverstat.operators.deploy import deployments, first_deployment, instrument_is_location

NEW = ("SiteID string, ActStartDate date, ActStartTime string, CharID string, StatisticalBasis string,"
       " SmplDepth string, Method string, Result double")
STORE = ("MLocID string, SampleStartDate date, SampleStartTime string, Char_Name string, Statistical_Base string,"
         " act_depth_height string, Method_Code string, Result double, Result_UID string")
DAY = dt.date(2020, 7, 1)


def new(spark, *rows):
    return spark.createDataFrame(list(rows), NEW)


def store(spark, *rows):
    return spark.createDataFrame(list(rows), STORE)


def row(site="A", time="0:00", stat="Daily Maximum", depth="", method="M", result=1.0, day=DAY):
    return (site, day, time, "T", stat, depth, method, result)


def kept(site="A", time="00:00:00", stat="Maximum", depth=None, method="M", result=1.0, uid="u", day=DAY):
    return (site, day, time, "T", stat, depth, method, result, uid)


@pytest.mark.parametrize(
    ("incoming", "existing", "expected"),
    [
        (row(), kept(), "suspected duplicate"),
        (row(), kept(depth=""), "suspected duplicate"),
        (row(depth="1"), kept(), "new"),
        (row(result=2.0), kept(), "suspected update"),
        (row(result=None), kept(), "suspected update"),
        (row(), kept(result=None), "suspected update"),
        (row(result=None), kept(result=None), "suspected duplicate"),
        (row(time="13:05"), kept(time="13:05:59"), "suspected duplicate"),
        (row(time="13:05"), kept(), "new"),
        (row(method=None), kept(method=None), "suspected duplicate"),
        (row(method=""), kept(method=None), "new"),
        (row(stat="7DMADMin"), kept(stat="7DADMin"), "suspected duplicate"),
        (row(stat="30DMADMean"), kept(stat="30DADMean"), "suspected duplicate"),
        (row(site="B"), kept(), "new"),
        (row(result=0.0), kept(result=-0.0), "suspected duplicate"),
    ],
)
def test_class(spark, incoming, existing, expected):
    classified = classify_duplicates(new(spark, incoming), store(spark, existing)).collect()
    assert [r.dup_class for r in classified] == [expected]


def test_empty_store_makes_everything_new(spark):
    tables = check_duplicates(new(spark, row(), row(site="B")), store(spark))
    assert tables["non_duplicates"].count() == 2
    assert tables["suspected_dups"].isEmpty() and tables["suspected_updates"].isEmpty()
    assert tables["non_duplicates"].columns == [c.split()[0] for c in NEW.split(", ")]


def test_row_with_equal_and_different_matches_is_in_both_classes(spark):
    stored = store(spark, kept(uid="a"), kept(result=3.0, uid="b"), kept(result=4.0, uid="c"))
    rows = {r.dup_class: r for r in classify_duplicates(new(spark, row()), stored).collect()}
    assert rows["suspected duplicate"].stored_uid == "a" and rows["suspected duplicate"].stored_matches == 1
    assert rows["suspected update"].stored_matches == 2 and rows["suspected update"].stored_result in (3.0, 4.0)


def test_all_stored_matches_are_listed_once(spark):
    stored = store(spark, *(kept(result=float(i), uid=f"u{i}") for i in range(1, 5)), kept(site="B", uid="other"),
                   kept(method=None, uid="n"))
    incoming = new(spark, row(), row(), row(method=None))
    matches = check_duplicates(incoming, stored)["stored_matches"]
    assert sorted(r.Result_UID for r in matches.collect()) == ["n", "u1", "u2", "u3", "u4"]


def test_column_names_are_parameters(spark):
    other = new(spark, row()).withColumnsRenamed({"SiteID": "place", "Result": "value"})
    got = classify_duplicates(other, store(spark, kept()), Columns(site="place", result="value")).first()
    assert got.dup_class == "suspected duplicate" and got.place == "A"


def test_against_pairs(spark):
    """Same classes and counts as joining all pairs, on keys that repeat on both sides."""
    rng = random.Random(3)

    def pick(options):
        return rng.choice(options)

    incoming = [
        row(pick("AB"), pick(["0:00", "1:00"]), depth=pick(["", "1"]), method=pick([None, "M"]),
            result=pick([1.0, 2.0, 3.0, None])) for _ in range(120)
    ]
    existing = [
        kept(pick("AB"), pick(["00:00:00", "01:00:00"]), depth=pick([None, "1"]), method=pick([None, "M"]),
             result=pick([1.0, 2.0, None]), uid=str(i)) for i in range(40)
    ]
    numbered = new(spark, *incoming).withColumn("id", F.monotonically_increasing_id())
    ids = [r.id for r in numbered.collect()]
    got = {(r.id, r.dup_class): r.stored_matches for r in classify_duplicates(numbered, store(spark, *existing)).collect()}
    expected = {}
    for i, n in zip(ids, numbered.collect(), strict=True):
        matches = [
            e for e in existing
            if (e[0], e[1], e[2][:5].lstrip("0") or "0:00", e[5], e[6]) ==
            (n.SiteID, n.ActStartDate, n.ActStartTime.lstrip("0") or "0:00", n.SmplDepth or None, n.Method)
        ]
        if not matches:
            expected[i, "new"] = 0
        same = sum(e[7] == n.Result for e in matches)
        if same:
            expected[i, "suspected duplicate"] = same
        if len(matches) > same:
            expected[i, "suspected update"] = len(matches) - same
    assert got == expected


def test_hot_key_does_not_multiply(spark):
    """A key that holds a third of the rows on both sides gives one row per incoming row and class."""
    n = 30_000
    incoming = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("SiteID"),
        F.lit(DAY).alias("ActStartDate"), F.lit("0:00").alias("ActStartTime"), F.lit("T").alias("CharID"),
        F.lit("Daily Maximum").alias("StatisticalBasis"), F.lit("").alias("SmplDepth"), F.lit("M").alias("Method"),
        (F.col("id") % 5).cast("double").alias("Result"),
    )
    existing = incoming.select(
        F.col("SiteID").alias("MLocID"), F.col("ActStartDate").alias("SampleStartDate"),
        F.lit("00:00:00").alias("SampleStartTime"), F.col("CharID").alias("Char_Name"),
        F.lit("Maximum").alias("Statistical_Base"), F.lit(None).cast("string").alias("act_depth_height"),
        F.col("Method").alias("Method_Code"), "Result", F.col("SiteID").alias("Result_UID"),
    )
    classified = classify_duplicates(incoming, existing)
    counts = {r.dup_class: (r["count"], r.m) for r in classified.groupBy("dup_class").agg(
        F.count(F.lit(1)).alias("count"), F.sum("stored_matches").alias("m")).collect()}
    hot = n // 3
    assert counts["suspected duplicate"][0] == n
    assert counts["suspected update"][0] == hot
    assert counts["suspected duplicate"][1] + counts["suspected update"][1] == hot * hot + (n - hot)


def test_partition_of_a_hot_key_is_split(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        incoming = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("SiteID"),
            F.lit(DAY).alias("ActStartDate"), F.lit("0:00").alias("ActStartTime"), F.lit("T").alias("CharID"),
            F.lit("Daily Maximum").alias("StatisticalBasis"), F.lit("").alias("SmplDepth"),
            F.lit("M").alias("Method"), F.col("id").cast("double").alias("Result"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        classified = classify_duplicates(incoming, store(spark, kept(site="hot", result=2.0), kept(site="1", uid="v")))
        counts = classified.groupBy("dup_class").count()
        assert {r.dup_class: r["count"] for r in counts.collect()} == {
            "new": 99_999, "suspected duplicate": 2, "suspected update": 99_999
        }
        assert "skew=true" in counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_prefilter(spark):
    wanted = new(spark, row(day=dt.date(2020, 7, 5)), row(site="B"))
    existing = store(spark, kept(uid="old"), kept(uid="in", day=dt.date(2020, 7, 6)), kept(site="B", uid="b"),
                     kept(site="C", uid="c"))
    assert {r.Result_UID for r in prefilter_existing(existing, wanted).collect()} == {"in", "b"}


def test_drop_existing(spark):
    columns = "CharID string, Result double, Unit string, StatisticalBasis string, SiteID string, ActStartDate date, ActivityID string"
    incoming = spark.createDataFrame(
        [("T", 1.0, "C", "7DMADMin", "A", DAY, "x"), ("T", 2.0, None, "Daily Mean", "A", DAY, None),
         ("T", 3.0, "C", "Daily Mean", "A", DAY, "z")], columns)
    existing = spark.createDataFrame(
        [("O", "A", "x", DAY, "T", 1.0, "C", "7DADMin"), ("O", "A", None, DAY, "T", 2.0, None, "Mean"),
         ("P", "A", "z", DAY, "T", 3.0, "C", "Mean"), ("O", "A", "z", dt.date(2010, 1, 1), "T", 3.0, "C", "Mean")],
        "OrganizationID string, MLocID string, act_id string, SampleStartDate date, Char_Name string,"
        " Result_Numeric double, Result_Unit string, Statistical_Base string")
    known = stored_results(existing, incoming, "O", "2020-01-01", "2024-12-31")
    assert known.count() == 2
    assert [r.Result for r in drop_existing(incoming, known).collect()] == [3.0]


def test_deployments(spark):
    rows = [("A", "e1", dt.datetime(2020, 1, 2), "PDT"), ("A", "e1", dt.datetime(2020, 1, 1), "PST"),
            ("A", "e2", dt.datetime(2019, 1, 1), "PST"), ("A", "e1", None, "x"), (None, "e3", dt.datetime(2020, 1, 1), "PST")]
    df = spark.createDataFrame(rows, "Monitoring_Location_ID string, Equipment_ID string, ts timestamp_ntz, tz string")
    extents = deployments(df, ["Monitoring_Location_ID", "Equipment_ID"], "ts", F.col("tz"), "5 MINUTES")
    one = extents.filter("Equipment_ID = 'e1'").first()
    assert (one.startdate, one.enddate, one.TZ) == (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2, 0, 5), "PST")
    first = first_deployment(extents, "Monitoring_Location_ID", "startdate")
    assert first.columns == extents.columns
    assert {r.Equipment_ID for r in first.collect()} == {"e2", "e3"}
    assert instrument_is_location(df).filter("Equipment_ID <=> Monitoring_Location_ID").count() == 5


def test_new_deployments(spark):
    deployed = spark.createDataFrame([("A", "2020"), ("B", "2021")], "Monitoring_Location_ID string, Activity_end_date_time string")
    known = spark.createDataFrame([("O", "A", "e"), ("X", "B", "e")], "OrganizationID string, MLocID string, Equipment_ID string")
    got = new_deployments(deployed, known, "O").collect()
    assert [(r.Monitoring_Location_ID, r.Equipment_ID, r.Activity_end_date_time) for r in got] == [("B", "B", "")]
