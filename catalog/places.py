"""Deployments, lookups, requests and inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverstat.functions import lookup, series_key
from riverstat.operators.deploy import (
    IMPORT_NAMES,
    attach_instrument,
    deployments,
    first_deployment,
    import_form,
    with_instrument_id,
)
from riverstat.operators.joins import attach_scalar
from riverstat.operators.summary import presence_flags, site_extent
from riverstat.plans.daily_values import site_records
from riverstat.plans.portal import located
from riverstat.sources.requests import (
    air_requests,
    hydrology_requests,
    inventory_from_catalogue,
    keep_inventoried,
    portal_requests,
)

from .landed import state_results
from .registry import Tables, query, text_dates

_PORTAL_URL = "https://data.example/Export/DataSet?"


@query("deployments", """
SELECT CAST(user_id AS VARCHAR) AS "Monitoring_Location_ID", min(ts) AS "Activity_start_date_time",
       max(ts) + INTERVAL 1 SECOND AS "Activity_end_date_time", arg_min_null(event_type, ts) AS "Activity_start_end_time_Zone",
       'Water' AS "Media", 'Surface Water' AS "Media_subdivision", 'Call' AS "Project_ID",
       '' AS "Alternate_Project_ID", '' AS "Alternate_Project_ID2", '' AS "Frequency_on_minutes", '' AS "Depth_in_m",
       concat_ws('-', user_id, strftime(min(ts), '%Y%m'), strftime(max(ts) + INTERVAL 1 SECOND, '%Y%m'))
           AS "Equipment_ID"
FROM events GROUP BY user_id""")
def deployed(t: Tables) -> DataFrame:
    readings = t.events.withColumn("Monitoring_Location_ID", F.col("user_id").cast("string"))
    extents = deployments(
        readings, ["Monitoring_Location_ID"], "ts", F.col("event_type"), "1 SECOND", IMPORT_NAMES
    )
    return with_instrument_id(import_form(extents, "Call"))


@query("deployments_open", """
SELECT CAST(user_id AS VARCHAR) AS "Monitoring_Location_ID", event_type AS "Equipment_ID", min(ts) AS startdate,
       '' AS enddate, 'PST' AS "TZ"
FROM events GROUP BY user_id, event_type""")
def deployed_open(t: Tables) -> DataFrame:
    readings = t.events.select(
        F.col("user_id").cast("string").alias("Monitoring_Location_ID"), F.col("event_type").alias("Equipment_ID"), "ts"
    )
    return deployments(readings, ["Monitoring_Location_ID", "Equipment_ID"], "ts", F.lit("PST"))


@query("first_deployment", """
SELECT user_id, ts, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id, event_type) = 1""")
def first_of_user(t: Tables) -> DataFrame:
    return first_deployment(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts")


@query("attach_instrument", """
SELECT event_id, concat_ws('-', user_id, event_type) AS series,
       concat_ws('-', user_id, strftime(min(ts) OVER u, '%Y%m'), strftime(max(ts) OVER u, '%Y%m')) AS "Equipment_ID",
       CAST(user_id AS VARCHAR) AS same
FROM events WINDOW u AS (PARTITION BY user_id)""")
def attach(t: Tables) -> DataFrame:
    readings = t.events.withColumn("Monitoring_Location_ID", F.col("user_id").cast("string"))
    extents = with_instrument_id(
        deployments(readings, ["Monitoring_Location_ID"], "ts", F.lit("UTC"), "0 SECOND", IMPORT_NAMES)
    )
    joined = attach_instrument(readings, extents, "Monitoring_Location_ID")
    return joined.select(
        "event_id", series_key(F.col("Monitoring_Location_ID"), F.col("event_type")).alias("series"), "Equipment_ID",
        F.col("Monitoring_Location_ID").alias("same"),
    )


_CHARACTERISTIC = {
    "click": "Temperature.Primary", "view": "Dissolved oxygen.Primary", "signup": "Temperature.7DADM",
}


@query("presence_flags", """
SELECT user_id, bool_or(event_type IN ('click', 'signup')) AS temp_in_group,
       bool_or(event_type = 'signup') AS dadm7_in_group
FROM events GROUP BY user_id""")
def presence(t: Tables) -> DataFrame:
    inventory = t.events.select("user_id", lookup(F.col("event_type"), _CHARACTERISTIC, "pH.Primary").alias("char"))
    return presence_flags(inventory, "user_id", "char")


@query("crosswalk", """
SELECT s_suppkey, s_name, n_name AS "MLocID" FROM supplier
LEFT JOIN (SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')
       ON s_nationkey = n_nationkey""")
def crosswalk(t: Tables) -> DataFrame:
    known = t.nation.join(
        t.region.filter(F.col("r_name") != "ASIA"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("LocationIdentifier"), F.col("n_name").alias("MLocID"))
    stations = t.supplier.withColumnRenamed("s_nationkey", "Monitoring_Location_ID")
    return located(stations, known).select("s_suppkey", "s_name", F.col("Monitoring_Location_ID").alias("MLocID"))


_SITE_BLANKS = (
    "SiteComments", "HUC12", "TribalLand", "TribalName", "CreateDate", "T_R_S", "Comments", "WellForm", "AltLocID",
    "AltLocName", "EcoRegion3", "EcoRegion4", "Reachcode", "GNIS_Name", "AU_ID",
)


@query("county_lookup", f"""
WITH s AS (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 'ST' WHEN 'AUTOMOBILE' THEN 'GW' WHEN 'MACHINERY' THEN 'LK'
                  WHEN 'HOUSEHOLD' THEN 'OC' END AS tp FROM customer),
k AS (SELECT *, CASE tp WHEN 'ST' THEN 'River/Stream' WHEN 'GW' THEN 'Well' WHEN 'LK' THEN 'Lake' ELSE 'ERROR' END
          AS kind FROM s)
SELECT CAST(c_custkey AS VARCHAR) AS "Stationkey", coalesce(c_name, '') AS "Desc", kind AS "MonLocType",
       coalesce(n_name, '') AS "COUNTY", 'OR' AS "STATE", 'US' AS "Country", coalesce(c_mktsegment, '') AS "HUC8", '' AS "Lat",
       '' AS "Long", 'NAD83' AS "Datum", 'Interpolation-Digital Map Source' AS "CollMethod", '' AS "MapScale",
       CASE kind WHEN 'Well' THEN 'Monitoring' ELSE '' END AS "WellType",
       CASE kind WHEN 'Well' THEN c_mktsegment ELSE '' END AS "WellAquiferName",
       '' AS "WellDepth", 'ft' AS "WellDepthUnit",
       {", ".join(f"'' AS {c}" for c in _SITE_BLANKS)}
FROM k LEFT JOIN (SELECT * FROM nation WHERE n_regionkey > 0) ON c_nationkey = n_nationkey""")
def county_lookup(t: Tables) -> DataFrame:
    types = {"BUILDING": "ST", "AUTOMOBILE": "GW", "MACHINERY": "LK", "HOUSEHOLD": "OC"}
    empty = F.lit(None).cast("double")
    sites = t.customer.select(
        F.col("c_custkey").cast("string").alias("site_no"), F.col("c_name").alias("station_nm"),
        lookup(F.col("c_mktsegment"), types).alias("site_tp_cd"), F.col("c_nationkey").alias("county_cd"),
        F.col("c_mktsegment").alias("huc_cd"), F.lit("NAD83").alias("dec_coord_datum_cd"),
        F.col("c_mktsegment").alias("nat_aqfr_cd"), empty.alias("dec_lat_va"), empty.alias("dec_long_va"),
        empty.alias("map_scale_fc"), empty.alias("well_depth_va"),
    )
    counties = t.nation.filter(F.col("n_regionkey") > 0).select(
        F.col("n_nationkey").alias("county_cd"), F.col("n_name").alias("county_nm")
    )
    return site_records(sites, counties)


@query("alt_project", """
SELECT o_orderkey, 'Call' AS "Project", (SELECT min(r_name) FROM region) AS alt_project FROM orders""")
def alt_project(t: Tables) -> DataFrame:
    project = t.region.agg(F.min("r_name"))
    return attach_scalar(t.orders.select("o_orderkey", F.lit("Call").alias("Project")), project, "alt_project")


_ASKED = ("Temperature.Primary", "Dissolved oxygen.Primary", "Dissolved oxygen saturation.Primary", "pH.Field Visits")


@query("manifest", f"""
WITH c(char, unit) AS (VALUES ('Temperature.Primary', 'degC'), ('Dissolved oxygen.Primary', 'mg/l'),
                              ('Dissolved oxygen saturation.Primary', '%'), ('pH.Field Visits', 'pH')),
h(char, suffix) AS (VALUES ('MDF', '&format=tab'), ('WTEMP_MAX', '&format=tab&units=C')),
s AS (SELECT CAST(s_suppkey AS VARCHAR) AS station FROM supplier)
SELECT '{_PORTAL_URL}DataSet=' || replace(char, ' ', '%20') || '%40' || station
       || '&StartTime=2019-04-01%2000:00:0%20&EndTime=2019-12-31%2000:00:0%20&ExportFormat=csv&Compressed=false&Unit='
       || unit || '&Timezone=-8' AS url, station, char, unit FROM s CROSS JOIN c
UNION ALL
SELECT '{_PORTAL_URL}station_nbr=' || station || '&start_date=2019-04-01%2012:00:00%20AM&end_date=2019-12-31'
       || '%2012:00:00%20AM&dataset=' || char || suffix, station, char, NULL FROM s CROSS JOIN h
UNION ALL
SELECT '{_PORTAL_URL}&dataTypes=TMAX&startDate=2019-04-01&endDate=2019-12-31&stations=' || station, station, 'TMAX', NULL
FROM s""")
def manifest(t: Tables) -> DataFrame:
    period = ("2019-04-01", "2019-12-31")
    portal = portal_requests(t.supplier, "s_suppkey", *period, _ASKED, _PORTAL_URL).drop("file_name")
    none = F.lit(None).cast("string")
    hydrology = hydrology_requests(t.supplier, "s_suppkey", *period, ("MDF", "WTEMP_MAX"), _PORTAL_URL)
    stations = t.supplier.withColumn("s_suppkey", F.col("s_suppkey").cast("string"))
    air = air_requests(stations, "s_suppkey", *period, _PORTAL_URL)
    return (
        portal.unionByName(hydrology.withColumnRenamed("query", "url").withColumn("unit", none))
        .unionByName(air.withColumnRenamed("query", "url").withColumns({"char": F.lit("TMAX"), "unit": none}))
    )


_PRIORITY = {
    "AUTOMOBILE": "1-URGENT", "BUILDING": "2-HIGH", "FURNITURE": "3-MEDIUM", "HOUSEHOLD": "5-LOW",
    "MACHINERY": "4-NOT SPECIFIED",
}
_PRIORITY_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _PRIORITY.items()) + " END"


@query("inventory_semi", f"""
WITH i AS (SELECT c_custkey, {_PRIORITY_SQL} AS char FROM customer)
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE EXISTS (SELECT 1 FROM i WHERE c_custkey = o_custkey AND char = o_orderpriority)
  AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""")
def inventory_semi(t: Tables) -> DataFrame:
    catalogue = t.customer.select(
        F.col("c_custkey").alias("LocationIdentifier"),
        F.concat(lookup(F.col("c_mktsegment"), _PRIORITY), F.lit("@"), "c_name").alias("Identifier"),
    )
    inventory = inventory_from_catalogue(catalogue, "1996-01-01", "1998-12-31", tuple(_PRIORITY.values()))
    kept = keep_inventoried(t.orders, inventory, "o_custkey", "o_orderpriority", F.col("o_orderdate"))
    return kept.select("o_orderkey", "o_custkey", "o_orderpriority")


@query("site_extent", """
SELECT o_custkey, strftime(min(o_orderdate), '%Y-%m-%d') AS min_date, strftime(max(o_orderdate), '%Y-%m-%d') AS max_date,
       string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS chars
FROM orders GROUP BY o_custkey""")
def extent(t: Tables) -> DataFrame:
    return text_dates(site_extent(t.orders, "o_custkey", "o_orderdate", "o_orderpriority"), "min_date", "max_date")


@query("site_union", """
SELECT DISTINCT n_nationkey AS nation FROM nation WHERE n_regionkey <> 0 AND (
    n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING')
    OR n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 0) OR n_regionkey = 1)""")
def site_union(t: Tables) -> DataFrame:
    """Sites of a state's results: those of any parameter whose values survive the flow, of wanted types, each once."""
    day = F.lit("2020-06-01").cast("date").alias("Date")

    def flag(good, bad: str):
        return F.when(good, F.lit("A")).otherwise(F.lit(bad))

    sites = t.nation.select(
        F.col("n_nationkey").cast("string").alias("site_no"), F.col("n_name").alias("station_nm"),
        F.when(F.col("n_regionkey") == 0, "GW").otherwise("ST").alias("site_tp_cd"),
        F.col("n_nationkey").cast("string").alias("county_cd"),
    )
    temperature = t.customer.select(
        F.col("c_nationkey").cast("string").alias("site_no"), day, F.col("c_acctbal").alias("Wtemp_Max"),
        flag(F.col("c_mktsegment") == "BUILDING", "A e").alias("Wtemp_Max_cd"),
    )
    oxygen = t.supplier.select(
        F.col("s_nationkey").cast("string").alias("site_no"), day, F.col("s_acctbal").alias("DO"),
        flag(F.col("s_acctbal") > 0, "P Eqp").alias("DO_cd"),
    )
    ph = t.nation.select(
        F.col("n_nationkey").cast("string").alias("site_no"), day.cast("timestamp_ntz").alias("dateTime"),
        F.lit(7.0).alias("pH_Inst"), flag(F.col("n_regionkey") == 1, "P").alias("pH_Inst_cd"),
    )
    records = state_results(t, sites, temperature, oxygen, ph)["monitoring_locations"]
    return records.select(F.col("Stationkey").cast("int").alias("nation"))


@query("distinct_sites", """
SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS site, c_name AS name, n_name AS county
FROM customer JOIN events ON user_id = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
WHERE event_type IN ('click', 'view') AND c_mktsegment <> 'FURNITURE'""")
def distinct_sites(t: Tables) -> DataFrame:
    """Sites with approved pH values, each once however many values it has."""
    sites = t.customer.select(
        F.col("c_custkey").cast("string").alias("site_no"), F.col("c_name").alias("station_nm"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "GW").otherwise("ST").alias("site_tp_cd"),
        F.col("c_nationkey").cast("string").alias("county_cd"),
    )
    ph = t.events.select(
        F.col("user_id").cast("string").alias("site_no"), F.col("ts").cast("timestamp_ntz").alias("dateTime"),
        F.col("value").alias("pH_Inst"),
        F.when(F.col("event_type").isin("click", "view"), "A").otherwise("P").alias("pH_Inst_cd"),
    )
    records = state_results(t, sites, ph=ph)["monitoring_locations"]
    return records.select(F.col("Stationkey").alias("site"), F.col("Desc").alias("name"), F.col("COUNTY").alias("county"))
