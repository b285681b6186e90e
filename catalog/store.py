"""Comparison with stored results, and the bounded split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverstat.operators.reconcile import (
    classify_duplicates,
    drop_existing,
    new_deployments,
    prefilter_existing,
    stored_results,
    stored_rows_matched,
)
from riverstat.operators.split import bounded_split

from .registry import Tables, query

# orders as new results; the store holds the orders that are not pending, urgent ones with another price
NEW_SQL = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS site, CAST(o_orderdate AS DATE) AS day, '0:00' AS time,
       o_orderpriority AS char, 'Daily Maximum' AS stat, CASE o_orderstatus WHEN 'O' THEN '' ELSE '1' END AS depth,
       CAST(o_orderkey AS VARCHAR) AS method, o_totalprice AS result, o_orderstatus FROM orders"""
STORE_SQL = """
SELECT site, char, day, '00:00' AS time, method, nullif(depth, '') AS depth, 'Maximum' AS stat, o_orderkey AS uid,
       CASE char WHEN '1-URGENT' THEN result + 1 WHEN '2-HIGH' THEN NULL ELSE result END AS result
FROM n WHERE o_orderstatus <> 'P'"""


def new_results(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("SiteID"),
        F.to_date("o_orderdate").alias("ActStartDate"),
        F.lit("0:00").alias("ActStartTime"),
        F.col("o_orderpriority").alias("CharID"),
        F.lit("Daily Maximum").alias("StatisticalBasis"),
        F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.lit("1")).alias("SmplDepth"),
        F.col("o_orderkey").cast("string").alias("Method"),
        F.col("o_totalprice").alias("Result"),
        F.col("o_orderstatus"),
    )


def stored(t: Tables) -> DataFrame:
    urgent, high = F.col("CharID") == "1-URGENT", F.col("CharID") == "2-HIGH"
    return new_results(t).filter(F.col("o_orderstatus") != "P").select(
        F.lit("ORG").alias("OrganizationID"),
        F.col("SiteID").alias("MLocID"),
        F.col("CharID").alias("Char_Name"),
        F.col("ActStartDate").alias("SampleStartDate"),
        F.lit("00:00:00").alias("SampleStartTime"),
        F.col("Method").alias("Method_Code"),
        F.nullif("SmplDepth", F.lit("")).alias("act_depth_height"),
        F.lit("Maximum").alias("Statistical_Base"),
        F.when(urgent, F.col("Result") + 1).when(high, F.lit(None)).otherwise(F.col("Result")).alias("Result"),
        F.col("o_orderkey").alias("Result_UID"),
    )


@query("dup_classify", f"""
WITH n AS ({NEW_SQL}), e AS ({STORE_SQL})
SELECT n.o_orderkey, CASE WHEN e.uid IS NULL THEN 'new' WHEN n.result IS NOT DISTINCT FROM e.result
            THEN 'suspected duplicate' ELSE 'suspected update' END AS dup_class, e.result AS stored_result,
       CAST(e.uid AS VARCHAR) AS stored_uid, CASE WHEN e.uid IS NULL THEN 0 ELSE 1 END AS stored_matches
FROM n LEFT JOIN e ON n.site IS NOT DISTINCT FROM e.site AND n.char IS NOT DISTINCT FROM e.char
     AND n.day IS NOT DISTINCT FROM e.day AND e.time = '00:00' AND n.method = e.method
     AND nullif(n.depth, '') IS NOT DISTINCT FROM e.depth AND e.stat = 'Maximum'""")
def dup_classify(t: Tables) -> DataFrame:
    classified = classify_duplicates(new_results(t), stored(t))
    return classified.select(
        "o_orderkey", "dup_class", "stored_result", F.col("stored_uid").cast("string").alias("stored_uid"),
        F.col("stored_matches").cast("int").alias("stored_matches"),
    )


@query("dup_classify_many", """
WITH n AS (SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS site, l_returnflag AS char,
                  CAST(l_shipdate AS DATE) AS day, l_quantity AS result FROM lineitem),
e AS (SELECT site, char, day, result FROM n WHERE result <> 50),
s AS (SELECT site, char, day, result, count(*) AS k FROM e GROUP BY ALL),
a AS (SELECT site, char, day, sum(k) AS k FROM s GROUP BY ALL),
m AS (SELECT n.*, coalesce(s.k, 0) AS same, coalesce(a.k, 0) AS any_k
      FROM n LEFT JOIN a ON a.site IS NOT DISTINCT FROM n.site AND a.char IS NOT DISTINCT FROM n.char
                        AND a.day IS NOT DISTINCT FROM n.day
             LEFT JOIN s ON s.site IS NOT DISTINCT FROM n.site AND s.char IS NOT DISTINCT FROM n.char
                        AND s.day IS NOT DISTINCT FROM n.day AND s.result IS NOT DISTINCT FROM n.result)
SELECT l_orderkey, l_linenumber, 'new' AS dup_class, 0 AS stored_matches FROM m WHERE any_k = 0
UNION ALL SELECT l_orderkey, l_linenumber, 'suspected duplicate', CAST(same AS INTEGER) FROM m WHERE same > 0
UNION ALL SELECT l_orderkey, l_linenumber, 'suspected update', CAST(any_k - same AS INTEGER) FROM m WHERE any_k > same""")
def dup_classify_many(t: Tables) -> DataFrame:
    """Keys that occur many times on both sides."""
    new = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("SiteID"),
        F.to_date("l_shipdate").alias("ActStartDate"), F.lit("0:00").alias("ActStartTime"),
        F.col("l_returnflag").alias("CharID"), F.lit("Daily Mean").alias("StatisticalBasis"),
        F.lit("").alias("SmplDepth"), F.lit("M").alias("Method"), F.col("l_quantity").alias("Result"),
    )
    existing = new.filter(F.col("Result") != 50).select(
        F.col("SiteID").alias("MLocID"), F.col("CharID").alias("Char_Name"),
        F.col("ActStartDate").alias("SampleStartDate"), F.lit("00:00:00").alias("SampleStartTime"),
        F.col("Method").alias("Method_Code"), F.lit(None).cast("string").alias("act_depth_height"),
        F.lit("Mean").alias("Statistical_Base"), "Result",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Result_UID"),
    )
    classified = classify_duplicates(new, existing)
    return classified.select(
        "l_orderkey", "l_linenumber", "dup_class", F.col("stored_matches").cast("int").alias("stored_matches")
    )


@query("dup_matches", f"""
WITH n AS ({NEW_SQL}), w AS (SELECT * FROM n WHERE o_orderstatus <> 'F'), e AS ({STORE_SQL})
SELECT uid AS o_orderkey, result FROM e WHERE EXISTS (
    SELECT 1 FROM w WHERE w.site IS NOT DISTINCT FROM e.site AND w.char IS NOT DISTINCT FROM e.char
      AND w.day IS NOT DISTINCT FROM e.day AND w.method = e.method AND nullif(w.depth, '') IS NOT DISTINCT FROM e.depth)""")
def dup_matches(t: Tables) -> DataFrame:
    """Stored rows that orders which are not finished match."""
    wanted = new_results(t).filter(F.col("o_orderstatus") != "F")
    matched = stored_rows_matched(wanted, stored(t))
    return matched.select(F.col("Result_UID").alias("o_orderkey"), F.col("Result").alias("result"))


@query("existing_prefilter", f"""
WITH n AS ({NEW_SQL}), w AS (SELECT * FROM n WHERE o_orderstatus = 'O')
SELECT o_orderkey FROM n WHERE o_orderstatus <> 'P'
  AND EXISTS (SELECT 1 FROM w WHERE w.site = n.site AND w.char = n.char)
  AND day >= (SELECT min(day) FROM w WHERE w.site = n.site)""")
def existing_prefilter(t: Tables) -> DataFrame:
    wanted = new_results(t).filter(F.col("o_orderstatus") == "O")
    return prefilter_existing(stored(t), wanted).select(F.col("Result_UID").alias("o_orderkey"))


@query("drop_existing", """
WITH n AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, o_totalprice AS result,
                  o_orderstatus FROM orders),
e AS (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN result + 1 ELSE result END AS r FROM n
      WHERE o_orderstatus <> 'P' AND day BETWEEN DATE '1995-01-01' AND DATE '1998-12-31')
SELECT o_orderkey FROM n WHERE NOT EXISTS (
    SELECT 1 FROM e WHERE e.o_custkey = n.o_custkey AND e.day = n.day AND e.o_orderkey = n.o_orderkey
      AND e.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority AND e.r IS NOT DISTINCT FROM n.result)""")
def drop_stored(t: Tables) -> DataFrame:
    new = new_results(t).withColumns({
        "Unit": F.nullif("o_orderstatus", F.lit("O")), "ActivityID": F.col("Method"),
    })
    urgent = F.col("CharID") == "1-URGENT"
    existing = new.filter(F.col("o_orderstatus") != "P").select(
        F.lit("ORG").alias("OrganizationID"), F.col("SiteID").alias("MLocID"), F.col("ActivityID").alias("act_id"),
        F.col("ActStartDate").alias("SampleStartDate"), F.col("CharID").alias("Char_Name"),
        F.when(urgent, F.col("Result") + 1).otherwise(F.col("Result")).alias("Result_Numeric"),
        F.col("Unit").alias("Result_Unit"), F.lit("Maximum").alias("Statistical_Base"),
    )
    known = stored_results(existing, new, "ORG", "1995-01-01", "1998-12-31")
    return drop_existing(new, known).select("o_orderkey")


@query("new_deployments", """
SELECT CAST(c_custkey AS VARCHAR) AS "Monitoring_Location_ID", CAST(c_custkey AS VARCHAR) AS "Equipment_ID",
       '' AS "Activity_end_date_time"
FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def fresh_deployments(t: Tables) -> DataFrame:
    deployed = t.customer.select(F.col("c_custkey").cast("string").alias("Monitoring_Location_ID"))
    known = t.orders.select(
        F.col("o_custkey").cast("string").alias("MLocID"), F.col("o_orderstatus").alias("OrganizationID")
    )
    return new_deployments(deployed, known, "F")


@query("bounded_split", """
WITH RECURSIVE g AS (SELECT o_custkey, count(*) AS n, row_number() OVER (ORDER BY o_custkey) AS i
                     FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey),
w AS (SELECT i, n AS filled, CAST(1 AS BIGINT) AS file_no FROM g WHERE i = 1
      UNION ALL SELECT g.i, CASE WHEN w.filled > 500 THEN g.n ELSE w.filled + g.n END,
                       CASE WHEN w.filled > 500 THEN w.file_no + 1 ELSE w.file_no END
      FROM w JOIN g ON g.i = w.i + 1)
SELECT o_orderkey, o_custkey, file_no FROM orders JOIN g USING (o_custkey) JOIN w USING (i)""")
def split_orders(t: Tables) -> DataFrame:
    return bounded_split(t.orders, "o_custkey", 500).select("o_orderkey", "o_custkey", "file_no")
