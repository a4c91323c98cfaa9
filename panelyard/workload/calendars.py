"""Calendars and gaps derived from the dates of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import calendar as C
from panelyard.workload.base import bars, day, query, table

# The holidays the session queries assume.
_HOLIDAYS = (("2024-01-01", "New Year"), ("2024-01-15", "Observance"))

_STATUS = """
WITH days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem
              UNION SELECT CAST(ts AS DATE) FROM events),
     busy AS (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem GROUP BY 1 HAVING count(*) < {limit}),
     covered AS (SELECT DISTINCT year(ts) AS y FROM events UNION SELECT year(o_orderdate) FROM orders
                 WHERE year(o_orderdate) < 2000),
     status AS (SELECT date, CASE WHEN isodow(date) > 5 THEN 'closed' WHEN year(date) NOT IN (SELECT y FROM covered)
                  THEN 'unknown' WHEN date IN (SELECT d FROM busy) THEN 'closed' ELSE 'open' END AS status,
                CASE WHEN isodow(date) > 5 THEN 'weekend' WHEN year(date) NOT IN (SELECT y FROM covered) THEN ''
                     WHEN date IN (SELECT d FROM busy) THEN 'quiet day' ELSE '' END AS reason FROM days)
"""


def _status(spark, sf):
    """Dates of the tables; days with few shipments stand for holidays."""
    ship = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    seen = table(spark, sf, "events").select(F.to_date("ts").alias("date"))
    quiet = ship.groupBy("date").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < 20)
    covered = seen.select(F.year("date").alias("year")).unionByName(
        table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).where(F.col("year") < 2000)).distinct()
    holidays = quiet.select("date", F.lit("quiet day").alias("name"))
    return C.session_status(ship.unionByName(seen).distinct(), holidays, covered)


@query("session_status", _STATUS.format(limit=20) + "SELECT * FROM status")
def session_status(spark, sf):
    return _status(spark, sf)


@query("trading_days", _STATUS.format(limit=20) + "SELECT date FROM status WHERE status <> 'closed'")
def trading_days(spark, sf):
    return C.trading_days(_status(spark, sf))


@query("missing_sessions", """
SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem WHERE isodow(l_shipdate) < 6
  AND CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def missing_sessions(spark, sf):
    expected = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")).where(F.weekday("date") < 5)
    urgent = table(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(
        F.to_date("o_orderdate").alias("date"))
    return C.missing_sessions(expected.distinct(), urgent)


@query("gap_islands", """
WITH span AS (SELECT entity, min(day) AS f FROM bars GROUP BY entity),
     cal AS (SELECT DATE '2023-12-25' + CAST(i AS INTEGER) AS d FROM range(0, 50) r(i)),
     expected AS (SELECT entity, d, row_number() OVER (PARTITION BY entity ORDER BY d) AS k FROM span JOIN cal
                  ON d >= f AND d <= DATE '2024-01-30' AND isodow(d) < 6),
     miss AS (SELECT e.*, k - row_number() OVER (PARTITION BY e.entity ORDER BY d) AS g FROM expected e
              WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.entity = e.entity AND b.day = e.d))
SELECT entity, min(d) AS gap_start, max(d) AS gap_end, CAST(count(*) AS BIGINT) AS weekdays FROM miss GROUP BY entity, g
""", ("bars",))
def gap_islands(spark, sf):
    return C.gap_islands(bars(spark, sf).select("entity", "day"), ["entity"], "day", day("2024-01-30"))


@query("gap_since_last", """
SELECT d AS date FROM (SELECT DATE '2024-01-01' + CAST(i AS INTEGER) AS d FROM range(0, 60) r(i))
WHERE isodow(d) < 6 AND d NOT IN (DATE '2024-01-01', DATE '2024-01-15')
  AND d > (SELECT max(day) FROM bars) AND d <= DATE '2024-02-19'
""", ("bars",))
def gap_since_last(spark, sf):
    days = C.day_range(spark, "2024-01-01", "2024-02-29")
    holidays = spark.createDataFrame(list(_HOLIDAYS), "d string, name string").select(
        F.to_date("d").alias("date"), "name")
    status = C.session_status(days, holidays, days.select(F.year("date").alias("year")))
    return C.gap_since_last(bars(spark, sf).select(F.col("day").alias("date")), status, day("2024-02-20"))


@query("missing_months", """
WITH months AS (SELECT strftime(DATE '1995-01-01' + to_months(CAST(i AS INTEGER)), '%Y%m') AS key FROM range(0, 96) r(i))
SELECT key FROM months WHERE key NOT IN (SELECT strftime(o_orderdate, '%Y%m') FROM orders WHERE o_orderstatus = 'F'
  GROUP BY 1 HAVING count(*) >= {n})
""".format(n=60))
def missing_months(spark, sf):
    """Months with at least sixty finished orders count as done."""
    months = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").groupBy(
        F.date_format("o_orderdate", "yyyyMM").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    done = months.select(F.lit("orders").alias("dtype"), "key",
                         F.when(F.col("n") >= 60, "done").otherwise("in_progress").alias("status"))
    return C.missing_months(done, spark, "199501", "200212", "orders")


@query("missing_years", """
SELECT CAST(y AS VARCHAR) AS key FROM range(1990, 2006) r(y) WHERE y NOT IN (SELECT year(o_orderdate) FROM orders)
""")
def missing_years(spark, sf):
    done = table(spark, sf, "orders").select(
        F.lit("orders").alias("dtype"), F.year("o_orderdate").cast("string").alias("key"),
        F.lit("done").alias("status")).distinct()
    return C.missing_years(done, spark, 1990, 2005, "orders")
