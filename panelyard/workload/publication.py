"""Staged publication of panels, logs and rewrites."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.operators import gates as G
from panelyard.operators import merge as M
from panelyard.operators import settlement as S
from panelyard.plans import publish as P
from panelyard.plans import reports as RP
from panelyard.session import scratch_path
from panelyard.workload.base import KEYS, bars, incoming, official, panel, query, stored, table

_BARS = T.StructType([
    T.StructField("entity", T.LongType()), T.StructField("day", T.DateType()), T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()), T.StructField("amount", T.DoubleType())])
_ORDERS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                        T.StructField("day", T.DateType()), T.StructField("o_totalprice", T.DoubleType())])


@query("publish_roundtrip", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
""")
def publish_roundtrip(spark, sf):
    """Orders staged, checked, published by year, and read back."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"),
                                             "o_totalprice", F.year("o_orderdate").alias("year"))
    target = P.Table(scratch_path(spark, "orders"), _ORDERS, ["o_orderkey"], "year", "zstd")
    P.publish(rows, target)
    return target.read(spark)


@query("publish_upsert", """
SELECT * EXCLUDE (src, rn), CAST(week(day) AS INTEGER) AS week FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, day ORDER BY src DESC) AS rn
  FROM (SELECT *, 0 AS src FROM stored UNION ALL SELECT *, 1 AS src FROM incoming WHERE week(day) >= 3)) WHERE rn = 1
""", ("stored", "incoming"))
def publish_upsert(spark, sf):
    """The feed of the later weeks upserted: only its partitions are rewritten, the others stay."""
    target = P.Table(scratch_path(spark, "weeks"), _BARS, KEYS, "week")
    week = F.weekofyear("day").alias("week")
    P.publish(stored(spark, sf).select("*", week), target)
    feed = incoming(spark, sf).select("*", week).where(F.col("week") >= 3)
    current = target.read(spark)
    merged = M.merge_last(P.touched(current, feed, "week"), feed, KEYS)
    P.publish(merged, target, [("shrink", lambda staged: G.shrink_guard(
        P.touched(current, feed, "week"), staged, "entity", ["week"]))])
    return target.read(spark)


@query("partition_delete", """
SELECT *, CAST(week(day) AS INTEGER) AS week FROM stored WHERE week(day) <> 2
  AND NOT (week(day) = 3 AND dayofweek(day) = 1)
""", ("stored",))
def partition_delete(spark, sf):
    """Every date of one week and one date of another deleted: the emptied partition goes, others are not touched."""
    target = P.Table(scratch_path(spark, "thinned"), _BARS, KEYS, "week")
    P.publish(stored(spark, sf).select("*", F.weekofyear("day").alias("week")), target)
    current = P.pruned(target.read(spark), "week", [2, 3])
    gone = current.where((F.col("week") == 2) | (F.dayofweek("day") == 2)).select("day")
    P.publish(M.delete_rows(current, gone, date="day"), target, partitions=[2, 3])
    return target.read(spark)


@query("refused_publish", """
SELECT *, CAST(week(day) AS INTEGER) AS week FROM stored
""", ("stored",))
def refused_publish(spark, sf):
    """A candidate that loses most entities is refused and the table keeps its old rows."""
    target = P.Table(scratch_path(spark, "kept"), _BARS, KEYS, "week")
    rows = stored(spark, sf).select("*", F.weekofyear("day").alias("week"))
    P.publish(rows, target)
    current = target.read(spark)
    try:
        P.publish(rows.where(F.col("volume") > 6), target, [("shrink", lambda staged: G.shrink_guard(
            current, staged, "entity", ["week"]))])
    except G.GateRefused:
        return target.read(spark)
    raise AssertionError("the gate let a shrinking candidate pass")


@query("settlement_log", """
WITH e AS (SELECT o_orderdate AS t, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey % 4 AS added FROM orders),
     d AS (SELECT year, t, sum(added) AS rows_added FROM e GROUP BY 1, 2)
SELECT year, CAST(t AS DATE) AS day, CAST(rows_added AS BIGINT) AS rows_added FROM d WHERE rows_added > 0
""")
def settlement_log(spark, sf):
    """Daily runs as log entries; every entry that changed something is kept."""
    entries = table(spark, sf, "orders").groupBy(
        F.year("o_orderdate").alias("year"), F.col("o_orderdate").cast("timestamp").alias("at")).agg(
        F.sum(F.col("o_orderkey") % 4).alias("rows_added"), F.lit(0).cast("long").alias("rows_replaced"),
        F.lit(0).cast("long").alias("rows_dropped"))
    empty = entries.where(F.lit(False))
    return P.append_log(empty, entries).select("year", F.to_date("at").alias("day"), "rows_added")


@query("preview_publish", """
SELECT *, CAST(week(day) AS INTEGER) AS week FROM stored
""", ("stored",))
def preview_publish(spark, sf):
    """A candidate judged by the gates of its publication without a table being written."""
    rows = stored(spark, sf).select("*", F.weekofyear("day").alias("week"))
    return P.preview(rows, [("continuity", lambda df: G.coverage_continuity(df, "entity", "day", 100.0, by=["week"]))])


@query("settlement_boundary", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(max(o_orderdate) AS DATE) AS official_through FROM orders GROUP BY 1
""")
def settlement_boundary(spark, sf):
    """One official date a year, set year by year (one of them twice) and read back."""
    rows = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("year"))
    years = P.partition_values(rows, "year")
    through = rows.groupBy("year").agg(F.max("day").alias("official_through"))
    boundary = through.where(F.lit(False))
    early = through.where(F.col("year") == years[0]).select(F.date_sub("official_through", 9).alias("official_through"))
    boundary = P.set_boundary(boundary, years[0], early)
    for year in years:
        boundary = P.set_boundary(boundary, year, through.where(F.col("year") == year))
    found = None
    for year in years:
        one = S.boundary_of(boundary, year).select(F.lit(year).cast("int").alias("year"), "official_through")
        found = one if found is None else found.unionByName(one)
    return found


@query("backfill_report", """
SELECT i.market, b.entity, min(b.day) AS first_date, CASE WHEN max(b.day) < DATE '2024-01-30' THEN 'pending' ELSE 'new' END AS state
FROM bars b JOIN instruments i ON i.entity = b.entity GROUP BY 1, 2 HAVING min(b.day) > DATE '2024-01-01'
""", ("bars", "instruments"))
def backfill_report(spark, sf):
    """Late starters of every market, those already waiting marked."""
    rows = panel(spark, sf)
    waiting = rows.groupBy("entity").agg(F.max("day").alias("last")).where(F.col("last") < F.lit("2024-01-30").cast("date"))
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    panels = {m: (rows.where(F.col("market") == m), waiting) for m in names}
    return RP.backfill_report(panels, "entity", "day", F.lit("2024-01-01").cast("date"))


@query("rewrite_report", """
WITH b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n FROM lineitem GROUP BY 1),
     d AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate FROM lineitem),
     a AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, count(DISTINCT l_partkey) AS e, max(l_shipdate) AS m FROM d GROUP BY 1),
     c AS (SELECT CAST(l_shipdate AS DATE) AS day, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1),
     p AS (SELECT CAST(year(day) AS INTEGER) AS year, n, lag(n) OVER (PARTITION BY year(day) ORDER BY day) AS n_prev FROM c),
     bad AS (SELECT year, CAST(count(*) FILTER (n_prev >= 100 AND (n - n_prev) * 100.0 / n_prev <= -10) AS BIGINT) AS bad FROM p GROUP BY 1)
SELECT b.year, CAST(b.n AS BIGINT) AS rows_before, CAST(a.n AS BIGINT) AS rows_after, CAST(a.e AS BIGINT) AS entities, CAST(a.m AS DATE) AS last_date,
       bad AS bad_before, bad AS bad_after, bad = 0 AS ok
FROM b JOIN a ON a.year = b.year JOIN bad ON bad.year = b.year
""")
def rewrite_report(spark, sf):
    """Every partition passed through the current rules, counted before and after."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "day"]
    before = table(spark, sf, "lineitem").withColumn("day", F.to_date("l_shipdate")).select(*keys)
    after = before.dropDuplicates(keys)
    return RP.rewrite_report(before, after, "l_partkey", "day")


@query("coverage_metrics", """
SELECT day, n, n_prev AS baseline, CAST(n AS DOUBLE) * 100 / n_prev AS ratio_pct FROM (
  SELECT day, n, lag(n) OVER (ORDER BY day) AS n_prev FROM (
    SELECT day, CAST(count(DISTINCT entity) AS BIGINT) AS n FROM official GROUP BY day))
""", ("official",))
def coverage_metrics(spark, sf):
    daily = G.coverage_continuity(official(spark, sf), "entity", "day")
    return RP.coverage_metrics(daily.withColumnRenamed("n_prev", "baseline"), "day")


@query("year_report", """
WITH y AS (SELECT CAST(year(day) AS INTEGER) AS year, count(*) AS n, count(DISTINCT day) AS s, min(day) AS f, max(day) AS l,
                  count(DISTINCT entity) AS e FROM bars GROUP BY 1)
SELECT year, CAST(n AS BIGINT) AS "rows", CAST(s AS BIGINT) AS sessions, f AS first_date, l AS last_date, CAST(e AS BIGINT) AS entities,
       CAST(0 AS BIGINT) AS gaps, CAST(0 AS BIGINT) AS missing_weekdays FROM y
""", ("bars",))
def year_report(spark, sf):
    return RP.year_report(bars(spark, sf), "entity", "day", F.lit("2024-01-30").cast("date"))


@query("year_report_orders", """
WITH d AS (SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) + CAST(o_orderkey % 3 * 2 AS INTEGER) AS day FROM orders),
     y AS (SELECT CAST(year(day) AS INTEGER) AS year, min(day) AS f, max(day) AS l, count(*) AS s FROM d GROUP BY 1),
     cal AS (SELECT DATE '1994-01-01' + CAST(i AS INTEGER) AS c FROM range(0, 3400) r(i)),
     e AS (SELECT year, c, row_number() OVER (PARTITION BY year ORDER BY c) AS k FROM y JOIN cal
           ON c >= f AND c <= least(make_date(year, 12, 31), DATE '2001-06-30') AND isodow(c) < 6),
     m AS (SELECT year, c, k - row_number() OVER (PARTITION BY year ORDER BY c) AS g FROM e WHERE c NOT IN (SELECT day FROM d)),
     g AS (SELECT year, count(DISTINCT g) AS gaps, count(*) AS missing FROM m GROUP BY 1)
SELECT y.year, CAST(y.s AS BIGINT) AS sessions, CAST(coalesce(g.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(g.missing, 0) AS BIGINT) AS missing_weekdays
FROM y LEFT JOIN g ON g.year = y.year
""")
def year_report_orders(spark, sf):
    """Orders moved to the Monday, Wednesday or Friday of their week as sessions: gaps per year against weekdays."""
    shift = (F.col("o_orderkey") % 3 * 2).cast("int")
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.date_add(
        F.trunc("o_orderdate", "week"), shift).alias("day"))
    out = RP.year_report(rows, "entity", "day", F.lit("2001-06-30").cast("date"))
    return out.select("year", "sessions", "gaps", "missing_weekdays")
