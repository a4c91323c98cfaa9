"""Grouped summaries of the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import aggregates as A
from panelyard.workload.base import bars, sparse_bars, incoming, markets, named_panel, query, stored, table


@query("session_counts", """
SELECT day, CAST(count(DISTINCT entity) AS BIGINT) AS n FROM bars GROUP BY day
""", ("bars",))
def session_counts(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").alias("entity"), F.to_date("ts").alias("day"))
    return A.session_counts(events, "entity", "day")


@query("known_entities", "SELECT DISTINCT o_custkey FROM orders")
def known_entities(spark, sf):
    return A.known_entities(table(spark, sf, "orders"), "o_custkey")


@query("first_seen", "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_date FROM orders GROUP BY o_custkey")
def first_seen(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return A.first_seen(orders, "o_custkey", "day")


@query("last_date_by_year", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(max(l_shipdate) AS DATE) AS last_date FROM lineitem GROUP BY 1
""")
def last_date_by_year(spark, sf):
    items = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), F.to_date("l_shipdate").alias("day"))
    return A.last_date(items, "day", ["year"])


@query("entity_count_exempt", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1
""")
def entity_count_exempt(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_custkey")
    exempt = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return A.entity_count(orders, "o_custkey", exempt, ["year"])


@query("year_summary", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS "rows",
       CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) AS sessions,
       CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
       CAST(count(DISTINCT o_custkey) AS BIGINT) AS entities
FROM orders GROUP BY 1
""")
def year_summary(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return A.year_summary(orders, "o_custkey", "day")


@query("last_seen", """
SELECT entity, max(day) AS last_date, arg_max(close, day) AS close, arg_max(volume, day) AS volume
FROM bars GROUP BY entity
""", ("bars",))
def last_seen(spark, sf):
    return A.last_observation(bars(spark, sf), "entity", "day", ["close", "volume"])


@query("latest_names", """
SELECT entity, coalesce(arg_max(ticker, day), '') AS ticker,
       coalesce(nullif(arg_max(CASE WHEN market = 'BUILDING' THEN '' ELSE market END, day), ''), 'KOSPI') AS market
FROM panel GROUP BY entity
""", ("panel",))
def latest_names(spark, sf):
    rows = named_panel(spark, sf).withColumn("market", F.when(F.col("market") == "BUILDING", "").otherwise(F.col("market")))
    return A.latest_names(rows, "entity", "day", "ticker", "market")


@query("shifted_share", """
SELECT o.day, CAST(sum(CASE WHEN abs(n.close / o.close - 1) * 100 >= 5 THEN 1 ELSE 0 END) AS DOUBLE) * 100
       / count(*) AS pct
FROM stored o JOIN incoming n ON o.entity = n.entity AND o.day = n.day WHERE o.close > 0 GROUP BY o.day
""", ("stored", "incoming"))
def shifted_share(spark, sf):
    both = stored(spark, sf).select("entity", "day", "close").join(
        incoming(spark, sf).select("entity", "day", F.col("close").alias("new")), ["entity", "day"])
    moved = F.when(F.col("close") > 0, F.abs(F.col("new") / F.col("close") - 1) * 100 >= 5)
    return both.where(F.col("close") > 0).groupBy("day").agg(A.share(moved).alias("pct"))


@query("all_within_tolerance", """
SELECT o.entity, bool_and(abs(n.close - o.close) <= 150) AS within, CAST(count(*) AS BIGINT) AS overlap
FROM stored o JOIN incoming n ON o.entity = n.entity AND o.day = n.day GROUP BY o.entity
""", ("stored", "incoming"))
def all_within_tolerance(spark, sf):
    both = stored(spark, sf).select("entity", "day", "close").join(
        incoming(spark, sf).select("entity", "day", F.col("close").alias("new")), ["entity", "day"])
    return A.all_within(both, "entity", F.abs(F.col("new") - F.col("close")), F.lit(150.0))


@query("difference_counts", """
SELECT """ + ", ".join(
    f"CAST(sum(CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
    for c in ("open", "high", "low", "close", "volume")) + """
FROM stored o JOIN incoming n ON o.entity = n.entity AND o.day = n.day
""", ("stored", "incoming"))
def difference_counts(spark, sf):
    both = stored(spark, sf).alias("o").join(incoming(spark, sf).alias("n"), ["entity", "day"])
    return A.difference_counts(both, ["open", "high", "low", "close", "volume"], "o", "n")


@query("duplicate_keys", """
SELECT l_returnflag, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM (
  SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1
""")
def duplicate_keys(spark, sf):
    return A.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query("corporate_actions", """
SELECT l_partkey, bool_or(l_discount <> 0 OR l_tax NOT IN (0, 1)) AS action, bool_and(l_returnflag <> 'N') AS complete
FROM lineitem GROUP BY l_partkey
""")
def corporate_actions(spark, sf):
    """Discounts stand for dividends, tax for splits; evidence is missing on lines flagged 'N'."""
    items = table(spark, sf, "lineitem").select(
        "l_partkey", "l_discount", "l_tax", F.when(F.col("l_returnflag") != "N", 0.0).alias("gains"))
    return A.corporate_actions(items, "l_partkey", "l_discount", "l_tax", "gains")


@query("checkpoint_summary", """
SELECT o_orderpriority AS dtype, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS done,
       CAST(count(*) AS BIGINT) AS total FROM orders GROUP BY 1
""")
def checkpoint_summary(spark, sf):
    orders = table(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "done").otherwise("in_progress")
    return A.checkpoint_summary(orders.select(F.col("o_orderpriority").alias("dtype"), status.alias("status")))


@query("failure_rate", """
SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(CASE WHEN e.entity IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS failed,
       count(*) = 0 OR sum(CASE WHEN e.entity IS NULL THEN 1 ELSE 0 END) < count(*) * 0.9 AS ok
FROM instruments i LEFT JOIN (SELECT DISTINCT entity FROM sparse_bars) e ON e.entity = i.entity
""", ("sparse_bars", "instruments"))
def failure_rate(spark, sf):
    seen = sparse_bars(spark, sf).select("entity").distinct().withColumn("_seen", F.lit(True))
    return A.failure_rate(markets(spark, sf).join(seen, "entity", "left"), F.col("_seen").isNull())
