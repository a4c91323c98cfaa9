"""Join shapes of the panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelyard.operators.ordered import asof_join
from panelyard.workload.base import KEYS, bars, incoming, markets, named_panel, official, query, stored, table


@query("overlap_join", """
SELECT s.entity, s.day, s.close AS stored_close, n.close AS incoming_close
FROM stored s JOIN incoming n ON n.entity = s.entity AND n.day = s.day
""", ("stored", "incoming"))
def overlap_join(spark, sf):
    return stored(spark, sf).select(*KEYS, F.col("close").alias("stored_close")).join(
        incoming(spark, sf).select(*KEYS, F.col("close").alias("incoming_close")), KEYS)


@query("settle_join", """
SELECT o.entity, o.day, o.close AS official_close, s.close AS stored_close FROM official o
LEFT JOIN stored s ON s.entity = o.entity AND s.day = o.day
""", ("official", "stored"))
def settle_join(spark, sf):
    return official(spark, sf).select(*KEYS, F.col("close").alias("official_close")).join(
        stored(spark, sf).select(*KEYS, F.col("close").alias("stored_close")), KEYS, "left")


@query("presence_join", """
SELECT coalesce(o.entity, s.entity) AS entity, coalesce(o.day, s.day) AS day,
       CASE WHEN s.entity IS NULL THEN 'missing' WHEN o.entity IS NULL THEN 'extra' ELSE 'both' END AS side
FROM official o FULL JOIN stored s ON s.entity = o.entity AND s.day = o.day
""", ("official", "stored"))
def presence_join(spark, sf):
    a = official(spark, sf).select(*KEYS, F.lit(True).alias("_o"))
    b = stored(spark, sf).select(*KEYS, F.lit(True).alias("_s"))
    side = F.when(F.col("_s").isNull(), "missing").when(F.col("_o").isNull(), "extra").otherwise("both")
    return a.join(b, KEYS, "full").select(*KEYS, side.alias("side"))


@query("official_dates", "SELECT entity, day, close FROM stored WHERE day IN (SELECT day FROM official)",
       ("official", "stored"))
def official_dates(spark, sf):
    return stored(spark, sf).join(official(spark, sf).select("day").distinct(), "day", "left_semi").select(
        *KEYS, "close")


@query("stored_only", """
SELECT s.entity, s.day FROM incoming s WHERE NOT EXISTS (
  SELECT 1 FROM stored o WHERE o.entity = s.entity AND o.day = s.day)
""", ("incoming", "stored"))
def stored_only(spark, sf):
    return incoming(spark, sf).select(*KEYS).join(stored(spark, sf).select(*KEYS), KEYS, "left_anti")


@query("previous_session", """
WITH d AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM (SELECT DISTINCT day FROM bars))
SELECT b.entity, b.day, d.prev AS previous, b.close, p.close AS previous_close
FROM bars b JOIN d ON d.day = b.day JOIN bars p ON p.entity = b.entity AND p.day = d.prev
""", ("bars",))
def previous_session(spark, sf):
    """Rows beside the same entity's row of the latest earlier session of the whole panel."""
    rows = bars(spark, sf).select(*KEYS, "close")
    dates = rows.select("day").distinct().withColumn("previous", F.lag("day").over(Window.orderBy("day")))
    past = rows.select("entity", F.col("day").alias("previous"), F.col("close").alias("previous_close"))
    return rows.join(dates, "day").join(past, ["entity", "previous"])


@query("dimension_lookup", """
SELECT p.entity, p.day, p.market, p.region, p.ticker, c.c_acctbal AS cap FROM panel p
LEFT JOIN customer c ON c.c_custkey = p.entity
""", ("panel",))
def dimension_lookup(spark, sf):
    caps = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_acctbal").alias("cap"))
    return named_panel(spark, sf).join(caps, "entity", "left").select(
        *KEYS, "market", "region", "ticker", "cap")


@query("unsettled_rows", """
SELECT b.entity, b.day, b.close FROM bars b JOIN (SELECT entity, max(day) AS l FROM stored GROUP BY 1) m
ON m.entity = b.entity WHERE b.day >= least(DATE '2024-01-28', m.l) - 1
""", ("bars", "stored"))
def unsettled_rows(spark, sf):
    """Rows exempt from the basis check: from one day before the earlier of as-of and last stored date."""
    last = stored(spark, sf).groupBy("entity").agg(F.max("day").alias("l"))
    limit = F.date_sub(F.least(F.lit("2024-01-28").cast("date"), F.col("l")), 1)
    return bars(spark, sf).join(last, "entity").where(F.col("day") >= limit).select(*KEYS, "close")


@query("flagship", """
WITH merged AS (SELECT * EXCLUDE (src, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, day ORDER BY src DESC) AS rn
  FROM (SELECT *, 0 AS src FROM stored UNION ALL SELECT *, 1 AS src FROM incoming)) WHERE rn = 1)
SELECT entity, day, market, close, volume, close - lag(close) OVER w AS changes,
       CASE WHEN lag(close) OVER w <> 0 THEN (close / lag(close) OVER w - 1) * 100 END AS changes_ratio,
       rank() OVER (PARTITION BY day, market ORDER BY volume DESC) AS rank
FROM merged JOIN instruments USING (entity) WINDOW w AS (PARTITION BY entity ORDER BY day)
""", ("stored", "incoming", "instruments"))
def flagship(spark, sf):
    """A late batch merged into the panel, day-over-day change, volume rank within the market."""
    from panelyard.operators.merge import merge_last
    from panelyard.operators.ordered import rank_within, with_changes
    merged = merge_last(stored(spark, sf), incoming(spark, sf), KEYS).join(markets(spark, sf), "entity")
    changed = with_changes(merged.select(*KEYS, "market", "close", "volume"), "entity", "day", "close")
    return rank_within(changed, ["day", "market"], "volume", cut=True)


@query("asof_orders", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey % 20 AS g, l_shipdate AS at FROM lineitem),
     o AS (SELECT o_custkey % 20 AS g, CAST(o_orderdate AS TIMESTAMP) AS at, max(o_totalprice) AS price FROM orders GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.g, CAST(l.at AS DATE) AS day, CAST(o.at AS DATE) AS order_day, o.price AS price
FROM l ASOF LEFT JOIN o ON l.g = o.g AND l.at >= o.at
""")
def asof_orders(spark, sf):
    """Every line beside the newest order of its group up to its day; groups are cut into ranges of time."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 20).alias("g"),
                                                F.col("l_shipdate").cast("timestamp").alias("at"))
    orders = table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("g"), F.col("o_orderdate").cast("timestamp").alias("at"),
                                               F.col("o_totalprice").alias("price"))
    out = asof_join(lines, orders, "g", "at", ["price"], block_rows=2_000)
    return out.select("l_orderkey", "l_linenumber", "g", F.to_date("at").alias("day"), F.to_date("at_asof").alias("order_day"),
                      F.col("price_asof").alias("price"))
