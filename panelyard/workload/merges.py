"""Merge policies over the stored panel and the incoming feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import merge as M
from panelyard.workload.base import KEYS, VALUES, bars, sparse_bars, incoming, instruments, markets, query, stored, table

_CELLS = ", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in VALUES)


@query("merge_last", """
SELECT * EXCLUDE (src, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, day ORDER BY src DESC) AS rn
  FROM (SELECT *, 0 AS src FROM stored UNION ALL SELECT *, 1 AS src FROM incoming)) WHERE rn = 1
""", ("stored", "incoming"))
def merge_last(spark, sf):
    return M.merge_last(stored(spark, sf), incoming(spark, sf), KEYS)


def _thin(df, column, condition):
    """The frame with one column missing where the condition holds."""
    return df.withColumn(column, F.when(~condition, F.col(column)))


@query("merge_coalesce", """
WITH feed AS (SELECT entity, day, open, CASE WHEN volume > 1 THEN high END AS high, low,
                     CASE WHEN close >= open THEN close END AS close, volume, amount FROM incoming)
SELECT coalesce(n.entity, o.entity) AS entity, coalesce(n.day, o.day) AS day, """ + _CELLS + """
FROM stored o FULL JOIN feed n ON o.entity = n.entity AND o.day = n.day
""", ("stored", "incoming"))
def merge_coalesce(spark, sf):
    feed = _thin(_thin(incoming(spark, sf), "high", F.col("volume") <= 1), "close", F.col("close") < F.col("open"))
    return M.merge_coalesce(stored(spark, sf), feed, KEYS)


_POLICY = {"amount": M.KEEP_IF_NULL_OR_ZERO, "volume": M.KEEP_IF_NULL, "low": M.STORED_FIRST}


@query("merge_policy", """
WITH feed AS (SELECT entity, day, open, CASE WHEN close >= open THEN high END AS high, low, close,
                     CASE WHEN volume > 1 THEN volume END AS volume,
                     CASE WHEN volume = 1 THEN 0 WHEN close < open THEN NULL ELSE amount END AS amount FROM incoming)
SELECT coalesce(n.entity, o.entity) AS entity, coalesce(n.day, o.day) AS day,
       CASE WHEN n.entity IS NULL THEN o.open ELSE n.open END AS open,
       CASE WHEN n.entity IS NULL THEN o.high ELSE n.high END AS high,
       coalesce(o.low, n.low) AS low,
       CASE WHEN n.entity IS NULL THEN o.close ELSE n.close END AS close,
       coalesce(n.volume, o.volume) AS volume,
       CASE WHEN o.entity IS NULL THEN n.amount WHEN n.amount IS NULL OR n.amount = 0 THEN o.amount
            ELSE n.amount END AS amount
FROM stored o FULL JOIN feed n ON o.entity = n.entity AND o.day = n.day
""", ("stored", "incoming"))
def merge_policy(spark, sf):
    feed = _thin(incoming(spark, sf), "high", F.col("close") < F.col("open"))
    amount = F.when(F.col("volume") == 1, 0.0).when(F.col("close") >= F.col("open"), F.col("amount"))
    feed = feed.withColumn("amount", amount)
    feed = _thin(feed, "volume", F.col("volume") <= 1)
    return M.merge_policy(stored(spark, sf), feed, KEYS, _POLICY)


@query("preserve_measure", """
WITH feed AS (SELECT entity, day, close, CASE WHEN volume = 1 THEN 0 WHEN close < open THEN NULL
                     ELSE amount END AS amount FROM incoming)
SELECT f.entity, f.day, f.close, coalesce(f.amount, CASE WHEN o.amount >= 0 THEN o.amount END) AS amount
FROM feed f LEFT JOIN stored o ON o.entity = f.entity AND o.day = f.day
""", ("stored", "incoming"))
def preserve_measure(spark, sf):
    amount = F.when(F.col("volume") == 1, 0.0).when(F.col("close") >= F.col("open"), F.col("amount"))
    feed = incoming(spark, sf).select(*KEYS, "close", amount.alias("amount"))
    return M.preserve_measure(stored(spark, sf), feed, KEYS, "amount")


@query("replace_subset", """
WITH targets AS (SELECT entity FROM instruments WHERE market = 'MACHINERY'),
     kept AS (SELECT * FROM stored WHERE entity NOT IN (SELECT entity FROM targets))
SELECT entity, day, open, high, low, close, volume, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, day ORDER BY src DESC) AS rn
  FROM (SELECT *, 0 AS src FROM kept UNION ALL SELECT *, 1 AS src FROM incoming)) WHERE rn = 1
""", ("stored", "incoming", "instruments"))
def replace_subset(spark, sf):
    targets = markets(spark, sf).where(F.col("market") == "MACHINERY").select("entity")
    return M.replace_entities(stored(spark, sf), incoming(spark, sf), targets, KEYS, "entity", measure="amount")


@query("latest_by", """
WITH a AS (SELECT entity, day AS seen, close FROM (SELECT *, row_number() OVER (
             PARTITION BY entity ORDER BY day DESC) AS rn FROM stored) WHERE rn = 1),
     b AS (SELECT entity, day AS seen, close FROM (SELECT *, row_number() OVER (
             PARTITION BY entity ORDER BY day DESC) AS rn FROM incoming) WHERE rn = 1)
SELECT entity, seen, close FROM (
  SELECT *, row_number() OVER (PARTITION BY entity ORDER BY seen DESC, src DESC) AS rn
  FROM (SELECT *, 0 AS src FROM a UNION ALL SELECT *, 1 AS src FROM b)) WHERE rn = 1
""", ("stored", "incoming"))
def latest_by(spark, sf):
    parts = [M.keep_one(df, ["entity"], [F.col("day").desc()]).select("entity", F.col("day").alias("seen"), "close")
             for df in (stored(spark, sf), incoming(spark, sf))]
    return M.latest_by(parts, ["entity"], "seen")


@query("preserve_failed_fields", """
WITH prior AS (SELECT c_custkey AS entity, c_mktsegment AS sector, CAST(c_nationkey AS VARCHAR) AS industry,
                      '2024-01-01T00:00:00' AS updated_at FROM customer WHERE c_acctbal >= 1000),
     fresh AS (SELECT c_custkey AS entity, CASE WHEN c_acctbal < 2000 THEN '' ELSE lower(c_mktsegment) END AS sector,
                      CASE WHEN c_acctbal < 3000 THEN '' ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS industry,
                      '2024-02-01T00:00:00' AS updated_at, c_acctbal FROM customer)
SELECT f.entity,
       CASE WHEN f.c_acctbal < 2000 THEN coalesce(p.sector, '') ELSE f.sector END AS sector,
       CASE WHEN f.c_acctbal < 3000 THEN coalesce(p.industry, '') ELSE f.industry END AS industry,
       CASE WHEN f.c_acctbal < 3000 AND p.entity IS NOT NULL THEN p.updated_at ELSE f.updated_at END AS updated_at
FROM fresh f LEFT JOIN prior p ON p.entity = f.entity
""")
def preserve_failed_fields(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), "c_mktsegment", "c_acctbal",
                                            F.col("c_nationkey").cast("string").alias("nation"))
    prior = c.where(F.col("c_acctbal") >= 1000).select(
        "entity", F.col("c_mktsegment").alias("sector"), F.col("nation").alias("industry"),
        F.lit("2024-01-01T00:00:00").alias("updated_at"))
    no_sector, no_industry = F.col("c_acctbal") < 2000, F.col("c_acctbal") < 3000
    fresh = c.select("entity", F.when(no_sector, "").otherwise(F.lower("c_mktsegment")).alias("sector"),
                     F.when(no_industry, "").otherwise(F.concat(F.lit("N"), "nation")).alias("industry"),
                     F.lit("2024-02-01T00:00:00").alias("updated_at"))
    failures = c.where(no_industry).select("entity", F.array_compact(F.array(
        F.when(no_sector, F.lit("sector")), F.lit("industry"))).alias("fields"))
    return M.preserve_failed_fields(fresh, prior, failures, "entity", ["sector", "industry"])


@query("source_priority", """
SELECT * EXCLUDE (src, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, day ORDER BY src) AS rn
  FROM (SELECT *, 0 AS src FROM stored UNION ALL SELECT *, 1 AS src FROM incoming)) WHERE rn = 1
""", ("stored", "incoming"))
def source_priority(spark, sf):
    return M.first_source([stored(spark, sf), incoming(spark, sf)], KEYS)


@query("delete_rows", """
SELECT b.* FROM bars b
WHERE dayofweek(b.day) NOT IN (0, 6)
  AND NOT EXISTS (SELECT 1 FROM sparse_bars e WHERE e.entity = b.entity AND e.day = b.day)
""", ("bars", "sparse_bars"))
def delete_rows(spark, sf):
    panel = bars(spark, sf)
    weekends = panel.where(F.weekday("day") >= 5).select("day")
    return M.delete_rows(panel, weekends, sparse_bars(spark, sf), "day", KEYS)


@query("pending_union", """
SELECT market, CAST(count(*) AS BIGINT) AS pending FROM (
  SELECT market, ticker FROM instruments JOIN stored USING (entity)
  UNION SELECT market, ticker FROM instruments JOIN incoming USING (entity)) GROUP BY market
""", ("stored", "incoming", "instruments"))
def pending_union(spark, sf):
    names = instruments(spark, sf)
    lists = [df.join(names, "entity").select("market", "ticker") for df in (stored(spark, sf), incoming(spark, sf))]
    return M.union_sets(*lists).groupBy("market").agg(F.count(F.lit(1)).alias("pending"))


_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]


@query("feed_dedup", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day, l_partkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """
       + ", ".join(f"{c} DESC" for c in _LINE_ORDER) + """) AS rn FROM lineitem) WHERE rn = 1
""")
def feed_dedup(spark, sf):
    kept = M.dedup_feed(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in _LINE_ORDER])
    return kept.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_day"), "l_partkey",
                       "l_extendedprice")


@query("lost_keys", """
SELECT entity, day FROM stored EXCEPT SELECT entity, day FROM incoming
""", ("stored", "incoming"))
def lost_keys(spark, sf):
    """Keys an overwrite by the feed alone would lose."""
    return M.lost_keys(stored(spark, sf), incoming(spark, sf), KEYS)
