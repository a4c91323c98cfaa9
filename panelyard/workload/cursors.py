"""Incremental cursors over the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import cursor as C
from panelyard.session import materialise
from panelyard.workload.base import (
    TODAY, bars, day, sparse_bars, incoming, instruments, markets, named_panel, panel, query, stored, table,
)


@query("sparse_sessions", """
SELECT day, n, u AS universe FROM (
  SELECT day, CAST(count(DISTINCT entity) AS BIGINT) AS n,
         (SELECT CAST(count(DISTINCT entity) AS BIGINT) FROM sparse_bars) AS u FROM sparse_bars GROUP BY day)
WHERE n < u * 35 / 100.0
""", ("sparse_bars",))
def sparse_sessions(spark, sf):
    return C.sparse_dates(sparse_bars(spark, sf), "entity", "day", 35.0)


@query("sparse_excluded", """
SELECT day, CAST(count(*) AS BIGINT) AS "rows" FROM sparse_bars
WHERE day NOT IN (SELECT day FROM sparse_bars GROUP BY day
                  HAVING count(DISTINCT entity) < (SELECT count(DISTINCT entity) FROM sparse_bars) * 35 / 100.0)
GROUP BY day
""", ("sparse_bars",))
def sparse_excluded(spark, sf):
    from panelyard.operators.rows import exclude_dates
    rows = sparse_bars(spark, sf)
    kept = exclude_dates(rows, C.sparse_dates(rows, "entity", "day", 35.0), "day")
    return kept.groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


@query("lookback_start", "SELECT entity, max(day) - 6 AS start FROM stored GROUP BY entity", ("stored",))
def lookback_start(spark, sf):
    return stored(spark, sf).groupBy("entity").agg(C.lookback_start(F.max("day")).alias("start"))


_CURSOR = """
WITH feed AS ({feed}),
     required AS ({required}), failed AS ({failed}),
     per AS (SELECT entity, count(*) AS n, count(DISTINCT day) AS d FROM feed GROUP BY 1),
     known AS (SELECT coalesce(r.entity, p.entity) AS entity, r.entity IS NOT NULL AS required,
                      p.entity IS NOT NULL AS delivered, f.entity IS NOT NULL AS failed, p.n > p.d AS repeated
               FROM required r FULL JOIN per p ON p.entity = r.entity
               LEFT JOIN failed f ON f.entity = coalesce(r.entity, p.entity)),
     good AS (SELECT entity FROM known WHERE required AND delivered AND NOT failed),
     rows AS (SELECT * FROM feed WHERE entity IN (SELECT entity FROM good)),
     axis AS (SELECT market, day, row_number() OVER (PARTITION BY market ORDER BY day) AS pos
              FROM (SELECT DISTINCT market, day FROM rows)),
     spans AS (SELECT r.market, r.entity, max(r.day) AS l, max(pos) - min(pos) + 1 - count(*) AS holes
               FROM (SELECT DISTINCT market, entity, day FROM rows) r JOIN axis a ON a.market = r.market AND a.day = r.day
               GROUP BY 1, 2),
     live AS (SELECT *, max(l) OVER (PARTITION BY market) - l > 3 AS stale FROM spans WHERE holes = 0),
     facts AS (SELECT (SELECT count(*) FROM known WHERE required) AS required,
                      (SELECT count(*) FROM known WHERE delivered) AS delivered,
                      (SELECT count(*) FROM known WHERE delivered AND NOT required) AS unexpected,
                      (SELECT count(*) FROM known WHERE repeated) AS repeated,
                      (SELECT count(*) FROM known WHERE required AND NOT (delivered AND NOT failed)) AS missing,
                      (SELECT count(*) FROM spans WHERE holes > 0) AS holed,
                      (SELECT count(*) FROM live) AS live, (SELECT count(*) FROM live WHERE stale) AS stale,
                      (SELECT min(l) FROM live WHERE NOT stale) AS fresh, (SELECT min(l) FROM live) AS whole),
     reached AS (SELECT *, greatest({previous}, CASE WHEN stale < live THEN fresh ELSE whole END) AS reached,
                 CASE WHEN delivered = 0 THEN 'empty_unverified' WHEN unexpected > 0 THEN 'unexpected_entity'
                      WHEN missing > required * {tolerance} / 100.0 OR missing >= required THEN 'incomplete'
                      WHEN repeated > 0 THEN 'invalid_dates' WHEN live = 0 THEN 'session_unverified' ELSE 'ok' END AS status
                 FROM facts),
     gap AS (SELECT min(day) AS g FROM (SELECT day FROM feed GROUP BY day
               HAVING count(DISTINCT entity) < (SELECT count(DISTINCT entity) FROM feed) * {sparse} / 100.0)
             WHERE day > {previous} AND day <= (SELECT reached FROM reached)),
     held AS (SELECT r.*, g, g IS NOT NULL AND {today} - {previous} <= 7 AS hold FROM reached r, gap)
SELECT status, CASE WHEN status = 'ok' THEN CASE WHEN hold THEN greatest({previous}, g - 1) ELSE reached END END AS cursor,
       CAST(required AS BIGINT) AS required, CAST(delivered AS BIGINT) AS delivered, CAST(missing AS BIGINT) AS missing,
       CAST(holed AS BIGINT) AS holed, CAST(stale AS BIGINT) AS stale, hold AND status = 'ok' AS held, status = 'ok' AS ok
FROM held
"""


def _run(spark, sf, feed, required, failed, previous, tolerance, sparse):
    feed = materialise(feed, "feed")   # the decision reads the feed several times
    required = feed if required is None else required
    return C.completeness_cursor(feed, required, failed, "entity", "day", "market", day(previous), day(TODAY),
                                 tolerance_pct=tolerance, sparse_min_pct=sparse)


@query("cursor", _CURSOR.format(
    feed="SELECT entity, day, market FROM panel", required="SELECT DISTINCT entity FROM panel",
    failed="SELECT entity FROM instruments WHERE market = 'BUILDING'", previous="DATE '2024-01-24'",
    today="DATE '2024-01-30'", tolerance=40, sparse=50), ("panel",))
def cursor(spark, sf):
    feed = panel(spark, sf).select("entity", "day", "market")
    failed = markets(spark, sf).where(F.col("market") == "BUILDING").select("entity")
    return _run(spark, sf, feed, None, failed, "2024-01-24", 40.0, 50.0)


@query("cursor_held", _CURSOR.format(
    feed="SELECT entity, day, market FROM panel", required="SELECT DISTINCT entity FROM panel",
    failed="SELECT entity FROM instruments WHERE market = 'NONE'", previous="DATE '2024-01-24'",
    today="DATE '2024-01-30'", tolerance=5, sparse=92), ("panel",))
def cursor_held(spark, sf):
    feed = panel(spark, sf).select("entity", "day", "market")
    failed = markets(spark, sf).where(F.col("market") == "NONE").select("entity")
    return _run(spark, sf, feed, None, failed, "2024-01-24", 5.0, 92.0)


@query("cursor_refused", _CURSOR.format(
    feed="SELECT entity, day, market FROM sparse_bars JOIN instruments USING (entity)",
    required="SELECT entity FROM instruments", failed="SELECT entity FROM instruments WHERE market = 'NONE'",
    previous="DATE '2024-01-20'", today="DATE '2024-01-30'", tolerance=5, sparse=35), ("sparse_bars", "instruments"))
def cursor_refused(spark, sf):
    names = markets(spark, sf)
    feed = sparse_bars(spark, sf).select("entity", "day").join(names, "entity")
    return _run(spark, sf, feed, names, names.where(F.col("market") == "NONE"), "2024-01-20", 5.0, 35.0)


@query("cursor_entities", """
WITH names AS (SELECT entity FROM instruments WHERE market <> 'MACHINERY'),
     per AS (SELECT entity FROM stored GROUP BY 1)
SELECT coalesce(r.entity, p.entity) AS entity, r.entity IS NOT NULL AS required, p.entity IS NOT NULL AS delivered
FROM names r FULL JOIN per p ON p.entity = r.entity
""", ("stored", "instruments"))
def cursor_entities(spark, sf):
    names = markets(spark, sf)
    feed = stored(spark, sf).join(names.select("entity", "market"), "entity")
    out = C.cursor_entities(feed, names.where(F.col("market") != "MACHINERY"), names.where(F.lit(False)), "entity",
                            "day", "market")
    return out.select("entity", "required", "delivered")


@query("backfill_candidates", """
SELECT i.entity, i.ticker, CASE WHEN p.entity IS NOT NULL THEN 'retry' ELSE 'new' END AS kind FROM instruments i
LEFT JOIN (SELECT DISTINCT entity FROM bars) k ON k.entity = i.entity
LEFT JOIN (SELECT entity FROM bars GROUP BY entity HAVING max(day) < DATE '2024-01-30') p ON p.entity = i.entity
WHERE k.entity IS NULL OR p.entity IS NOT NULL
""", ("bars", "instruments"))
def backfill_candidates(spark, sf):
    rows = bars(spark, sf)
    pending = rows.groupBy("entity").agg(F.max("day").alias("l")).where(F.col("l") < day("2024-01-30"))
    return C.backfill_candidates(instruments(spark, sf).select("entity", "ticker"), rows, pending, "entity")


@query("backfill_audit", """
SELECT f.o_custkey, f.first_date, CASE WHEN c.c_custkey IS NOT NULL THEN 'pending' ELSE 'new' END AS state
FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_date FROM orders GROUP BY 1) f
LEFT JOIN customer c ON c.c_custkey = f.o_custkey AND c.c_acctbal < 0
WHERE f.first_date > DATE '1996-01-01'
""")
def backfill_audit(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    pending = table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return C.backfill_audit(orders, pending, "o_custkey", "day", day("1996-01-01"))


@query("missing_today", """
SELECT entity, coalesce(arg_max(ticker, day), '') AS ticker, coalesce(nullif(arg_max(market, day), ''), 'KOSPI') AS market
FROM panel WHERE entity IN (SELECT entity FROM panel WHERE day >= DATE '2024-01-30' - 7)
  AND entity NOT IN (SELECT entity FROM panel WHERE day = DATE '2024-01-30') GROUP BY entity
""", ("panel",))
def missing_today(spark, sf):
    rows = named_panel(spark, sf).select("entity", "day", "ticker", "market")
    today = rows.where(F.col("day") == day(TODAY))
    return C.missing_today(rows.where(F.col("day") < day(TODAY)), today, "entity", "day", day(TODAY), "ticker",
                           "market")


@query("pending_after", """
SELECT market, kind, ticker FROM (
  SELECT market, 'backfill' AS kind, ticker FROM panel WHERE volume > 3
  UNION SELECT market, 'rebase', ticker FROM panel WHERE close > 200)
EXCEPT SELECT market, 'rebase', ticker FROM panel WHERE close > 300
""", ("panel",))
def pending_after(spark, sf):
    rows = named_panel(spark, sf)

    def as_list(condition, kind):
        return rows.where(condition).select("market", F.lit(kind).alias("kind"), "ticker")

    return C.pending_after(as_list(F.col("volume") > 3, "backfill"), as_list(F.col("close") > 200, "rebase"),
                           as_list(F.col("close") > 300, "rebase"))


@query("advance_state", """
WITH s AS (SELECT market, max(day) AS l, count(DISTINCT entity) AS n, min(day) AS o FROM stored
           JOIN instruments USING (entity) WHERE day < DATE '2024-01-20' AND market <> 'FURNITURE' GROUP BY 1),
     r AS (SELECT market, max(day) AS l, count(DISTINCT entity) AS n, min(day) AS o FROM incoming
           JOIN instruments USING (entity) GROUP BY 1)
SELECT r.market, coalesce(s.l, r.l) AS last_updated, CAST(r.n AS BIGINT) AS ticker_count, least(s.o, r.o) AS oldest_date
FROM r LEFT JOIN s ON s.market = r.market
""", ("stored", "incoming", "instruments"))
def advance_state(spark, sf):
    names = markets(spark, sf)

    def state(rows):
        return rows.join(names, "entity").groupBy("market").agg(
            F.max("day").alias("last_updated"), F.countDistinct("entity").alias("ticker_count"),
            F.min("day").alias("oldest_date"), F.lit(None).cast("timestamp").alias("updated_at"))

    before = state(stored(spark, sf).where(F.col("day") < day("2024-01-20"))).where(F.col("market") != "FURNITURE")
    return C.advance_state(before, state(incoming(spark, sf)), subset=True).drop("updated_at")


@query("accept_prefix", """
WITH v AS (SELECT day, avg(CASE WHEN amount > 20 THEN 1e0 ELSE 0e0 END) >= 0.8 AS ok FROM bars GROUP BY day)
SELECT day FROM v WHERE day < coalesce((SELECT min(day) FROM v WHERE NOT ok), DATE '9999-01-01')
""", ("bars",))
def accept_prefix(spark, sf):
    from panelyard.operators.gates import session_acceptance
    rows = bars(spark, sf).select("day", F.when(F.col("amount") > 20, F.col("amount")).alias("cap"))
    return C.accept_prefix(session_acceptance(rows, "day", "cap", 0.8), "day")


@query("today_only_cap", """
SELECT entity, day, close, CASE WHEN day = DATE '2024-01-30' THEN c_acctbal END AS cap
FROM bars LEFT JOIN customer ON c_custkey = entity
""", ("bars",))
def today_only_cap(spark, sf):
    from panelyard.operators.rows import only_on
    caps = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), "c_acctbal")
    return bars(spark, sf).join(caps, "entity", "left").select(
        "entity", "day", "close", only_on(F.col("day"), day(TODAY), F.col("c_acctbal")).alias("cap"))

