"""Quality gates over the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import gates as G
from panelyard.operators import merge as M
from panelyard.operators.calendar import session_status
from panelyard.workload.base import (
    KEYS, PRICES, bars, day, incoming, instruments, markets, official, query, stored, table,
)


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))


@query("shrink_guard", """
WITH n AS (SELECT year(o_orderdate) AS y, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1),
     x AS (SELECT year(o_orderdate) AS y, count(DISTINCT o_custkey) AS n FROM orders
           WHERE o_orderstatus <> 'P' AND o_totalprice > 20000 GROUP BY 1)
SELECT CAST(n.y AS INTEGER) AS year, CAST(n.n AS BIGINT) AS before_n, CAST(coalesce(x.n, 0) AS BIGINT) AS after_n,
       coalesce(x.n, 0) >= n.n * 0.95 AS ok
FROM n LEFT JOIN x ON x.y = n.y
""")
def shrink_guard(spark, sf):
    kept = table(spark, sf, "orders").where((F.col("o_orderstatus") != "P") & (F.col("o_totalprice") > 20000))
    after = kept.select("o_custkey", F.year("o_orderdate").alias("year"))
    return G.shrink_guard(_orders(spark, sf), after, "o_custkey", ["year"])


@query("shrink_guard_total", """
SELECT CAST(b.n AS BIGINT) AS before_n, CAST(a.n AS BIGINT) AS after_n, a.n >= b.n * 0.95 AS ok
FROM (SELECT count(DISTINCT o_custkey) AS n FROM orders) b,
     (SELECT count(DISTINCT o_custkey) AS n FROM orders WHERE year(o_orderdate) = 2001) a
""")
def shrink_guard_total(spark, sf):
    everything = _orders(spark, sf)
    return G.shrink_guard(everything, everything.where(F.col("year") == 2001), "o_custkey")


_CONTINUITY = """
SELECT day, n, n_prev, CAST(n - n_prev AS DOUBLE) * 100 / n_prev AS pct,
       coalesce(n_prev >= 100, false) AS judged,
       NOT coalesce(n_prev >= 100 AND CAST(n - n_prev AS DOUBLE) * 100 / n_prev <= -5, false) AS ok
FROM (SELECT day, n, lag(n) OVER (ORDER BY day) AS n_prev FROM (
  SELECT day, CAST(count(DISTINCT entity) AS BIGINT) AS n FROM bars {where} GROUP BY day))
"""


@query("continuity_by_year", """
SELECT year, day, n, n_prev, CAST(n - n_prev AS DOUBLE) * 100 / n_prev AS pct, coalesce(n_prev >= 5, false) AS judged,
       NOT coalesce(n_prev >= 5 AND CAST(n - n_prev AS DOUBLE) * 100 / n_prev <= -10, false) AS ok
FROM (SELECT year, day, n, lag(n) OVER (PARTITION BY year ORDER BY day) AS n_prev FROM (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderdate AS DATE) AS day,
         CAST(count(DISTINCT o_custkey) AS BIGINT) AS n FROM orders GROUP BY 1, 2))
""")
def continuity_by_year(spark, sf):
    """Every year is a series of its own: a year with a smaller universe does not refuse the next."""
    rows = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"),
                                             F.year("o_orderdate").alias("year"))
    return G.coverage_continuity(rows, "o_custkey", "day", min_universe=5, by=["year"])


@query("coverage_continuity", _CONTINUITY.format(where=""), ("bars",))
def coverage_continuity(spark, sf):
    return G.coverage_continuity(bars(spark, sf), "entity", "day", drop_pct=5.0)


@query("coverage_continuity_subset", _CONTINUITY.format(where="WHERE day IN (SELECT day FROM official)"),
       ("bars", "official"))
def coverage_continuity_subset(spark, sf):
    return G.coverage_continuity(bars(spark, sf), "entity", "day", drop_pct=5.0, only_dates=official(spark, sf))


_COVERAGE = """
WITH base AS (SELECT day, count(DISTINCT entity) AS n FROM {existing} GROUP BY day),
     targets AS ({targets}),
     usable AS (SELECT * FROM base WHERE day NOT IN (SELECT day FROM targets)),
     before AS (SELECT t.day, u.n, row_number() OVER (PARTITION BY t.day ORDER BY u.day DESC) AS k
                FROM targets t JOIN usable u ON u.day < t.day),
     later AS (SELECT t.day, u.n, row_number() OVER (PARTITION BY t.day ORDER BY u.day) AS k
               FROM targets t JOIN usable u ON u.day > t.day),
     b AS (SELECT day, median(n) AS m FROM before WHERE k <= 5 GROUP BY day),
     a AS (SELECT day, median(n) AS m FROM later WHERE k <= 5 GROUP BY day),
     j AS (SELECT t.day, CAST(coalesce(c.n, 0) AS BIGINT) AS n, CAST(coalesce(b.m, a.m) AS DOUBLE) AS baseline
           FROM targets t LEFT JOIN (SELECT day, count(DISTINCT entity) AS n FROM {merged} GROUP BY day) c ON c.day = t.day
           LEFT JOIN b ON b.day = t.day LEFT JOIN a ON a.day = t.day)
SELECT day, n, baseline, CAST(n AS DOUBLE) * 100 / baseline AS ratio_pct, baseline IS NOT NULL AS verified,
       coalesce(baseline >= 10, false) AS judged,
       NOT coalesce(baseline >= 10 AND n * 100 < baseline * {keep}, false) AS ok FROM j
"""


@query("write_coverage", _COVERAGE.format(
    existing="stored", merged="bars", keep=102,
    targets="SELECT DISTINCT day FROM incoming WHERE dayofweek(day) BETWEEN 2 AND 4"), ("bars", "stored", "incoming"))
def write_coverage(spark, sf):
    merged = M.merge_last(stored(spark, sf), incoming(spark, sf), KEYS)
    targets = incoming(spark, sf).where(F.dayofweek("day").between(3, 5)).select("day")
    return G.write_coverage(merged, stored(spark, sf), targets, "entity", "day", drop_pct=-2.0, min_universe=10)


@query("daily_coverage", _COVERAGE.format(
    existing="stored", merged="incoming", keep=95, targets="SELECT max(day) AS day FROM incoming"),
    ("stored", "incoming"))
def daily_coverage(spark, sf):
    return G.daily_coverage(incoming(spark, sf), stored(spark, sf), "entity", "day", drop_pct=5.0, min_universe=10)


@query("worst_coverage", """
WITH c AS (SELECT day, count(DISTINCT entity) AS n FROM bars GROUP BY day)
SELECT arg_min(day, n) AS day, CAST(min(n) AS BIGINT) AS score FROM c
WHERE n = (SELECT min(n) FROM c) AND day = (SELECT min(day) FROM c WHERE n = (SELECT min(n) FROM c))
""", ("bars",))
def worst_coverage(spark, sf):
    daily = G.coverage_continuity(bars(spark, sf), "entity", "day", drop_pct=5.0)
    return G.worst(daily, F.struct("n", "day"), "day").select("day", F.col("score.n").alias("score"))


def _drifting(spark, sf):
    """The stored panel with closes of one region moved by a percent."""
    rows = stored(spark, sf).join(_regions(spark, sf), "entity")
    return rows.withColumn("close", F.when(F.col("region") == "AFRICA", F.col("close") * 1.01)
                           .otherwise(F.col("close"))).drop("region")


def _regions(spark, sf):
    return instruments(spark, sf).select("entity", "region")


@query("price_drift", """
WITH c AS (SELECT s.entity, s.day, s.close AS old,
                  CASE WHEN i.region = 'AFRICA' THEN s.close * 1.01e0 ELSE s.close END AS new
           FROM stored s JOIN instruments i ON i.entity = s.entity
           JOIN (SELECT entity, max(day) AS l FROM stored GROUP BY 1) m ON m.entity = s.entity
           WHERE i.market <> 'BUILDING' AND s.day < least(DATE '2024-01-30', m.l) - 1),
     f AS (SELECT *, NOT abs(old - new) <= greatest(1e-7 * greatest(abs(old), abs(new)), 1e-8) AS bad FROM c),
     e AS (SELECT entity, bool_or(bad) AS drifts, min(CASE WHEN bad THEN day END) AS a,
                  max(CASE WHEN bad THEN day END) AS b FROM f GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS compared, CAST(coalesce(sum(CASE WHEN drifts THEN 1 ELSE 0 END), 0) AS BIGINT) AS mismatched,
       CAST(0 AS BIGINT) AS unreadable, min(a) AS mismatch_from, max(b) AS mismatch_to,
       coalesce(sum(CASE WHEN drifts THEN 1 ELSE 0 END), 0) <= count(*) * 0.05 AS ok FROM e
""", ("stored", "instruments"))
def price_drift(spark, sf):
    exempt = markets(spark, sf).where(F.col("market") == "BUILDING").select("entity")
    return G.price_drift(stored(spark, sf), _drifting(spark, sf), "entity", "day", "close", PRICES, exempt,
                         unsettled_as_of=day("2024-01-30"))


_STATES = """
WITH cand AS (SELECT s.entity, s.day, s.close + CASE i.region WHEN 'AFRICA' THEN 1.5 WHEN 'ASIA' THEN 1.0 ELSE 0 END
                     AS close
              FROM bars s JOIN instruments i ON i.entity = s.entity),
     o AS (SELECT c.entity, bool_and(abs(c.close - r.close) <= 1 + 1e-6) AS agrees, count(*) AS n
           FROM cand c JOIN official r ON r.entity = c.entity AND r.day = c.day GROUP BY 1),
     states AS (SELECT c.entity, CAST(coalesce(o.n, 0) AS BIGINT) AS overlap,
                CASE WHEN o.agrees THEN 'verified' WHEN o.agrees IS NULL THEN 'unmatched' ELSE 'rejected' END AS state
                FROM (SELECT DISTINCT entity FROM cand) c LEFT JOIN o ON o.entity = c.entity)
"""


def _candidate(spark, sf):
    shift = F.when(F.col("region") == "AFRICA", 1.5).when(F.col("region") == "ASIA", 1.0).otherwise(0.0)
    return bars(spark, sf).join(_regions(spark, sf), "entity").withColumn(
        "close", F.col("close") + shift).drop("region")


def _states(spark, sf):
    return G.verify_entities(_candidate(spark, sf), official(spark, sf), "entity", "day", "close")


@query("verify_reference", _STATES + "SELECT * FROM states", ("official", "instruments"))
def verify_reference(spark, sf):
    return _states(spark, sf)


@query("verified_rows", _STATES + """
SELECT c.entity, c.day, c.close FROM cand c JOIN states s ON s.entity = c.entity
WHERE s.state = 'verified' AND c.day >= DATE '2024-01-10'
""", ("official", "instruments"))
def verified_rows(spark, sf):
    rows = G.accepted_rows(_candidate(spark, sf), _states(spark, sf), "entity", "day", day("2024-01-10"))
    return rows.select("entity", "day", "close")


@query("verification_evidence", _STATES + """
SELECT CAST(count(*) FILTER (state = 'verified') AS BIGINT) AS verified,
       CAST(count(*) FILTER (state = 'rejected') AS BIGINT) AS rejected,
       CAST(count(*) FILTER (state = 'unmatched') AS BIGINT) AS unmatched FROM states
""", ("official", "instruments"))
def verification_evidence(spark, sf):
    return G.evidence(_states(spark, sf))


@query("mass_change", """
WITH d AS (SELECT o.day, count(*) FILTER (s.close > 0) AS comparable,
                  count(*) FILTER (s.close > 0 AND abs(o.close / s.close - 1) * 100 >= 5) AS shifted
           FROM official o JOIN stored s ON s.entity = o.entity AND s.day = o.day GROUP BY o.day)
SELECT day, CAST(comparable AS BIGINT) AS comparable, CAST(shifted AS BIGINT) AS shifted,
       CASE WHEN comparable > 0 THEN CAST(shifted AS DOUBLE) * 100 / comparable END AS shifted_pct,
       coalesce(CASE WHEN comparable > 0 THEN CAST(shifted AS DOUBLE) * 100 / comparable END <= 30, true) AS ok FROM d
""", ("official", "stored"))
def mass_change(spark, sf):
    both = official(spark, sf).select(*KEYS, F.col("close").alias("official_close")).join(
        stored(spark, sf).select(*KEYS, F.col("close").alias("stored_close")), KEYS)
    return G.mass_change(both, "day", "stored_close", "official_close", max_share_pct=30.0)


@query("closed_copy", """
WITH copied AS (
  SELECT * FROM bars WHERE day NOT IN (DATE '2024-01-13', DATE '2024-01-20')
  UNION ALL SELECT * REPLACE (DATE '2024-01-13' AS day) FROM bars WHERE day = DATE '2024-01-12'
  UNION ALL SELECT * FROM bars WHERE day = DATE '2024-01-20'),
source AS (SELECT * FROM official WHERE day NOT IN (DATE '2024-01-13', DATE '2024-01-20')),
drops(day, prev) AS (VALUES (DATE '2024-01-13', DATE '2024-01-12'), (DATE '2024-01-20', DATE '2024-01-19')),
p AS (SELECT d.day, d.prev, count(*) AS n, count(y.entity) AS pairs,
             count(*) FILTER (x.close = y.close) AS same_close, count(*) FILTER (x.volume = y.volume) AS same_volume
      FROM drops d JOIN copied x ON x.day = d.day LEFT JOIN copied y ON y.day = d.prev AND y.entity = x.entity
      GROUP BY 1, 2)
SELECT day, prev AS previous, 'weekend' AS reason, CAST(n AS BIGINT) AS "rows", CAST(pairs AS BIGINT) AS pairs,
       CAST(same_close AS DOUBLE) * 100 / pairs AS close_match_pct,
       CAST(same_volume AS DOUBLE) * 100 / pairs AS volume_match_pct,
       pairs >= n * 0.9 AND CAST(same_close AS DOUBLE) * 100 / pairs >= 99 AS ok FROM p
""", ("bars", "official"))
def closed_copy(spark, sf):
    """The panel with Saturday the 13th replaced by a copy of Friday; the 20th is a real trading Saturday."""
    panel_rows, sat = bars(spark, sf), day("2024-01-13")
    copied = panel_rows.where(F.col("day") != sat).unionByName(
        panel_rows.where(F.col("day") == day("2024-01-12")).withColumn("day", sat))
    drops = spark.range(1).select(F.explode(F.array(sat, day("2024-01-20"))).alias("day"))
    source = official(spark, sf).join(drops, "day", "left_anti")
    days = copied.select(F.col("day").alias("date")).distinct()
    holidays = days.where(F.lit(False)).withColumn("name", F.lit(""))
    status = session_status(days, holidays, days.select(F.year("date").alias("year")))
    return G.closed_copies(copied, source, drops, status, "entity", "day", "close", "volume")


@query("prelisting_rows", """
WITH idle AS (SELECT entity, min(day) - 1 AS day FROM bars GROUP BY entity),
     early AS (SELECT entity, day FROM idle WHERE day IN (SELECT day FROM official)),
     listed AS (SELECT entity, min(day) AS f FROM official GROUP BY 1),
     keys AS (SELECT entity, day FROM early UNION ALL SELECT entity, max(day) FROM official GROUP BY entity)
SELECT k.entity, k.day, CAST(1 AS BIGINT) AS "rows",
       CASE WHEN e.entity IS NULL THEN o.volume ELSE 0 END AS stored_volume, l.f AS official_first_date,
       e.entity IS NOT NULL AND l.f > k.day AS ok
FROM keys k LEFT JOIN early e ON e.entity = k.entity AND e.day = k.day
LEFT JOIN official o ON o.entity = k.entity AND o.day = k.day LEFT JOIN listed l ON l.entity = k.entity
""", ("bars", "official"))
def prelisting_rows(spark, sf):
    """Idle rows put one day before each entity's first bar, and its last official row as a counter-example."""
    source = official(spark, sf)
    idle = bars(spark, sf).groupBy("entity").agg(F.date_sub(F.min("day"), 1).alias("day"))
    early = idle.join(source.select("day").distinct(), "day", "left_semi").select("entity", "day")
    held = source.select("entity", "day", "volume").unionByName(early.withColumn("volume", F.lit(0).cast("long")))
    keys = early.unionByName(source.groupBy("entity").agg(F.max("day").alias("day")))
    return G.prelisting_rows(held, source, keys, "entity", "day", "volume")


@query("provisional_sessions", """
SELECT CAST(count(DISTINCT day) AS BIGINT) AS provisional, count(DISTINCT day) <= 10 AS ok
FROM stored WHERE day >= DATE '2024-01-05' AND day > (SELECT max(day) FROM official)
""", ("stored", "official"))
def provisional_sessions(spark, sf):
    boundary = official(spark, sf).agg(F.max("day").alias("official_through"))
    return G.provisional_sessions(stored(spark, sf), boundary, "day", day("2024-01-05"))


@query("rebase_safe", """
WITH o AS (SELECT entity, day > DATE '2024-01-15' AS half, count(*) AS n FROM stored GROUP BY 1, 2),
     x AS (SELECT entity, day > DATE '2024-01-15' AS half, count(*) AS n FROM incoming GROUP BY 1, 2),
     f AS (SELECT o.entity, bool_and(x.n IS NOT NULL AND x.n >= o.n * 0.9) AS fits
           FROM o LEFT JOIN x ON x.entity = o.entity AND x.half = o.half GROUP BY 1)
SELECT CAST(i.entity AS VARCHAR) AS entity, i.market <> 'FURNITURE' AND coalesce(f.fits, true) AS safe
FROM instruments i LEFT JOIN f ON f.entity = i.entity
""", ("stored", "incoming", "instruments"))
def rebase_safe(spark, sf):
    names = markets(spark, sf)
    return G.rebase_safe(stored(spark, sf), incoming(spark, sf), names, names.where(F.col("market") == "FURNITURE"),
                         "entity", F.col("day") > day("2024-01-15"))


@query("session_acceptance", """
SELECT day, CAST(count(*) AS BIGINT) AS "rows", avg(CASE WHEN amount > 20 THEN 1e0 ELSE 0e0 END) AS cap_share,
       avg(CASE WHEN amount > 20 THEN 1e0 ELSE 0e0 END) >= 0.9 AS ok FROM bars GROUP BY day
""", ("bars",))
def session_acceptance(spark, sf):
    rows = bars(spark, sf).select("day", F.when(F.col("amount") > 20, F.col("amount")).alias("cap"))
    return G.session_acceptance(rows, "day", "cap")

