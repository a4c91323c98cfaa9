"""Identity resolution: users as tickers, customers' balances as listed prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import identity as I
from panelyard.workload.base import bars, query, stored, table

_CTE = """
WITH latest AS (SELECT 'U' || entity || '-USD' AS ticker, arg_max(close, day) AS price, max(day) AS last_date
                FROM stored GROUP BY entity),
     listing AS (SELECT 'U' || c_custkey AS symbol, c_custkey + 1000 AS id, c_acctbal / 30e0 AS price FROM customer),
     j AS (SELECT t.ticker, t.price, t.last_date, l.price AS listed, l.symbol || l.id || '-USD' AS symbol,
                  greatest(t.price, l.price) / least(t.price, l.price) AS ratio
           FROM latest t JOIN listing l ON l.symbol || '-USD' = t.ticker WHERE t.price > 0 AND l.price > 0),
     wrong AS (SELECT ticker, symbol FROM j WHERE ratio > 5),
     susp AS (SELECT ticker, symbol, listed FROM j WHERE ticker NOT IN (SELECT ticker FROM wrong)
              AND (ratio > 2 OR (SELECT max(last_date) FROM latest) - last_date > 3)),
     alt AS (SELECT 'U' || entity || (entity + 1000) || '-USD' AS symbol, max(high) AS price FROM bars GROUP BY entity),
     conf AS (SELECT s.ticker, s.symbol FROM susp s JOIN alt a ON a.symbol = s.symbol
              WHERE greatest(a.price, s.listed) / least(a.price, s.listed) <= 1.5),
     found AS (SELECT ticker, 'X-' || ticker AS symbol FROM latest WHERE price > 150),
     final AS (SELECT ticker, symbol FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY src) AS rn FROM (
               SELECT *, 0 AS src FROM wrong UNION ALL SELECT *, 1 FROM conf UNION ALL SELECT *, 2 FROM found)) WHERE rn = 1)
"""
_VIEWS = ("bars", "stored")


def _ticker(entity):
    return F.concat(F.lit("U"), F.col(entity).cast("string"), F.lit("-USD"))


def _bars(spark, sf):
    return stored(spark, sf).select(_ticker("entity").alias("ticker"), F.col("day").alias("Date"),
                                    F.col("close").alias("Close"))


def _latest(spark, sf):
    from panelyard.operators.aggregates import last_observation
    return last_observation(_bars(spark, sf), "ticker", "Date", ["Close"]).withColumnRenamed("Close", "price")


def _listing(spark, sf):
    return table(spark, sf, "customer").select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("symbol"),
        (F.col("c_custkey") + 1000).alias("id"), (F.col("c_acctbal") / 30.0).alias("price"))


def _alternates(spark, sf):
    symbol = F.concat(F.lit("U"), F.col("entity").cast("string"), (F.col("entity") + 1000).cast("string"), F.lit("-USD"))
    return bars(spark, sf).groupBy("entity").agg(F.max("high").alias("price")).select(symbol.alias("symbol"), "price")


def _found(spark, sf):
    return _latest(spark, sf).where(F.col("price") > 150).select(
        "ticker", F.concat(F.lit("X-"), "ticker").alias("symbol"))


@query("symbol_override", _CTE + "SELECT ticker, symbol FROM wrong", _VIEWS)
def symbol_override(spark, sf):
    return I.price_overrides(_latest(spark, sf), _listing(spark, sf))


@query("symbol_suspects", _CTE + "SELECT ticker, symbol, listed AS listed_price FROM susp", _VIEWS)
def symbol_suspects(spark, sf):
    latest, listing = _latest(spark, sf), _listing(spark, sf)
    return I.suspects(latest, listing, I.price_overrides(latest, listing))


@query("symbol_confirmed", _CTE + "SELECT ticker, symbol FROM conf", _VIEWS)
def symbol_confirmed(spark, sf):
    latest, listing = _latest(spark, sf), _listing(spark, sf)
    return I.confirmed_overrides(I.suspects(latest, listing, I.price_overrides(latest, listing)), _alternates(spark, sf))


@query("symbol_map", _CTE + "SELECT ticker, symbol FROM final", _VIEWS)
def symbol_map(spark, sf):
    return I.symbol_overrides(_bars(spark, sf), _listing(spark, sf), _alternates(spark, sf), _found(spark, sf))


@query("purge_targets", _CTE + """
SELECT ticker FROM final WHERE ticker NOT IN (SELECT 'U' || c_custkey || '-USD' FROM customer WHERE c_mktsegment = 'BUILDING')
""", _VIEWS)
def purge_targets(spark, sf):
    final = I.symbol_overrides(_bars(spark, sf), _listing(spark, sf), _alternates(spark, sf), _found(spark, sf))
    failed = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.lower(_ticker("c_custkey")).alias("ticker"))
    return I.purge_targets(final, failed)


@query("retry_symbols", """
WITH missing AS (SELECT 'U' || c_custkey || '-USD' AS ticker, c_custkey AS k, c_mktsegment AS m, c_acctbal AS b FROM customer),
     o AS (SELECT ticker, 'U' || k || (k + 1000) || '-USD' AS symbol, 0 AS ord FROM missing WHERE b > 3000
           UNION ALL SELECT ticker, CASE m WHEN 'BUILDING' THEN 'Y' || k || '-USD' ELSE 'u' || k || '77-usd' END, 1 FROM missing),
     ok AS (SELECT o.*, m.k FROM o JOIN missing m ON m.ticker = o.ticker
            WHERE ord = 0 OR regexp_full_match(upper(symbol), 'U' || m.k || '[0-9]*-USD')),
     fresh AS (SELECT * FROM ok WHERE NOT (ord = 0 AND ticker IN (SELECT ticker FROM missing WHERE m = 'FURNITURE')))
SELECT ticker, arg_min(symbol, ord) AS symbol FROM fresh GROUP BY ticker
""")
def retry_symbols(spark, sf):
    c = table(spark, sf, "customer")
    number = F.col("c_custkey").cast("string")
    missing = c.select(_ticker("c_custkey").alias("ticker"))
    listing = c.where(F.col("c_acctbal") > 3000).select(
        F.concat(F.lit("U"), number).alias("symbol"), (F.col("c_custkey") + 1000).alias("id"))
    hit = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("Y"), number, F.lit("-USD"))).otherwise(
        F.concat(F.lit("u"), number, F.lit("77-usd")))
    found = c.select(_ticker("c_custkey").alias("ticker"), hit.alias("symbol"))
    tried = c.where(F.col("c_mktsegment") == "FURNITURE").select(
        _ticker("c_custkey").alias("ticker"),
        F.concat(F.lit("U"), number, (F.col("c_custkey") + 1000).cast("string"), F.lit("-USD")).alias("symbol"))
    return I.retry_candidates(missing, listing, found, tried)


@query("relabelled", _CTE + """
SELECT CASE WHEN f.ticker IS NULL THEN a.symbol ELSE f.ticker END AS ticker, a.price FROM alt a
LEFT JOIN final f ON f.symbol = a.symbol
""", _VIEWS)
def relabelled(spark, sf):
    final = I.symbol_overrides(_bars(spark, sf), _listing(spark, sf), _alternates(spark, sf), _found(spark, sf))
    return I.relabel(_alternates(spark, sf).withColumnRenamed("symbol", "ticker"), final, "ticker")
