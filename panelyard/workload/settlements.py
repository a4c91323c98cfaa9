"""Settlement of the stored panel by the official one."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import merge as M
from panelyard.operators import settlement as S
from panelyard.session import materialise
from panelyard.workload.base import FLOOR, KEYS, PRICES, day, markets, official, query, stored

_MEASURED = [*PRICES, "volume", "amount"]
_RANKED = """
WITH win AS (SELECT o.*, i.market FROM official o JOIN instruments i USING (entity) WHERE o.day >= DATE '2024-01-05'),
     held AS (SELECT s.*, i.market,
                     rank() OVER (PARTITION BY s.day, i.market ORDER BY s.amount DESC) AS rank
              FROM stored s JOIN instruments i USING (entity)),
     mine AS (SELECT * FROM held WHERE day IN (SELECT day FROM win)),
     t AS (SELECT coalesce(w.entity, m.entity) AS entity, coalesce(w.day, m.day) AS day,
                  coalesce(m.market, w.market) AS market, """ + ", ".join(
    f"coalesce(w.{c}, m.{c}) AS {c}, m.{c} AS was_{c}" for c in _MEASURED) + """,
                  m.rank AS was_rank, m.market AS was_market, m.entity IS NULL AS added
           FROM win w FULL JOIN mine m ON m.entity = w.entity AND m.day = w.day),
     r AS (SELECT *, rank() OVER (PARTITION BY day, market ORDER BY amount DESC) AS rank FROM t),
     c AS (SELECT *, NOT added AND (""" + " OR ".join(
    f"{c} IS DISTINCT FROM was_{c}" for c in [*_MEASURED, "rank"]) + """) AS changed FROM r)
"""


def _rules():
    return S.SettlementRules(
        keys=KEYS, date="day", measured=_MEASURED, fill_only=["market"], rank="rank", rank_measure="amount",
        rank_group="market", policy={"amount": M.KEEP_IF_NULL, "rank": M.KEEP_IF_NULL_OR_ZERO})


def _held(spark, sf):
    """The stored panel with market and rank, as it was published provisionally."""
    from panelyard.operators.ordered import rank_within
    rows = stored(spark, sf).join(markets(spark, sf), "entity")
    return materialise(rank_within(rows, ["day", "market"], "amount", cut=True), "held")


def _source(spark, sf):
    return materialise(official(spark, sf).join(markets(spark, sf), "entity"),
                       "official")


def _compared(spark, sf, held=None, source=None):
    held = _held(spark, sf) if held is None else held
    source = _source(spark, sf) if source is None else source
    return S.compare_settlement(held, source, _rules(), day(FLOOR))


@query("settle_plan", _RANKED + """
SELECT entity, day, """ + ", ".join(_MEASURED) + """, market, CAST(rank AS BIGINT) AS rank FROM c WHERE added OR changed
""", ("official", "stored", "instruments"))
def settle_plan(spark, sf):
    return S.rows_to_write(_compared(spark, sf), _rules())


@query("settle_report", _RANKED + """
SELECT (SELECT max(day) FROM official) AS official_through,
       CAST((SELECT count(DISTINCT day) FROM win) AS BIGINT) AS dates,
       CAST(count(*) FILTER (added) AS BIGINT) AS rows_added,
       CAST(count(*) FILTER (changed) AS BIGINT) AS rows_replaced,
       min(CASE WHEN added OR changed THEN day END) AS first_date,
       max(CASE WHEN added OR changed THEN day END) AS last_date, """ + ", ".join(
    f"CAST(count(*) FILTER (NOT added AND {c} IS DISTINCT FROM was_{c}) AS BIGINT) AS changed_{c}"
    for c in [*_MEASURED, "market", "rank"]) + """ FROM c
""", ("official", "stored", "instruments"))
def settle_report(spark, sf):
    source = _source(spark, sf)
    return S.settlement_report(_compared(spark, sf, source=source), source, _rules(), day(FLOOR))


@query("settle_apply", _RANKED + """
, w AS (SELECT * FROM c WHERE added OR changed)
SELECT coalesce(w.entity, h.entity) AS entity, coalesce(w.day, h.day) AS day, """ + ", ".join(
    f"CASE WHEN w.entity IS NULL THEN h.{c} ELSE w.{c} END AS {c}" for c in [*_MEASURED, "market"]) + """,
       CAST(CASE WHEN w.entity IS NULL THEN h.rank ELSE w.rank END AS BIGINT) AS rank
FROM held h FULL JOIN w ON w.entity = h.entity AND w.day = h.day
""", ("official", "stored", "instruments"))
def settle_apply(spark, sf):
    held = _held(spark, sf)
    write = S.rows_to_write(_compared(spark, sf, held), _rules())
    return M.merge_policy(held, write, KEYS, _rules().policy)


@query("reconcile", """
WITH o AS (SELECT * FROM official WHERE day >= DATE '2024-01-05'),
     f AS (SELECT * FROM stored WHERE day >= DATE '2024-01-05' AND day <= (SELECT max(day) FROM official)),
     j AS (SELECT o.entity AS oe, f.entity AS fe, coalesce(o.day, f.day) AS day, """ + ", ".join(
    f"o.{c} AS o_{c}, f.{c} AS f_{c}" for c in [*PRICES, "volume"]) + """
           FROM o FULL JOIN f ON f.entity = o.entity AND f.day = o.day)
SELECT CAST((SELECT count(DISTINCT day) FROM o WHERE day NOT IN (SELECT day FROM f)) AS BIGINT) AS missing_dates,
       CAST((SELECT count(DISTINCT day) FROM f WHERE day NOT IN (SELECT day FROM o)) AS BIGINT) AS extra_dates,
       CAST(count(*) FILTER (fe IS NULL) AS BIGINT) AS missing_rows,
       CAST(count(*) FILTER (oe IS NULL) AS BIGINT) AS extra_rows, """ + ", ".join(
    f"CAST(count(*) FILTER (oe IS NOT NULL AND fe IS NOT NULL AND o_{c} IS DISTINCT FROM f_{c}) AS BIGINT) "
    f"AS mismatch_{c}" for c in [*PRICES, "volume"]) + """,
       CAST(0 AS BIGINT) AS duplicate_keys, CAST((SELECT count(*) FROM stored) AS BIGINT) AS final_rows
FROM j
""", ("official", "stored"))
def reconcile(spark, sf):
    return S.reconcile(stored(spark, sf), official(spark, sf), KEYS, "day", [*PRICES, "volume"], day(FLOOR))


@query("reconcile_rows", """
WITH o AS (SELECT * FROM official WHERE day >= DATE '2024-01-05'),
     f AS (SELECT * FROM stored WHERE day >= DATE '2024-01-05' AND day <= (SELECT max(day) FROM official))
SELECT coalesce(o.entity, f.entity) AS entity, coalesce(o.day, f.day) AS day,
       CASE WHEN f.entity IS NULL THEN 'missing' WHEN o.entity IS NULL THEN 'extra' ELSE 'both' END AS side,
       f.entity IS NOT NULL AND o.entity IS NOT NULL AND o.close IS DISTINCT FROM f.close AS mismatch_close
FROM o FULL JOIN f ON f.entity = o.entity AND f.day = o.day
""", ("official", "stored"))
def reconcile_rows(spark, sf):
    return S.reconcile_rows(stored(spark, sf), official(spark, sf), KEYS, "day", ["close"], day(FLOOR))


@query("settle_years", """
WITH o AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_shipdate AS DATE) AS day, l_partkey AS entity,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close FROM lineitem GROUP BY 1, 2, 3),
     s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_shipdate AS DATE) AS day, l_partkey AS entity,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close FROM lineitem
           WHERE l_returnflag <> 'R' GROUP BY 1, 2, 3)
SELECT o.year, CAST(count(*) FILTER (s.entity IS NULL) AS BIGINT) AS rows_added,
       CAST(count(*) FILTER (s.close <> o.close) AS BIGINT) AS rows_replaced, max(o.day) AS official_through
FROM o LEFT JOIN s ON s.entity = o.entity AND s.day = o.day GROUP BY o.year
""")
def settle_years(spark, sf):
    """All years in one plan, a report row per year."""
    from panelyard.workload.base import table

    def lines(rows):
        total = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")
        return rows.groupBy(F.col("l_partkey").alias("entity"), F.to_date("l_shipdate").alias("day")).agg(
            total.alias("close"))

    items = table(spark, sf, "lineitem")
    rules = S.SettlementRules(keys=KEYS, date="day", measured=["close"])
    compared = S.compare_settlement(lines(items.where(F.col("l_returnflag") != "R")), lines(items), rules,
                                    day("1900-01-01"))
    return compared.groupBy(F.year("day").alias("year")).agg(
        F.count_if("added").alias("rows_added"), F.count_if("changed").alias("rows_replaced"),
        F.max("day").alias("official_through"))
