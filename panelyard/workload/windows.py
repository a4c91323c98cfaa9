"""Ordered analytics: changes, ranks, baselines, holes, quarters, universes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelyard.functions import normalise_ticker
from panelyard.operators import ordered as O
from panelyard.operators.aggregates import session_counts
from panelyard.workload.base import KEYS, bars, sparse_bars, incoming, markets, panel, query, stored, table


@query("change_ratio", """
SELECT entity, day, close, close - lag(close) OVER w AS changes,
       CASE WHEN lag(close) OVER w <> 0 THEN (close / lag(close) OVER w - 1) * 100 END AS changes_ratio
FROM bars WINDOW w AS (PARTITION BY entity ORDER BY day)
""", ("bars",))
def change_ratio(spark, sf):
    return O.with_changes(bars(spark, sf).select(*KEYS, "close"), "entity", "day", "close")


@query("rank_in_market", """
SELECT entity, day, market, amount,
       CASE WHEN amount IS NOT NULL THEN rank() OVER (PARTITION BY day, market ORDER BY amount DESC NULLS LAST)
       END AS rank
FROM (SELECT entity, day, market, CASE WHEN volume > 1 THEN amount END AS amount FROM panel)
""", ("panel",))
def rank_in_market(spark, sf):
    rows = panel(spark, sf).select(*KEYS, "market", F.when(F.col("volume") > 1, F.col("amount")).alias("amount"))
    return O.rank_within(rows, ["day", "market"], "amount", cut=True)


@query("rank_ties", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_returnflag,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rank
FROM lineitem
""")
def rank_ties(spark, sf):
    """Three groups, each a third of all rows, fifty distinct values: the worst case for a plain window."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag")
    return O.rank_within(items, ["l_returnflag"], "l_quantity")


@query("day_over_day", """
SELECT day, n, lag(n) OVER (ORDER BY day) AS n_prev,
       CAST(n - lag(n) OVER (ORDER BY day) AS DOUBLE) * 100 / lag(n) OVER (ORDER BY day) AS pct
FROM (SELECT day, CAST(count(DISTINCT entity) AS BIGINT) AS n FROM bars GROUP BY day)
""", ("bars",))
def day_over_day(spark, sf):
    return O.day_over_day(session_counts(bars(spark, sf), "entity", "day"), "day")


@query("coverage_baseline", """
WITH counts AS (SELECT day, count(DISTINCT entity) AS n FROM stored GROUP BY day),
     targets AS (SELECT DISTINCT day FROM incoming WHERE dayofweek(day) IN (0, 1, 6)),
     usable AS (SELECT * FROM counts WHERE day NOT IN (SELECT day FROM targets)),
     before AS (SELECT t.day, u.n, row_number() OVER (PARTITION BY t.day ORDER BY u.day DESC) AS k
                FROM targets t JOIN usable u ON u.day < t.day),
     after AS (SELECT t.day, u.n, row_number() OVER (PARTITION BY t.day ORDER BY u.day) AS k
               FROM targets t JOIN usable u ON u.day > t.day),
     b AS (SELECT day, median(n) AS m FROM before WHERE k <= 5 GROUP BY day),
     a AS (SELECT day, median(n) AS m FROM after WHERE k <= 5 GROUP BY day)
SELECT t.day, CAST(coalesce(b.m, a.m) AS DOUBLE) AS baseline
FROM targets t LEFT JOIN b ON b.day = t.day LEFT JOIN a ON a.day = t.day
""", ("stored", "incoming"))
def coverage_baseline(spark, sf):
    counts = session_counts(stored(spark, sf), "entity", "day")
    targets = incoming(spark, sf).where(F.dayofweek("day").isin(1, 2, 7)).select("day")
    return O.coverage_baseline(counts, targets, "day")


@query("month_end_snapshot", """
WITH rows AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day,
                     strftime(o_orderdate, '%Y%m') AS yyyymm, last_day(CAST(o_orderdate AS DATE)) AS e FROM orders),
     inside AS (SELECT * FROM rows WHERE day <= e - CAST(greatest(isodow(e) - 5, 0) AS INTEGER))
SELECT o_orderkey, o_custkey, day, yyyymm FROM inside i
WHERE day = (SELECT max(day) FROM inside j WHERE j.yyyymm = i.yyyymm)
""")
def month_end_snapshot(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return O.month_end_snapshot(rows, "day")


_AXIS = """
axis AS (SELECT market, day, row_number() OVER (PARTITION BY market ORDER BY day) AS pos
         FROM (SELECT DISTINCT market, day FROM panel)),
own AS (SELECT p.market, p.entity, p.day, a.pos FROM panel p JOIN axis a ON a.market = p.market AND a.day = p.day),
spans AS (SELECT market, entity, min(day) AS first_date, max(day) AS last_date, count(*) AS sessions,
                 max(pos) - min(pos) + 1 - count(*) AS holes FROM own GROUP BY 1, 2)
"""


@query("internal_holes", "WITH " + _AXIS + """
SELECT s.market, s.entity, a.day FROM spans s
JOIN axis a ON a.market = s.market AND a.day > s.first_date AND a.day < s.last_date
WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.entity = s.entity AND o.day = a.day)
""", ("panel",))
def internal_holes(spark, sf):
    return O.internal_holes(panel(spark, sf).select("market", *KEYS), "entity", "day", ["market"])


@query("entity_spans", "WITH " + _AXIS + """
SELECT market, entity, first_date, last_date, CAST(sessions AS BIGINT) AS sessions, CAST(holes AS BIGINT) AS holes
FROM spans
""", ("panel",))
def entity_spans(spark, sf):
    return O.entity_spans(panel(spark, sf).select("market", *KEYS), "entity", "day", ["market"])


@query("stale_entities", """
WITH l AS (SELECT market, entity, max(day) AS last_date FROM sparse_bars JOIN instruments USING (entity) GROUP BY 1, 2)
SELECT market, entity, last_date, max(last_date) OVER (PARTITION BY market) AS newest,
       CAST(max(last_date) OVER (PARTITION BY market) - last_date AS INTEGER) AS days_behind,
       max(last_date) OVER (PARTITION BY market) - last_date > 3 AS stale FROM l
""", ("sparse_bars", "instruments"))
def stale_entities(spark, sf):
    last = sparse_bars(spark, sf).join(markets(spark, sf), "entity").groupBy("market", "entity").agg(
        F.max("day").alias("last_date"))
    return O.stale_entities(last, ["market"])


def quarter_sums(spark, sf):
    """Extended price and discount value per supplier and quarter, as exact decimals."""
    items = table(spark, sf, "lineitem")
    return items.groupBy("l_suppkey", F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("report_key")
                         ).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"),
                               F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity"))


def cumulative(spark, sf):
    """Year-to-date values; a quarter without lines has no report."""
    w = O.by_date(["l_suppkey", "year"], "report_key").rowsBetween(Window.unboundedPreceding, 0)
    return quarter_sums(spark, sf).select(
        "l_suppkey", "year", "report_key", F.sum("revenue").over(w).alias("revenue"),
        F.sum("quantity").over(w).alias("quantity"))


@query("quarterise", """
WITH q AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS k,
                  sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS r, sum(CAST(l_quantity AS DECIMAL(18,2))) AS n
           FROM lineitem GROUP BY 1, 2, 3),
     g AS (SELECT l_suppkey, year, CAST(k AS INTEGER) AS k FROM (SELECT DISTINCT l_suppkey, year FROM q)
           CROSS JOIN (VALUES (1), (2), (3), (4)) v(k))
SELECT g.l_suppkey, g.year, g.k AS report_key,
       CAST(CASE WHEN g.k = 1 OR p.k IS NOT NULL THEN q.r END AS DOUBLE) AS revenue,
       CAST(CASE WHEN g.k = 1 OR p.k IS NOT NULL THEN q.n END AS DOUBLE) AS quantity
FROM g LEFT JOIN q ON q.l_suppkey = g.l_suppkey AND q.year = g.year AND q.k = g.k
LEFT JOIN q p ON p.l_suppkey = g.l_suppkey AND p.year = g.year AND p.k = g.k - 1
""")
def quarterise(spark, sf):
    out = O.quarterise(cumulative(spark, sf), ["l_suppkey", "year"], "report_key", ["revenue", "quantity"])
    return out.select("l_suppkey", "year", "report_key", F.col("revenue").cast("double").alias("revenue"),
                      F.col("quantity").cast("double").alias("quantity"))


@query("log_tail", """
SELECT o_custkey, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn <= 3
""")
def log_tail(spark, sf):
    return O.keep_newest(table(spark, sf, "orders"), ["o_custkey"], "o_orderkey", 3).select("o_custkey", "o_orderkey")


@query("top_universe", """
WITH caps AS (SELECT lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS code, CAST(l_shipdate AS DATE) AS day,
                     CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS cap,
                     CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS shares,
                     bool_or(l_returnflag = 'R') AS r
              FROM lineitem GROUP BY 1, 2),
     known AS (SELECT code, day, CASE WHEN r THEN cap END AS cap, shares FROM caps)
SELECT code, shares, cap, day AS source_date, (SELECT max(day) FROM known) AS latest_known_date FROM known
WHERE day = (SELECT max(day) FROM known WHERE cap > 0) AND regexp_full_match(code, '[0-9]{5}0') AND cap > 0
ORDER BY cap DESC, code LIMIT 50
""")
def top_universe(spark, sf):
    items = table(spark, sf, "lineitem")
    caps = items.groupBy(F.col("l_partkey").cast("string").alias("code"), F.to_date("l_shipdate").alias("day")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("cap"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("shares"),
        F.bool_or(F.col("l_returnflag") == "R").alias("r"))
    known = caps.select("code", "day", F.when(F.col("r"), F.col("cap")).alias("cap"), "shares")
    return O.top_universe(known, "code", "day", "cap", "shares", 50)


@query("universe_verdict", """
WITH caps AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day,
                     CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS cap,
                     sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS shares
              FROM lineitem GROUP BY 1, 2),
     latest AS (SELECT lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS code, cap, shares FROM caps
                WHERE day = (SELECT max(day) FROM caps)),
     top AS (SELECT * FROM latest WHERE regexp_full_match(code, '[0-9]{5}0') ORDER BY cap DESC, code LIMIT 20)
SELECT CAST(count(*) AS BIGINT) AS valid_count,
       CAST(coalesce(sum(CASE WHEN shares > 0 THEN 0 ELSE 1 END), 0) AS BIGINT) AS without_shares,
       CAST(0 AS BIGINT) AS repeated_codes,
       count(*) > 0 AND coalesce(sum(CASE WHEN shares > 0 THEN 0 ELSE 1 END), 0) = 0 AS ok FROM top
""")
def universe_verdict(spark, sf):
    shares = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    caps = table(spark, sf, "lineitem").groupBy(
        F.col("l_partkey").cast("string").alias("code"), F.to_date("l_shipdate").alias("day")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("cap"), shares.alias("shares"))
    top = O.top_universe(caps, "code", "day", "cap", "shares", 20)
    return O.universe_verdict(caps, top, "code", "day", "cap", "shares")


@query("universe_union", """
WITH lists AS (
  SELECT 0 AS source, c_custkey AS position, upper('$' || ' u' || c_custkey) AS raw FROM customer
  UNION ALL SELECT 1, o_orderkey, 'U' || o_custkey FROM orders)
SELECT item, CAST(s.source AS INTEGER) AS source, CAST(s.position AS BIGINT) AS position FROM (
  SELECT regexp_replace(raw, '[^A-Z0-9-]', '', 'g') AS item,
         min({'source': source, 'position': position}) AS s FROM lists GROUP BY 1)
""")
def universe_union(spark, sf):
    listed = table(spark, sf, "customer").select(
        F.concat(F.lit("$ u"), F.col("c_custkey").cast("string")).alias("item"), F.col("c_custkey").alias("at"))
    active = table(spark, sf, "orders").select(
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("item"), F.col("o_orderkey").alias("at"))
    return O.union_distinct([listed, active], "item", "at", normalise_ticker)


@query("market_tag", """
WITH m AS (SELECT o_custkey AS k, CASE o_orderpriority WHEN '1-URGENT' THEN 'ETF' WHEN '2-HIGH' THEN 'DOW30'
                  ELSE 'S&P500' END AS tag, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
                  ELSE 2 END AS priority FROM orders)
SELECT c_custkey, coalesce((SELECT arg_min(tag, priority) FROM m WHERE m.k = c_custkey), 'US') AS tag FROM customer
""")
def market_tag(spark, sf):
    priority = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1)\
        .otherwise(2)
    tag = F.element_at(F.array(F.lit("ETF"), F.lit("DOW30"), F.lit("S&P500")), F.col("priority") + 1)
    member = table(spark, sf, "orders").withColumn("priority", priority).select(
        F.concat(F.lit("c."), F.col("o_custkey").cast("string")).alias("symbol"), tag.alias("tag"), "priority")
    names = table(spark, sf, "customer").select("c_custkey", F.concat(
        F.lit("C-"), F.col("c_custkey").cast("string")).alias("symbol"))
    return O.market_tag(names, member, "symbol", normalise_ticker).select("c_custkey", "tag")


@query("added_rows", """
SELECT n.entity, n.day, o.entity IS NULL AS added FROM incoming n
LEFT JOIN stored o ON o.entity = n.entity AND o.day = n.day
""", ("stored", "incoming"))
def added_rows(spark, sf):
    known = stored(spark, sf).select(*KEYS).withColumn("_known", F.lit(True))
    return incoming(spark, sf).select(*KEYS).join(known, KEYS, "left").select(
        *KEYS, F.col("_known").isNull().alias("added"))


@query("set_difference", """
SELECT entity, 'recent' AS side FROM (SELECT DISTINCT entity FROM stored EXCEPT SELECT DISTINCT entity FROM sparse_bars)
UNION ALL
SELECT entity, 'both' AS side FROM (SELECT entity FROM stored INTERSECT SELECT entity FROM sparse_bars)
""", ("stored", "sparse_bars"))
def set_difference(spark, sf):
    a, b = stored(spark, sf).select("entity"), sparse_bars(spark, sf).select("entity")
    return a.subtract(b).withColumn("side", F.lit("recent")).unionByName(
        a.intersect(b).withColumn("side", F.lit("both")))


@query("panel_union", """
SELECT src, CAST(count(*) AS BIGINT) AS "rows", CAST(count(extra) AS BIGINT) AS with_extra FROM (
  SELECT 'stored' AS src, NULL AS extra FROM stored UNION ALL SELECT 'incoming', amount FROM incoming) GROUP BY src
""", ("stored", "incoming"))
def panel_union(spark, sf):
    a = stored(spark, sf).select(*KEYS).withColumn("src", F.lit("stored"))
    b = incoming(spark, sf).select(*KEYS, F.col("amount").alias("extra")).withColumn("src", F.lit("incoming"))
    return a.unionByName(b, allowMissingColumns=True).groupBy("src").agg(
        F.count(F.lit(1)).alias("rows"), F.count("extra").alias("with_extra"))


@query("report_dependencies", """
SELECT l_suppkey, year, size = 0 AS available FROM (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
         4 - count(DISTINCT quarter(l_shipdate)) AS size FROM lineitem GROUP BY 1, 2)
""")
def report_dependencies(spark, sf):
    """Are all four reports of a year there?  (A subset test on arrays.)"""
    got = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.collect_set(F.quarter("l_shipdate")).alias("have"))
    need = F.array(*[F.lit(q) for q in (1, 2, 3, 4)])
    return got.select("l_suppkey", "year", (F.size(F.array_except(need, "have")) == 0).alias("available"))

