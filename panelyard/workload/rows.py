"""Filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import rows as R
from panelyard.workload.base import PRICES, TODAY, bars, day, named_panel, query, stored, table

_NUMBERS = "open, high, low, close, volume"


@query("nonfinite_rows", """
SELECT entity, day, open, high, low, close, volume FROM (
  SELECT entity, day, CASE WHEN volume > 1 THEN open END AS open, CASE WHEN volume > 1 THEN high END AS high,
         CASE WHEN volume > 1 THEN low END AS low, CASE WHEN volume > 1 AND close > 10 THEN close END AS close,
         CASE WHEN volume > 1 THEN volume END AS volume FROM bars)
WHERE NOT (open IS NULL AND high IS NULL AND low IS NULL AND close IS NULL AND volume IS NULL)
  AND (open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL)
""", ("bars",))
def nonfinite_rows(spark, sf):
    return R.nonfinite_rows(_padded(spark, sf), [*PRICES, "volume"])


def _padded(spark, sf):
    """Bars with padding rows (single-event days) and some missing closes."""
    rows = bars(spark, sf)
    traded = F.col("volume") > 1
    cells = [F.when(traded & (F.col("close") > 10) if c == "close" else traded, F.col(c)).alias(c)
             for c in [*PRICES, "volume"]]
    return rows.select("entity", "day", *cells)


@query("positive_closes", """
SELECT entity, day, open, high, low, close, volume FROM bars WHERE volume > 1 AND close > 10
""", ("bars",))
def positive_closes(spark, sf):
    kept = R.drop_empty_rows(_padded(spark, sf), [*PRICES, "volume"])
    return R.positive_close(kept, "close")


_ORPHANS = """
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, r_name IN ('EUROPE', 'ASIA') AS f,
                  'U' || CAST(o_custkey AS VARCHAR)
                  || CASE r_name WHEN 'EUROPE' THEN '.L' WHEN 'ASIA' THEN '.HK' ELSE '' END AS ticker
           FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
           JOIN region ON r_regionkey = n_regionkey)
SELECT o_orderkey, day, ticker FROM r WHERE {sign} (f AND day NOT IN (SELECT day FROM r WHERE NOT f))
"""


def _listed_orders(spark, sf):
    from panelyard.workload.base import instruments
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("entity"),
                                               F.to_date("o_orderdate").alias("day"))
    return orders.join(instruments(spark, sf).select("entity", "ticker"), "entity").drop("entity")


@query("orphan_dates", _ORPHANS.format(sign=""))
def orphan_dates(spark, sf):
    return R.split_orphan_dates(_listed_orders(spark, sf), "ticker", "day")[1]


@query("calendar_rows", _ORPHANS.format(sign="NOT"))
def calendar_rows(spark, sf):
    return R.split_orphan_dates(_listed_orders(spark, sf), "ticker", "day")[0]


@query("common_stock", """
SELECT CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 6 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0')
            ELSE CAST(p_partkey AS VARCHAR) END AS code, p_retailprice
FROM part WHERE regexp_full_match(lpad(CAST(p_partkey AS VARCHAR), 6, '0'), '[0-9]{5}0')
""")
def common_stock(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("code"), "p_retailprice")
    return R.common_stock(parts, "code")


@query("ascii_symbols", """
WITH w AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), ' ')) AS raw FROM documents),
     s AS (SELECT doc_id, upper(replace(trim(raw), 'ß', 'SS')) AS s FROM w)
SELECT s || '-USD' AS ticker, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT doc_id) AS BIGINT) AS documents FROM s
WHERE s <> '' AND regexp_full_match(s, '[\\x00-\\x7F]+') GROUP BY 1
""")
def ascii_symbols(spark, sf):
    """Every word of every document as a listed symbol; the place in the text is its rank, and none is too low."""
    words = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("rank", "s"))
    found = R.ascii_symbols(words, "s", "rank", 1 << 30)
    return found.groupBy("ticker").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("documents"))


@query("recent_rows", "SELECT entity, day, close FROM bars WHERE day >= DATE '2024-01-30' - 7", ("bars",))
def recent_rows(spark, sf):
    return R.recent_rows(bars(spark, sf), "day", day(TODAY), 7).select("entity", "day", "close")


@query("range_check", """
SELECT CAST(count(*) AS BIGINT) AS outside FROM orders WHERE NOT o_orderdate BETWEEN DATE '1995-06-01' AND DATE '2000-12-31'
""")
def range_check(spark, sf):
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return R.outside_range(orders, "day", day("1995-06-01"), day("2000-12-31")).agg(F.count(F.lit(1)).alias("outside"))


@query("month_window", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
WHERE CAST(o_orderdate AS DATE) <= last_day(CAST(o_orderdate AS DATE))
      - CAST(greatest(isodow(last_day(CAST(o_orderdate AS DATE))) - 5, 0) AS INTEGER)
""")
def month_window(spark, sf):
    return R.month_window(table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day")), "day")


@query("target_filter", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')
""")
def target_filter(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    wanted = table(spark, sf, "part").where(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("l_partkey"))
    return R.target_entities(items, wanted, "l_partkey")


@query("repaired_columns", "SELECT entity, day, close AS ChangesRatio FROM stored", ("stored",))
def repaired_columns(spark, sf):
    raw = stored(spark, sf).select("entity", "day", F.col("close").alias("ChagesRatio"), F.lit(0).alias("Unnamed: 0"))
    return R.repair_name(R.drop_unnamed(raw))


@query("code_maps", """
WITH m AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code,
                  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'STK' WHEN 'BUILDING' THEN 'KSQ' WHEN 'FURNITURE' THEN 'KNX'
                       ELSE 'OTC' END AS market_id FROM customer),
     n AS (SELECT *, CASE market_id WHEN 'STK' THEN 'KOSPI' WHEN 'KSQ' THEN 'KOSDAQ' WHEN 'KNX' THEN 'KONEX' END AS market
           FROM m)
SELECT c_custkey, market_id, market, CASE market WHEN 'KOSPI' THEN 'STK' WHEN 'KOSDAQ' THEN 'KSQ' WHEN 'KONEX' THEN 'KNX'
       ELSE 'STK' END AS id_again, code || CASE WHEN market IN ('KOSDAQ', 'KONEX') THEN '.KQ' ELSE '.KS' END AS symbol
FROM n
""")
def code_maps(spark, sf):
    segment = F.col("c_mktsegment")
    given = (F.when(segment == "AUTOMOBILE", "STK").when(segment == "BUILDING", "KSQ")
             .when(segment == "FURNITURE", "KNX").otherwise("OTC"))
    rows = table(spark, sf, "customer").select("c_custkey", given.alias("market_id")).withColumn(
        "market", R.market_name(F.col("market_id")))
    code = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    return rows.select("c_custkey", "market_id", "market", R.market_id(F.col("market")).alias("id_again"),
                       R.quote_symbol(code, F.col("market")).alias("symbol"))


@query("foreign_share", """
SELECT region, CAST(count(*) FILTER (regexp_matches(ticker, '\\.(L|HK)$')) AS BIGINT) AS suffixed,
       CAST(count(*) AS BIGINT) AS "rows" FROM panel GROUP BY region
""", ("panel",))
def foreign_share(spark, sf):
    from panelyard.functions import is_foreign
    return named_panel(spark, sf).groupBy("region").agg(
        F.count_if(is_foreign(F.col("ticker"))).alias("suffixed"), F.count(F.lit(1)).alias("rows"))
