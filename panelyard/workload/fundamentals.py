"""Fundamentals derived from suppliers' lines: reports, accounts, quarters, ratios, tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import fundamentals as FU
from panelyard.session import materialise
from panelyard.workload.base import day, query, table
from panelyard.workload.windows import cumulative

# Account rows: every (supplier, year, quarter, return flag, line status) becomes one landed account row.
# The flag chooses the account name, the status the statement, and every seventh part lacks a cumulative amount.
_ROWS = """
rows AS (SELECT l_suppkey AS code, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS report_key,
                CASE l_linestatus WHEN 'O' THEN 'CFS' ELSE 'OFS' END AS fs_div,
                CASE l_returnflag WHEN 'A' THEN '영업수익' WHEN 'N' THEN '매출액' ELSE '영업이익(손실)' END AS account_nm,
                CASE WHEN l_linenumber = 7 THEN 'BS' WHEN l_linenumber > 3 THEN 'CIS' ELSE 'IS' END AS sj_div,
                CAST(CAST(min(l_extendedprice) AS DECIMAL(18,2)) AS VARCHAR) AS thstrm_amount,
                CASE WHEN count(*) > 1 THEN CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS VARCHAR)
                     ELSE '-' END AS thstrm_add_amount,
                CAST(min(l_orderkey * 10 + l_linenumber) * 100 + quarter(l_shipdate) * 10 + sec AS BIGINT) AS ord
         FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN 2 WHEN l_linenumber > 3 THEN 1 ELSE 0 END AS sec FROM lineitem)
         GROUP BY 1, 2, 3, 4, 5, 6, sec, quarter(l_shipdate))
"""


def account_rows(spark, sf):
    items = table(spark, sf, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    name = F.when(F.col("l_returnflag") == "A", "영업수익").when(F.col("l_returnflag") == "N", "매출액")\
        .otherwise("영업이익(손실)")
    section = F.when(F.col("l_linenumber") == 7, "BS").when(F.col("l_linenumber") > 3, "CIS").otherwise("IS")
    place = F.when(F.col("sj_div") == "BS", 2).when(F.col("sj_div") == "CIS", 1).otherwise(0)
    rows = items.groupBy(
        F.col("l_suppkey").alias("code"), F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("report_key"),
        F.when(F.col("l_linestatus") == "O", "CFS").otherwise("OFS").alias("fs_div"), name.alias("account_nm"),
        section.alias("sj_div"),
    ).agg(F.min("l_extendedprice").cast("decimal(18,2)").cast("string").alias("thstrm_amount"),
          F.when(F.count(F.lit(1)) > 1, F.sum(price).cast("string")).otherwise("-").alias("thstrm_add_amount"),
          F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("first_line"))
    return rows.withColumn("ord", F.col("first_line") * 100 + F.col("report_key") * 10 + place).drop("first_line")


_ACCOUNTS = "WITH " + _ROWS + """,
     best AS (SELECT code, year, report_key, min(fs_div) AS fs FROM rows GROUP BY 1, 2, 3),
     pick AS (SELECT r.*, CASE WHEN account_nm IN ('매출액', '영업수익') THEN 'Revenue' ELSE 'OperatingIncome' END AS field,
                     CASE account_nm WHEN '영업수익' THEN 1 WHEN '영업이익(손실)' THEN 1 ELSE 0 END AS pri
              FROM rows r JOIN best b ON b.code = r.code AND b.year = r.year AND b.report_key = r.report_key AND b.fs = r.fs_div
              WHERE sj_div IN ('IS', 'CIS')),
     one AS (SELECT *, row_number() OVER (PARTITION BY code, year, report_key, field ORDER BY pri, ord) AS rn FROM pick),
     acc AS (SELECT b.code, b.year, b.report_key, b.fs AS fs_type,
                    max(CASE WHEN field = 'Revenue' THEN coalesce(TRY_CAST(thstrm_add_amount AS DOUBLE), TRY_CAST(thstrm_amount AS DOUBLE)) END) AS Revenue,
                    max(CASE WHEN field = 'OperatingIncome' THEN coalesce(TRY_CAST(thstrm_add_amount AS DOUBLE), TRY_CAST(thstrm_amount AS DOUBLE)) END) AS OperatingIncome
             FROM best b LEFT JOIN one o ON o.code = b.code AND o.year = b.year AND o.report_key = b.report_key AND o.rn = 1
             GROUP BY 1, 2, 3, 4)
"""
_REPORT = ["code", "year", "report_key"]


@query("account_priority", _ACCOUNTS + "SELECT code, year, report_key, fs_type, Revenue, OperatingIncome, CAST(NULL AS DOUBLE) AS NetIncome FROM acc")
def account_priority(spark, sf):
    return FU.extract_accounts(account_rows(spark, sf), _REPORT, FU.QUARTER_ACCOUNTS)


@query("annual_accounts", "WITH " + _ROWS + """,
     best AS (SELECT code, year, min(fs_div) AS fs FROM rows GROUP BY 1, 2),
     named AS (SELECT r.code, r.year, r.fs_div, CASE account_nm WHEN '영업수익' THEN '매출원가' ELSE account_nm END AS n, ord,
                      CAST(thstrm_amount AS DOUBLE) AS v FROM rows r JOIN best b ON b.code = r.code AND b.year = r.year AND b.fs = r.fs_div),
     one AS (SELECT *, row_number() OVER (PARTITION BY code, year, n ORDER BY ord) AS rn FROM named)
SELECT b.code, b.year, b.fs AS fs_type, max(CASE WHEN n = '매출액' THEN v END) AS revenue,
       max(CASE WHEN n = '매출원가' THEN v END) AS cost, max(CASE WHEN n = '영업이익(손실)' THEN v END) AS operating_income,
       max(CASE WHEN n = '매출액' THEN v END) - max(CASE WHEN n = '매출원가' THEN v END) AS gross_profit
FROM best b LEFT JOIN one o ON o.code = b.code AND o.year = b.year AND o.rn = 1 GROUP BY 1, 2, 3
""")
def annual_accounts(spark, sf):
    renamed = account_rows(spark, sf).withColumn("account_nm", F.when(
        F.col("account_nm") == "영업수익", "매출원가").otherwise(F.col("account_nm")))
    out = FU.annual_accounts(renamed)
    return out.select("code", "year", "fs_type", F.col("매출액").alias("revenue"), F.col("매출원가").alias("cost"),
                      F.col("영업이익").alias("operating_income"), F.col("매출총이익").alias("gross_profit"))


@query("quarterly_rows", _ACCOUNTS + """,
     diff AS (SELECT a.code, a.year, a.report_key AS q,
                     CASE WHEN a.report_key = 1 THEN a.Revenue ELSE a.Revenue - p.Revenue END AS r,
                     CASE WHEN a.report_key = 1 THEN a.OperatingIncome ELSE a.OperatingIncome - p.OperatingIncome END AS o
              FROM acc a LEFT JOIN acc p ON p.code = a.code AND p.year = a.year AND p.report_key = a.report_key - 1)
SELECT CAST(d.code AS VARCHAR) AS "Ticker", last_day(make_date(d.year, d.q * 3, 1)) AS "PeriodDate", d.year AS "Year", d.q AS "Quarter",
       d.r AS "Revenue", d.o AS "OperatingIncome",
       CASE WHEN s.s_acctbal > 0 THEN d.o / s.s_acctbal END AS "DilutedEPS", DATE '2024-01-30' AS "SnapDate"
FROM diff d JOIN supplier s ON s.s_suppkey = d.code
WHERE (d.r IS NOT NULL OR d.o IS NOT NULL) AND NOT (d.year = 1996 AND d.q = 2)
""")
def quarterly_rows(spark, sf):
    """Accounts -> quarters; the second quarter of 1996 counts as stored."""
    accounts = FU.extract_accounts(account_rows(spark, sf), _REPORT, FU.QUARTER_ACCOUNTS)
    named = materialise(accounts.withColumn("code", F.col("code").cast("string")), "accounts")
    held = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("Ticker"), F.lit(1996).alias("Year"), F.lit(2).alias("Quarter"))
    # zero_fill on stored tickers would not match the unpadded codes of this table
    shares = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("Code"),
                                                 F.col("s_acctbal").alias("Stocks"))
    padded = named.withColumn("code", FU.zero_fill(F.col("code")))
    shares = shares.withColumn("Code", FU.zero_fill(F.col("Code")))
    out = FU.quarterly_rows(padded, held, shares, day("2024-01-30"), fields=["Revenue", "OperatingIncome"],
                            income="OperatingIncome")
    return out.withColumn("Ticker", F.col("Ticker").cast("int").cast("string"))


@query("required_reports", """
WITH have AS (SELECT DISTINCT l_suppkey AS code, CAST(year(l_shipdate) AS INTEGER) AS year, quarter(l_shipdate) AS q FROM lineitem
              WHERE l_quantity > 45),
     want AS (SELECT s_suppkey AS code, y AS year, q FROM supplier, (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
              (VALUES (1), (2), (3), (4)) v(q)),
     open AS (SELECT w.* FROM want w LEFT JOIN have h ON h.code = w.code AND h.year = w.year AND h.q = w.q WHERE h.q IS NULL)
SELECT DISTINCT code, year, CAST(r AS INTEGER) AS report FROM open, (VALUES (1,1),(2,1),(2,2),(3,2),(3,3),(4,3),(4,4)) d(qq, r) WHERE qq = q
""")
def required_reports(spark, sf):
    have = table(spark, sf, "lineitem").where(F.col("l_quantity") > 45).select(
        F.col("l_suppkey").alias("code"), F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("Quarter")
    ).distinct()
    span = table(spark, sf, "orders").agg(F.collect_set(F.year("o_orderdate"))).scalar()   # a handful of years
    targets = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("code"), F.explode(span).alias("year")).select(
        "code", "year", F.explode(F.array(*[F.lit(q) for q in (1, 2, 3, 4)])).alias("Quarter"))
    return FU.required_reports(have, targets, ["code", "year"])


@query("target_quarters", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
     d AS (SELECT year, 1 AS q, make_date(year, 5, 15) AS deadline FROM y UNION ALL SELECT year, 2, make_date(year, 8, 14) FROM y
           UNION ALL SELECT year, 3, make_date(year, 11, 14) FROM y UNION ALL SELECT year, 4, make_date(year + 1, 3, 31) FROM y)
SELECT year, CAST(q AS INTEGER) AS "Quarter", deadline FROM d WHERE deadline < DATE '2001-08-14'
""")
def target_quarters(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return FU.target_quarters(years, day("2001-08-14"))


@query("verify_universe", """
WITH d AS (SELECT max(CAST(ts AS DATE)) AS o, max(CAST(ts AS DATE)) FILTER (CAST(ts AS DATE) <= DATE '2024-01-25') AS s FROM events)
SELECT 'newer' AS "case", 'live' AS use, s AS stored_date, o AS observed_date, true AS ok FROM d
UNION ALL SELECT 'same', 'stored', o, o, true FROM d
UNION ALL SELECT 'no caps, no session', 'stored', s, o, true FROM d
UNION ALL SELECT 'no caps, sessions', 'refused', s, o, false FROM d
UNION ALL SELECT 'older', 'refused', o, s, false FROM d
UNION ALL SELECT 'other year', 'refused', s, o, false FROM d
""")
def verify_universe(spark, sf):
    """Stored universe and live snapshot of two event days, in every branch of the rule."""
    days = table(spark, sf, "events").select(F.to_date("ts").alias("d"))
    last = days.agg(F.max("d").alias("source_date"))
    before = days.where(F.col("d") <= day("2024-01-25")).agg(F.max("d").alias("source_date"))
    held = lambda rows: rows.withColumn("latest_known_date", F.col("source_date"))
    live = lambda rows: rows.withColumn("observed_date", F.col("source_date"))
    bare = live(last).withColumn("source_date", F.lit(None).cast("date"))
    cases = {
        "newer": (held(before), live(last), 3, "2024-01-31"), "same": (held(last), live(last), 3, "2024-01-31"),
        "no caps, no session": (held(before), bare, 0, "2024-01-31"), "no caps, sessions": (held(before), bare, 2, "2024-01-31"),
        "older": (held(last), live(before), 3, "2024-01-31"), "other year": (held(before), live(last), 3, "2025-01-31"),
    }
    out = None
    for name, (stored, seen, between, snap) in cases.items():
        part = FU.verify_universe(stored, seen, F.lit(between), day(snap)).select(F.lit(name).alias("case"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("ratio_snapshot", """
SELECT CAST(c_custkey AS VARCHAR) AS "Ticker", DATE '2024-01-30' AS "SnapDate", c_name AS "Name", c_mktsegment AS "Sector",
       CASE WHEN c_acctbal > 0 THEN c_acctbal END AS "MarketCap", CAST(c_nationkey AS DOUBLE) / 100 * 100e0 AS "ROE"
FROM customer
""")
def ratio_snapshot(spark, sf):
    cap = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("string")).otherwise("Infinity")
    info = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("t"), F.col("c_name").alias("longName"),
        F.col("c_mktsegment").alias("sector"), cap.alias("marketCap"), (F.col("c_nationkey") / 100).alias("returnOnEquity"))
    return FU.ratio_snapshot(info, "t", day("2024-01-30")).select("Ticker", "SnapDate", "Name", "Sector", "MarketCap", "ROE")


@query("listing_ratios", """
SELECT upper(p_name) || p_partkey || '-USD' AS "Ticker", p_name AS "Name", p_type AS "Industry",
       coalesce(CASE WHEN p_size > 10 THEN p_retailprice END, q.cap) AS "MarketCap", CAST(p_size AS DOUBLE) AS "SharesOutstanding", q.beta AS "Beta"
FROM part LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS cap, min(l_discount) AS beta FROM lineitem GROUP BY 1) q
ON q.l_partkey = p_partkey
""")
def listing_ratios(spark, sf):
    name = F.concat(F.upper("p_name"), F.col("p_partkey").cast("string"))
    parts = table(spark, sf, "part")
    listing = parts.select(
        name.alias("symbol"), F.col("p_name").alias("name"), F.col("p_type").alias("tag"),
        F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("market_cap"),
        F.col("p_size").cast("double").alias("supply"), F.lit(None).cast("double").alias("change_24h"),
        F.lit(None).cast("double").alias("change_7d"))
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.max("l_extendedprice").alias("MarketCap"), F.min("l_discount").alias("Beta"))
    second = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(name, F.lit("-USD")).alias("Ticker"), "Beta", "MarketCap")
    out = FU.listing_ratios(listing, second, day("2024-01-30"))
    return out.select("Ticker", "Name", "Industry", "MarketCap", "SharesOutstanding", "Beta")


@query("observed_tags", """
WITH r AS (SELECT c_custkey, CASE WHEN c_acctbal > 500 THEN c_name END AS symbol,
                  CASE WHEN c_nationkey < 5 THEN 'etf' WHEN c_nationkey < 15 THEN 'EQUITY' END AS kind,
                  CASE WHEN c_acctbal < 3000 THEN ' ' ELSE c_mktsegment END AS sector,
                  CASE WHEN c_acctbal < 2000 THEN NULL ELSE c_name END AS industry FROM customer),
     p AS (SELECT *, symbol IS NOT NULL OR kind IS NOT NULL AS proven, coalesce(kind = 'etf', false) AS exempt FROM r)
SELECT c_custkey AS "Ticker", CASE WHEN proven AND trim(sector) <> '' THEN sector ELSE '' END AS "Sector",
       CASE WHEN proven AND industry IS NOT NULL THEN industry ELSE '' END AS "Industry",
       CASE WHEN proven THEN upper(coalesce(kind, '')) ELSE '' END AS "QuoteType",
       concat_ws(',', CASE WHEN NOT proven OR (trim(sector) = '' AND NOT exempt) THEN 'Sector' END,
                        CASE WHEN NOT proven OR (industry IS NULL AND NOT exempt) THEN 'Industry' END,
                        CASE WHEN NOT proven THEN 'QuoteType' END) AS fields
FROM p
""")
def observed_tags(spark, sf):
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    records = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Ticker"), F.when(balance > 500, F.col("c_name")).alias("symbol"),
        F.when(nation < 5, "etf").when(nation < 15, "EQUITY").alias("quoteType"),
        F.when(balance < 3000, " ").otherwise(F.col("c_mktsegment")).alias("sector"),
        F.when(balance >= 2000, F.col("c_name")).alias("industry"))
    return FU.observe_tags(records).withColumn("fields", F.array_join("fields", ","))


@query("cumulative_reports", """
SELECT l_suppkey, year, report_key, CAST(sum(r) OVER (PARTITION BY l_suppkey, year ORDER BY report_key) AS DOUBLE) AS revenue
FROM (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(quarter(l_shipdate) AS INTEGER) AS report_key,
             sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS r FROM lineitem GROUP BY 1, 2, 3)
""")
def cumulative_reports(spark, sf):
    return cumulative(spark, sf).select("l_suppkey", "year", "report_key", F.col("revenue").cast("double").alias("revenue"))
