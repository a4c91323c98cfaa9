"""Whole jobs over a scratch lake: feeds derived from the given tables are landed, and the stored tables read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.operators import fundamentals as FU
from panelyard.operators.calendar import day_range, session_status
from panelyard.plans import jobs as J
from panelyard.plans.lake import Lake
from panelyard.schemas import KR_BARS, conform
from panelyard.session import scratch_path
from panelyard.workload.base import query, table

_COLUMNS = ["Ticker", "Date", "Open", "High", "Low", "Close", "Volume", "Amount", "ChangesRatio"]

_STORED_SQL = """
SELECT Ticker, day AS Date, open AS Open, high AS High, low AS Low, close AS Close, volume AS Volume, close * volume AS Amount,
       (close / lag(close) OVER (PARTITION BY Ticker ORDER BY day) - 1) * 100 AS ChangesRatio
FROM (SELECT {ticker} AS Ticker, CAST({time} AS DATE) AS day, arg_min({value}, {order}) AS open, max({value}) AS high,
             min({value}) AS low, arg_max({value}, {order}) AS close, CAST(count(*) AS DOUBLE) AS volume
      FROM {table} {where} GROUP BY 1, 2)"""


def _raw(rows: DataFrame, ticker, time, value: str, order: str) -> DataFrame:
    """Provider rows: daily bars without corporate actions."""
    return rows.groupBy(ticker.alias("Ticker"), F.to_date(time).alias("Date")).agg(
        F.min_by(value, order).alias("Open"), F.max(value).alias("High"), F.min(value).alias("Low"),
        F.max_by(value, order).alias("Close"), F.count(F.lit(1)).cast("double").alias("Volume")).withColumns(
        {"Dividends": F.lit(0.0), "Stock Splits": F.lit(0.0)})


def _nobody(raw: DataFrame) -> DataFrame:
    return raw.select("Ticker").where(F.lit(False))


def _day(text: str):
    return F.lit(text).cast("date")


def _orders(spark, sf) -> DataFrame:
    ticker = F.concat(F.lit("C"), (F.col("o_custkey") % 8).cast("string"))
    return _raw(table(spark, sf, "orders"), ticker, "o_orderdate", "o_totalprice", "o_orderkey")


_ORDERS_SQL = {"ticker": "'C' || (o_custkey % 8)", "time": "o_orderdate", "value": "o_totalprice", "order": "o_orderkey",
               "table": "orders"}


@query("job_update_bars", _STORED_SQL.format(ticker="'B' || (user_id % 8)", time="ts", value="value", order="ts",
                                             table="events", where=""))
def job_update_bars(spark, sf):
    """Two incremental runs of the crypto market with overlapping windows."""
    ticker = F.concat(F.lit("B"), (F.col("user_id") % 8).cast("string"))
    raw = _raw(table(spark, sf, "events"), ticker, "ts", "value", "ts")
    lake, everyone = Lake(spark, scratch_path(spark, "lake")), raw.select("Ticker").distinct()
    limits = J.Limits(shrink_pct=100.0)
    for first, last in (("2023-01-01", "2024-01-20"), ("2024-01-10", "2030-01-01")):
        window = raw.where(F.col("Date").between(_day(first), _day(last)))
        today = window.agg(F.max("Date")).scalar()
        J.update_bars(lake, "crypto", window, everyone, _nobody(raw), today, limits=limits)
    return lake.read(lake.bars("crypto")).select(*_COLUMNS)


@query("job_backfill_bars", _STORED_SQL.format(where="", **_ORDERS_SQL))
def job_backfill_bars(spark, sf):
    """Years landed out of order: a year put in between gives the next year's first changes new predecessors."""
    raw, lake = _orders(spark, sf), Lake(spark, scratch_path(spark, "lake"))
    late = F.year("Date").isin(1996, 1998)
    for part in (raw.where(~late), raw.where(late)):
        J.backfill_bars(lake, "us", part, _nobody(raw))
    return lake.read(lake.bars("us")).select(*_COLUMNS)


@query("purge_untouched_year", _STORED_SQL.format(
    where="WHERE o_custkey % 8 <> 3 OR year(o_orderdate) = 1997", **_ORDERS_SQL))
def purge_untouched_year(spark, sf):
    """A corrected symbol refetched for one year: what it stored in every other year was another instrument's."""
    raw, lake = _orders(spark, sf), Lake(spark, scratch_path(spark, "lake"))
    J.backfill_bars(lake, "us", raw, _nobody(raw))
    again = raw.where((F.col("Ticker") == "C3") & (F.year("Date") == 1997))
    named = spark.range(1).select(F.lit("C3").alias("ticker"), F.lit("C3X").alias("symbol"))
    J.backfill_bars(lake, "us", again, _nobody(raw), named, J.Limits(allow_shrink=True))
    return lake.read(lake.bars("us")).select(*_COLUMNS)


@query("job_backfill_new", _STORED_SQL.format(where="", **_ORDERS_SQL))
def job_backfill_new(spark, sf):
    """One entity is new: only its history is taken, what is stored of the others stays."""
    raw, lake = _orders(spark, sf), Lake(spark, scratch_path(spark, "lake"))
    J.backfill_bars(lake, "us", raw.where("Ticker <> 'C5'"), _nobody(raw))
    J.backfill_new(lake, "us", raw, raw.select("Ticker").distinct(), _nobody(raw))
    return lake.read(lake.bars("us")).select(*_COLUMNS)


@query("job_rebase", _STORED_SQL.format(where="", **_ORDERS_SQL))
def job_rebase(spark, sf):
    """Prices of two entities stored in another unit; their whole history is replaced."""
    raw, lake = _orders(spark, sf), Lake(spark, scratch_path(spark, "lake"))
    acted = F.col("Ticker").isin("C1", "C6")
    scaled = {c: F.when(acted, F.col(c) * 2).otherwise(F.col(c)) for c in ("Open", "High", "Low", "Close")}
    J.backfill_bars(lake, "us", raw.withColumns(scaled), _nobody(raw))
    targets = raw.select("Ticker").where(acted).distinct()
    J.rebase_bars(lake, "us", raw, _nobody(raw), targets=targets)
    return lake.read(lake.bars("us")).select(*_COLUMNS)


# ---- the KR panel: lines shipped by a supplier group, a day

_KR_COLUMNS = ["Code", "Date", "Close", "Volume"]
_KR_SQL = """
SELECT lpad(CAST(l_suppkey % 40 AS VARCHAR), 6, '0') AS Code, CAST(l_shipdate AS DATE) AS Date,
       CAST(1000 + l_suppkey % 40 AS DOUBLE) AS Close, CAST(count(*) AS BIGINT) AS Volume
FROM lineitem {where} GROUP BY 1, 2, 3"""


def _kr(lines: DataFrame, close=None, date=None, cap: bool = True) -> DataFrame:
    """Bars of supplier groups: a constant close each, the lines shipped as volume."""
    group = F.col("l_suppkey") % 40
    price = (1000 + group).cast("double")
    price = price if close is None else price * close
    rows = lines.groupBy(F.lpad(group.cast("string"), 6, "0").alias("Code"), (F.to_date("l_shipdate") if date is None else date)
                         .alias("Date"), price.alias("Close")).agg(F.count(F.lit(1)).alias("Volume"))
    cap = F.lit(1e6) + F.col("Close") if cap else F.lit(None).cast("double")
    return conform(rows.withColumns({"Open": F.col("Close"), "High": F.col("Close"), "Low": F.col("Close"), "Marcap": cap,
                                     "Name": F.concat(F.lit("N"), "Code"), "MarketId": F.lit("STK"),
                                     "Market": F.lit("KOSPI")}), KR_BARS)


_KR_LIMITS = J.Limits(min_universe=1000)


@query("job_settle_years", _KR_SQL.format(where="WHERE l_returnflag <> 'R' OR year(l_shipdate) <> 1998"))
def job_settle_years(spark, sf):
    """All years settled at once by official rows; the year whose official closes all moved is refused and stays."""
    lake, lines = Lake(spark, scratch_path(spark, "lake")), table(spark, sf, "lineitem")
    J.save_kr_bars(lake, _kr(lines.where("l_returnflag <> 'R'")), limits=_KR_LIMITS)
    off = F.when(F.year("l_shipdate") == 1998, 1.5).otherwise(1.0)
    J.settle_kr_years(lake, _kr(lines, off), range(1995, 2002), _day("1990-01-01"), _KR_LIMITS, first_year=1995, refuse=False)
    return lake.read(lake.bars("kr")).select(*_KR_COLUMNS)


@query("job_settle_report", """
WITH o AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_shipdate AS DATE) AS day, l_suppkey % 40 AS c, count(*) AS n,
                  count(*) FILTER (l_returnflag <> 'R') AS held FROM lineitem GROUP BY 1, 2, 3)
SELECT year, CASE WHEN year = 1998 THEN 'mass_change' END AS refused, max(day) AS official_through,
       CAST(count(*) FILTER (held = 0) AS BIGINT) AS rows_added,
       CASE WHEN year = 1998 THEN CAST(count(*) FILTER (held = 0) AS BIGINT) ELSE 0 END AS missing_rows,
       CASE WHEN year = 1998 THEN CAST(count(*) FILTER (held > 0) AS BIGINT) ELSE 0 END AS mismatched_rows
FROM o GROUP BY year""")
def job_settle_report(spark, sf):
    """The same settlement's verdicts, a row per year, with what differs afterwards."""
    lake, lines = Lake(spark, scratch_path(spark, "lake")), table(spark, sf, "lineitem")
    J.save_kr_bars(lake, _kr(lines.where("l_returnflag <> 'R'")), limits=_KR_LIMITS)
    off = F.when(F.year("l_shipdate") == 1998, 1.5).otherwise(1.0)
    out = J.settle_kr_years(lake, _kr(lines, off), range(1995, 2002), _day("1990-01-01"), _KR_LIMITS, first_year=1995,
                            refuse=False)
    return out.select("year", "refused", "official_through", "rows_added", "missing_rows", "mismatched_rows")


@query("job_kr_backfill", _KR_SQL.format(where="WHERE year(l_shipdate) >= 1998 OR l_suppkey % 40 < 30"))
def job_kr_backfill(spark, sf):
    """Years before the stored ones from a second provider, whose closes of ten supplier groups disagree: those stay out."""
    lake, lines = Lake(spark, scratch_path(spark, "lake")), table(spark, sf, "lineitem")
    J.save_kr_bars(lake, _kr(lines.where(F.year("l_shipdate") >= 1998)), limits=_KR_LIMITS)
    other = _kr(lines, F.when(F.col("l_suppkey") % 40 < 30, 1.0).otherwise(2.0), cap=False)
    J.kr_backfill(lake, other, _day("1992-01-01"), _day("2009-12-31"), limits=_KR_LIMITS)
    return lake.read(lake.bars("kr")).select(*_KR_COLUMNS)


@query("job_kr_daily", _KR_SQL.format(where="""
WHERE (l_suppkey % 40 <> 7 OR year(l_shipdate) = 1995) AND (l_shipdate <= DATE '1998-12-20' OR
      (l_suppkey % 40 <> 7 AND l_shipdate < DATE '1999-01-11' AND isodow(l_shipdate) < 6))""") + """
UNION ALL SELECT lpad(CAST(l_suppkey % 40 AS VARCHAR), 6, '0'), DATE '1999-01-11', CAST(1000 + l_suppkey % 40 AS DOUBLE), CAST(count(*) AS BIGINT)
FROM lineitem GROUP BY 1, 2, 3""")
def job_kr_daily(spark, sf):
    """A day after a gap over New Year, without a snapshot: the sessions missed come from the archive, today's rows from the
    second provider for everyone whose closes agree, also for a group whose last stored bar is three years old."""
    lake, lines = Lake(spark, scratch_path(spark, "lake")), table(spark, sf, "lineitem")
    gone = F.col("l_suppkey") % 40 == 7
    past = lines.where("l_shipdate <= DATE '1998-12-20'").where(~gone | (F.year("l_shipdate") == 1995))
    J.save_kr_bars(lake, _kr(past), limits=_KR_LIMITS)
    days = day_range(spark, "1998-12-01", "1999-01-31")
    status = session_status(days, days.select("date", F.lit("none").alias("name")).where(F.lit(False)),
                            days.select(F.year("date").alias("year")))
    second = _kr(lines.where("l_shipdate <= DATE '1998-12-20'"), cap=False).unionByName(
        _kr(lines, date=_day("1999-01-11"), cap=False))
    J.kr_daily(lake, "1999-01-11", status, None, _kr(lines.where(~gone)), second, limits=_KR_LIMITS)
    return lake.read(lake.bars("kr")).select(*_KR_COLUMNS)


@query("job_kr_fundamentals", """
WITH l AS (SELECT lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS t, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(quarter(l_shipdate) AS INTEGER) AS q,
                  CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2, 3),
     g AS (SELECT t, y, q FROM (SELECT DISTINCT t FROM l), (SELECT DISTINCT y FROM l), (SELECT unnest([1, 2, 3, 4]) AS q))
SELECT g.t AS "Ticker", CAST(g.y AS INTEGER) AS "Year", CAST(g.q AS INTEGER) AS "Quarter", CAST(coalesce(n, 0) AS DOUBLE) AS "Revenue"
FROM g LEFT JOIN l ON l.t = g.t AND l.y = g.y AND l.q = g.q""")
def job_kr_fundamentals(spark, sf):
    """Cumulative reports of every supplier landed as account rows; stored by quarter after the universe and the share of
    failed requests were judged, and landed again without a change."""
    lines = table(spark, sf, "lineitem").select(
        F.lpad(F.col("l_suppkey").cast("string"), 6, "0").alias("code"), F.year("l_shipdate").alias("year"),
        F.quarter("l_shipdate").alias("quarter"), "l_quantity")
    years = lines.select("year").distinct()
    # a report for every quarter, holding the sum of its year so far
    keys = F.explode(F.sequence(F.lit(1), F.lit(4))).alias("report_key")
    codes = lines.select("code").distinct().withColumn("_", F.lit(1))
    grid = codes.join(years.withColumn("_", F.lit(1)), "_").select("code", "year", keys)
    sums = lines.groupBy("code", "year", "quarter").agg(F.sum("l_quantity").alias("n"))
    reports = grid.join(sums, ["code", "year"], "left").groupBy("code", "year", "report_key").agg(
        F.coalesce(F.sum(F.when(F.col("quarter") <= F.col("report_key"), F.col("n"))), F.lit(0)).cast("long").alias("so_far"))
    accounts = reports.select("code", "year", "report_key", F.lit("CFS").alias("fs_div"), F.lit("IS").alias("sj_div"),
                              F.lit("매출액").alias("account_nm"), F.lit("0").alias("thstrm_amount"),
                              F.col("so_far").cast("string").alias("thstrm_add_amount"), F.lit(1).alias("ord"))
    universe = codes.select(F.col("code").alias("Code"), F.lit(10).cast("long").alias("Stocks"))
    newest = lines.agg(F.max(F.make_date("year", F.lit(12), F.lit(31))).alias("source_date"))
    stored = newest.select("source_date", F.col("source_date").alias("latest_known_date"))
    proof = FU.verify_universe(stored, newest.select("source_date", F.col("source_date").alias("observed_date")), F.lit(0),
                               newest.select("source_date").scalar())
    requests = reports.select((F.col("so_far") < 0).alias("failed"))
    lake = Lake(spark, scratch_path(spark, "lake"))
    for _ in range(2):
        J.kr_fundamentals(lake, accounts, universe, _day("2009-01-01"), requests=requests, proof=proof)
    return lake.read(lake.financials("kr")).select("Ticker", "Year", "Quarter", "Revenue")
