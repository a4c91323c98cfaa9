"""Scalar expressions over columns of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard import functions as X
from panelyard.workload.base import bars, incoming, named_panel, query, stored, table


@query("normalise_ticker", """
WITH raw AS (SELECT p_partkey, ' $' || lower(replace(p_name, ' ', '.')) || '#' || p_size
                    || CASE p_size % 4 WHEN 0 THEN '.to' WHEN 1 THEN '.l' WHEN 2 THEN '.b' ELSE '' END || ' ' AS raw FROM part),
     up AS (SELECT p_partkey, replace(upper(trim(raw)), '$', '') AS u FROM raw),
     cut AS (SELECT p_partkey, regexp_extract(u, '(\\.([A-Z]{2,3}|[LVFT]))$', 1) AS suffix,
                    regexp_replace(u, '\\.([A-Z]{2,3}|[LVFT])$', '') AS base FROM up)
SELECT p_partkey, regexp_replace(replace(base, '.', '-'), '[^A-Z0-9-]', '', 'g') || suffix AS ticker FROM cut
""")
def normalise_ticker(spark, sf):
    kind = F.col("p_size") % 4
    tail = F.when(kind == 0, ".to").when(kind == 1, ".l").when(kind == 2, ".b").otherwise("")
    raw = F.concat(F.lit(" $"), F.lower(F.replace("p_name", F.lit(" "), F.lit("."))), F.lit("#"),
                   F.col("p_size").cast("string"), tail, F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", X.normalise_ticker(raw).alias("ticker"))


@query("zero_fill", """
SELECT o_orderkey, CASE WHEN length(s) < 6 THEN lpad(s, 6, '0') ELSE s END AS code
FROM (SELECT o_orderkey, CAST(o_orderkey * 97 AS VARCHAR) AS s FROM orders)
""")
def zero_fill(spark, sf):
    code = (F.col("o_orderkey") * 97).cast("string")
    return table(spark, sf, "orders").select("o_orderkey", X.zero_fill(code).alias("code"))


@query("parse_amount", """
SELECT o_orderkey, TRY_CAST(replace(trim(CASE o_orderstatus WHEN 'P' THEN '-' WHEN 'F' THEN ' ' || whole || ' '
       ELSE o_orderpriority END), ',', '') AS DOUBLE) AS amount
FROM (SELECT *, format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS whole FROM orders)
""")
def parse_amount(spark, sf):
    text = (F.when(F.col("o_orderstatus") == "P", "-")
            .when(F.col("o_orderstatus") == "F", F.concat(
                F.lit(" "), F.format_number(F.floor("o_totalprice"), 0), F.lit(" ")))
            .otherwise(F.col("o_orderpriority")))
    return table(spark, sf, "orders").select("o_orderkey", X.parse_amount(text).alias("amount"))


@query("loose_number", """
SELECT event_id, TRY_CAST(nullif(regexp_replace(props, '[^0-9.\\-]', '', 'g'), '') AS DOUBLE) AS k FROM events
""")
def loose_number(spark, sf):
    return table(spark, sf, "events").select("event_id", X.loose_number(F.col("props")).alias("k"))


@query("tick_size", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate::DATE AS ship_day,
       CASE WHEN p < 2000 THEN 1e0 WHEN p < 5000 THEN 5e0 WHEN p < 20000 THEN 10e0 WHEN p < 50000 THEN 50e0
            WHEN p < 200000 THEN 100e0 WHEN p < 500000 THEN 500e0 ELSE 1000e0 END AS tick
FROM (SELECT *, l_extendedprice * 10 AS p FROM lineitem)
""")
def tick_size(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.to_date("l_shipdate").alias("ship_day"), X.tick_size(F.col("l_extendedprice") * 10).alias("tick"))


@query("finite_values", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS value,
       CASE WHEN o_totalprice >= 50000 THEN o_totalprice * 100e0 END AS percent
FROM orders
""")
def finite_values(spark, sf):
    """Small totals become infinite or NaN first, then missing."""
    price = F.col("o_totalprice")
    wild = F.when(price < 50000, F.lit(float("nan"))).when(price < 100000, F.lit(float("inf"))).otherwise(price)
    broken = F.when(price < 50000, F.lit(float("nan"))).otherwise(price)
    return table(spark, sf, "orders").select("o_orderkey", X.finite_or_null(wild).alias("value"),
                                             X.fraction_to_percent(broken).alias("percent"))


@query("compare_values", """
SELECT s.entity, s.day, s.close IS NOT DISTINCT FROM n.close AS same,
       CASE WHEN n.close IS NULL THEN false ELSE TRY_CAST(s.close AS VARCHAR) IS NOT NULL AND s.close = n.close END AS same_text,
       abs(s.close - n.close) <= greatest(1e-7 * greatest(abs(s.close), abs(n.close)), 1e-8) AS near,
       CASE WHEN s.close > 0 AND n.close > 0 THEN greatest(s.close, n.close) / least(s.close, n.close) END AS ratio
FROM stored s LEFT JOIN incoming n ON n.entity = s.entity AND n.day = s.day
""", ("stored", "incoming"))
def compare_values(spark, sf):
    both = stored(spark, sf).select("entity", "day", "close").join(
        incoming(spark, sf).select("entity", "day", F.col("close").alias("new")), ["entity", "day"], "left")
    old, new = F.col("close"), F.col("new")
    return both.select("entity", "day", X.same_value(old, new).alias("same"),
                       X.same_text(old.cast("string"), new.cast("string")).alias("same_text"),
                       X.is_close(old, new).alias("near"), X.symmetric_ratio(old, new).alias("ratio"))


@query("change_code", """
WITH c AS (SELECT s.entity, s.day, n.close - s.close AS d, CAST(s.volume % 6 AS VARCHAR) AS code
           FROM stored s LEFT JOIN incoming n ON n.entity = s.entity AND n.day = s.day)
SELECT entity, day, d AS change,
       CASE WHEN d > 0 THEN CASE WHEN code IN ('1', '4') THEN code ELSE '1' END
            WHEN d < 0 THEN CASE WHEN code IN ('2', '5') THEN code ELSE '2' END
            WHEN d = 0 THEN CASE WHEN code IN ('3', '0') THEN code ELSE '3' END END AS code FROM c
""", ("stored", "incoming"))
def change_code(spark, sf):
    both = stored(spark, sf).join(incoming(spark, sf).select("entity", "day", F.col("close").alias("new")),
                                  ["entity", "day"], "left")
    change = F.col("new") - F.col("close")
    return both.select("entity", "day", change.alias("change"),
                       X.direction_code(change, (F.col("volume") % 6).cast("string")).alias("code"))


@query("turnover", "SELECT entity, day, close * volume AS amount FROM bars", ("bars",))
def turnover(spark, sf):
    return bars(spark, sf).select("entity", "day", X.turnover(F.col("close"), F.col("volume")).alias("amount"))


@query("per_share", """
SELECT s_suppkey, CASE WHEN s_acctbal - 2000 > 0 THEN CAST(s_nationkey AS DOUBLE) / (s_acctbal - 2000) END AS eps FROM supplier
""")
def per_share(spark, sf):
    eps = X.per_share(F.col("s_nationkey").cast("double"), F.col("s_acctbal") - 2000)
    return table(spark, sf, "supplier").select("s_suppkey", eps.alias("eps"))


@query("symbols", """
SELECT entity, max(regexp_replace(upper(trim(ticker || '-usd')), '-USDT?$', '')) AS base,
       max(regexp_replace(upper(ticker), '-USDT?$', '') || CAST(entity AS VARCHAR) || '-USD') AS symbol,
       max(coalesce(nullif(regexp_extract(ticker, '\\.(HK|L)$'), ''), 'us')) AS cohort
FROM panel GROUP BY entity
""", ("panel",))
def symbols(spark, sf):
    rows = named_panel(spark, sf)
    ticker = F.col("ticker")
    return rows.groupBy("entity").agg(
        F.max(X.strip_quote(F.concat(ticker, F.lit("-usd")))).alias("base"),
        F.max(X.id_symbol(X.strip_quote(ticker), F.col("entity"))).alias("symbol"),
        F.max(X.cohort_of(ticker, "us")).alias("cohort"))


@query("period_dates", """
SELECT o_orderkey, CAST(quarter(d) AS INTEGER) AS quarter, last_day(make_date(year(d), quarter(d) * 3, 1)) AS quarter_end,
       d - CAST(greatest(isodow(d) - 5, 0) AS INTEGER) AS last_weekday,
       last_day(d) - CAST(greatest(isodow(last_day(d)) - 5, 0) AS INTEGER) AS month_end,
       strftime(d, '%Y%m%d') AS day_text, d AS day
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
""")
def period_dates(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    d, text = F.col("d"), F.date_format("d", "yyyyMMdd")
    return rows.select("o_orderkey", F.quarter(d).alias("quarter"),
                       X.quarter_end(F.year(d), F.quarter(d)).alias("quarter_end"),
                       X.last_weekday(d).alias("last_weekday"), X.month_end_weekday(d).alias("month_end"),
                       text.alias("day_text"), X.text_day(text).alias("day"))


@query("weekday_numbers", """
SELECT o_orderkey, d AS day, CAST((SELECT count(*) FROM range(0, 14) r(i) WHERE d - CAST(i AS INTEGER) > d - 14
       AND isodow(d - CAST(i AS INTEGER)) < 6) AS INTEGER) AS weekdays_in_14
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
""")
def weekday_numbers(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    span = X.weekday_floor(F.col("day")) - X.weekday_floor(F.date_sub("day", 14))
    return rows.select("o_orderkey", "day", span.alias("weekdays_in_14"))

