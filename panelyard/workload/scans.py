"""Sources: validity checks, reshaping and parsing over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.schemas import KR_BARS, conform
from panelyard.session import scratch_path
from panelyard.sources import checks as K
from panelyard.sources import readers as R
from panelyard.sources import reshape as S
from panelyard.workload.base import bars, named_panel, official, query, stored, table
from panelyard.workload.windows import quarter_sums


@query("validate_keys", """
WITH k AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS partition, l_orderkey, l_linenumber, count(*) AS n,
                  count(*) FILTER (l_discount > 0.09) AS d FROM lineitem GROUP BY 1, 2, 3)
SELECT partition, CAST(sum(n) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS blank_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
       CAST(0 AS BIGINT) AS wrong_partition, CAST(sum(d) AS BIGINT) AS deep_discount, sum(d) + sum(n - 1) = 0 AS ok FROM k GROUP BY 1
""")
def validate_keys(spark, sf):
    year = F.year("l_shipdate")
    return K.validate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], year, year,
                           {"deep_discount": F.col("l_discount") > 0.09})


@query("validate_bars", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS partition, CAST(count(*) AS BIGINT) AS "rows",
       CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 1) AS BIGINT) AS blank_keys,
       CAST(count(*) - count(DISTINCT {'a': CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 1 THEN '' ELSE CAST(l_partkey AS VARCHAR) END, 'b': l_shipdate}) AS BIGINT) AS duplicate_rows,
       CAST(count(*) FILTER (month(l_shipdate) = 12 AND l_quantity = 50) AS BIGINT) AS wrong_partition,
       count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 1) = 0
         AND count(*) = count(DISTINCT {'a': l_partkey, 'b': l_shipdate})
         AND count(*) FILTER (month(l_shipdate) = 12 AND l_quantity = 50) = 0 AS ok
FROM (SELECT *, month(l_shipdate) = 12 AND l_quantity = 50 AS moved FROM lineitem) WHERE NOT moved GROUP BY 1
UNION ALL
SELECT CAST(year(l_shipdate) + 100 AS INTEGER), CAST(count(*) AS BIGINT),
       CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity = 1) AS BIGINT),
       CAST(count(*) - count(DISTINCT {'a': CAST(l_partkey AS VARCHAR), 'b': l_shipdate}) AS BIGINT), CAST(count(*) AS BIGINT), false
FROM lineitem WHERE month(l_shipdate) = 12 AND l_quantity = 50 GROUP BY 1
""")
def validate_bars(spark, sf):
    """Lines as bars of parts; some December rows lie in the wrong partition, some part keys are blank."""
    blank = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O") & (F.col("l_quantity") == 1)
    moved = (F.month("l_shipdate") == 12) & (F.col("l_quantity") == 50)
    rows = table(spark, sf, "lineitem").select(
        F.when(blank, " ").otherwise(F.col("l_partkey").cast("string")).alias("entity"),
        F.to_date("l_shipdate").alias("day"),
        (F.year("l_shipdate") + F.when(moved, 100).otherwise(0)).alias("year"))
    return K.validate_bars(rows, "entity", "day", F.col("year"))


@query("validate_fundamentals", """
WITH q AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(quarter(l_shipdate) AS INTEGER) AS k,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1, 2, 3)
SELECT y AS partition, CAST(count(*) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS blank_keys, CAST(0 AS BIGINT) AS duplicate_rows,
       CAST(0 AS BIGINT) AS wrong_partition, CAST(count(*) FILTER (k = 3) AS BIGINT) AS untrimmed,
       CAST(count(*) FILTER (k = 4 AND revenue > 1000000) AS BIGINT) AS bad_value, CAST(count(*) FILTER (k = 2) AS BIGINT) AS bad_period,
       count(*) FILTER (k = 3 OR k = 2 OR (k = 4 AND revenue > 1000000)) = 0 AS ok FROM q GROUP BY 1
""")
def validate_fundamentals(spark, sf):
    """Quarters of suppliers, with untrimmed names, infinities and wrong quarter numbers planted in some quarters."""
    k = F.col("report_key")
    revenue = F.col("revenue").cast("double")
    rows = quarter_sums(spark, sf).select(
        F.concat(F.col("l_suppkey").cast("string"), F.when(k == 3, " ").otherwise("")).alias("Ticker"),
        F.last_day(F.make_date("year", k * 3, F.lit(1))).alias("PeriodDate"), F.col("year").alias("Year"),
        F.when(k == 2, 1).otherwise(k).alias("Quarter"),
        F.when((k == 4) & (revenue > 1000000), F.lit(float("inf"))).otherwise(revenue).alias("Revenue"))
    return K.validate_fundamentals(rows, "Ticker", "PeriodDate", ["Revenue"])


@query("ratio_infinities", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS pe FROM orders
""")
def ratio_infinities(spark, sf):
    pe = F.when(F.col("o_totalprice") < 100000, F.lit(float("-inf"))).otherwise(F.col("o_totalprice"))
    return K.infinity_to_null(table(spark, sf, "orders").select("o_orderkey", pe.alias("pe")), ["pe"])


@query("validate_tags", """
SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS blank_keys,
       CAST(count(*) - count(DISTINCT upper(p_name)) AS BIGINT) AS duplicate_rows,
       CAST(count(*) FILTER (p_size < 3) AS BIGINT) AS blank_market, CAST(count(*) FILTER (p_size > 48) AS BIGINT) AS bad_stamp,
       count(*) = count(DISTINCT upper(p_name)) AND count(*) FILTER (p_size < 3 OR p_size > 48) = 0 AS ok FROM part
""")
def validate_tags(spark, sf):
    raw = table(spark, sf, "part").select(
        F.concat(F.col("p_name"), F.lit(" ")).alias("Ticker"), F.when(F.col("p_size") >= 3, "US").alias("Market"),
        F.col("p_type").alias("Sector"), F.lit(None).cast("string").alias("Industry"),
        F.when(F.col("p_size") > 48, "soon").otherwise("2024-01-01T00:00:00").alias("updated_at"))
    return K.validate_tags(K.upgrade_tags(raw))


@query("upgraded_tags", """
SELECT CAST(p_partkey AS VARCHAR) AS "Ticker", 'US' AS "Market", p_type AS "Sector", '' AS "Industry",
       '2024-01-01T00:00:00' AS updated_at, '' AS "QuoteType" FROM part
""")
def upgraded_tags(spark, sf):
    raw = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Ticker"), F.lit("US").alias("Market"), F.col("p_type").alias("Sector"),
        F.lit(None).cast("string").alias("Industry"), F.lit("2024-01-01T00:00:00").alias("updated_at"))
    return K.upgrade_tags(raw)


@query("validate_snapshot", """
WITH s AS (SELECT day, lpad(CAST(entity AS VARCHAR), CASE WHEN volume = 1 THEN 5 ELSE 6 END, '0') AS code,
                  CASE WHEN close < 20 THEN 'XXX' ELSE 'STK' END AS m, CASE WHEN volume > 4 THEN day - 1 ELSE day END AS own FROM bars)
SELECT day AS partition, CAST(count(*) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS blank_keys,
       CAST(count(*) - count(DISTINCT code) AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS wrong_partition,
       CAST(count(*) FILTER (length(code) <> 6) AS BIGINT) AS bad_code, CAST(count(*) FILTER (m = 'XXX') AS BIGINT) AS bad_market,
       CAST(count(*) FILTER (own <> day) AS BIGINT) AS bad_date,
       count(*) = count(DISTINCT code) AND count(*) FILTER (length(code) <> 6 OR m = 'XXX' OR own <> day) = 0 AS ok FROM s GROUP BY day
""", ("bars",))
def validate_snapshot(spark, sf):
    text = F.col("entity").cast("string")
    rows = bars(spark, sf).select(
        "day", F.when(F.col("volume") == 1, F.lpad(text, 5, "0")).otherwise(F.lpad(text, 6, "0")).alias("Code"),
        F.when(F.col("close") < 20, "XXX").otherwise("STK").alias("MarketId"),
        F.when(F.col("volume") > 4, F.date_sub("day", 1)).otherwise(F.col("day")).alias("Date"))
    return K.validate_snapshot(rows, "Code", "MarketId", F.col("day"), "Date")


@query("snapshot_date_proof", """
SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(count(*) FILTER (day <> DATE '2024-01-30') AS BIGINT) AS mismatched,
       count(*) > 0 AND count(*) FILTER (day <> DATE '2024-01-30') = 0 AS ok FROM bars
""", ("bars",))
def snapshot_date_proof(spark, sf):
    rows = bars(spark, sf)
    proof = rows.agg(F.max("day").cast("string").alias("source_date"))
    return K.undated_rows(rows, proof, "day")


@query("validate_official", """
SELECT CAST(year(day) AS INTEGER) AS partition, CAST(count(*) AS BIGINT) AS "rows", CAST(0 AS BIGINT) AS blank_keys,
       CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS wrong_partition, CAST(0 AS BIGINT) AS bad_code,
       CAST(count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY')) AS BIGINT) AS bad_market,
       CAST(count(*) FILTER (amount - 30 < 0) AS BIGINT) AS bad_value, CAST(count(*) FILTER (volume >= 5) AS BIGINT) AS no_close,
       CAST(count(*) FILTER (high > low) AS BIGINT) AS crossed, false AS ok
FROM official JOIN customer ON c_custkey = entity GROUP BY 1
""", ("official",))
def validate_official(spark, sf):
    """Official bars with high and low exchanged and other faults planted; one verdict row per year."""
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("market"))
    rows = official(spark, sf).join(names, "entity").select(
        F.lpad(F.col("entity").cast("string"), 6, "0").alias("Code"), F.col("day").alias("Date"),
        F.col("open").alias("Open"), F.col("low").alias("High"), F.col("high").alias("Low"),
        F.when(F.col("volume") < 5, F.col("close")).alias("Close"), F.col("volume").alias("Volume"),
        (F.col("amount") - 30).alias("Amount"), F.col("amount").alias("Marcap"), F.col("volume").alias("Stocks"),
        F.col("market").alias("MarketId"))
    return K.validate_official(rows, markets=["BUILDING", "AUTOMOBILE", "MACHINERY"])


@query("listing_json", """
SELECT upper(trim(p_name)) || p_partkey AS symbol, p_partkey AS id, p_name AS name, CAST(p_size AS DOUBLE) AS supply,
       p_type AS tag, p_retailprice AS price, p_retailprice * 2 AS market_cap FROM part WHERE p_size > 1
""")
def listing_json(spark, sf):
    """Parts as listing entries in both JSON shapes, grouped into responses by brand and size, then read back."""
    quote = F.struct(F.col("p_retailprice").alias("price"), (F.col("p_retailprice") * 2).alias("marketCap"))
    quotes = F.when(F.col("p_size") > 25, F.to_json(F.array(quote))).otherwise(F.to_json(F.create_map(F.lit("USD"), quote)))
    symbol = F.when(F.col("p_size") > 1, F.concat(F.lit(" "), "p_name", F.col("p_partkey").cast("string"))).otherwise(" ")
    entry = F.struct(symbol.alias("symbol"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                     F.col("p_size").cast("double").alias("circulatingSupply"), F.array("p_type", "p_brand").alias("tags"))
    # one response per part row: an entry whose quotes are spliced in as raw JSON
    text = F.concat(F.lit("["), F.regexp_replace(F.to_json(entry), r"\}$", ""), F.lit(',"quotes":'), quotes, F.lit("}]"))
    return R.parse_listing(table(spark, sf, "part").select(text.alias("items"))).select(
        "symbol", "id", "name", "supply", "tag", "price", "market_cap")


@query("wide_to_long", """
SELECT market AS ticker, day, min(low) AS "Low", max(high) AS "High", CAST(sum(volume) AS DOUBLE) AS "Volume" FROM panel GROUP BY 1, 2
""", ("panel",))
def wide_to_long(spark, sf):
    """Bars pivoted to the provider's wide form (market|metric) and unfolded again."""
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    wide = named_panel(spark, sf).groupBy("day").pivot("market", names).agg(
        F.min("low").alias("Low"), F.max("high").alias("High"), F.sum("volume").alias("Volume"))
    renamed = wide.select("day", *[F.col(f"{n}_{m}").alias(f"{n}|{m}") for n in names for m in ("Low", "High", "Volume")])
    long = S.wide_to_long(renamed, "day", ["Low", "High", "Volume"])
    return long.where(F.col("Volume").isNotNull())


@query("statement_rows", """
SELECT l_suppkey, last_day(make_date(year(l_shipdate), quarter(l_shipdate) * 3, 1)) AS period,
       CAST(year(l_shipdate) AS INTEGER) AS "Year", CAST(quarter(l_shipdate) AS INTEGER) AS "Quarter",
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS "Revenue", max(CASE WHEN l_quantity > 48 THEN l_extendedprice END) AS "GrossProfit",
       min(l_tax) AS "TotalAssets"
FROM lineitem GROUP BY 1, 2, 3, 4
""")
def statement_rows(spark, sf):
    """Three statements as landed line items, turned into one row per supplier and quarter."""
    items = table(spark, sf, "lineitem").select(
        "l_suppkey", F.last_day(F.make_date(F.year("l_shipdate"), F.quarter("l_shipdate") * 3, F.lit(1))).alias("period"),
        "l_extendedprice", "l_quantity", "l_tax")
    sums = items.groupBy("l_suppkey", "period").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("Total Revenue"),
        F.max(F.when(F.col("l_quantity") > 48, F.col("l_extendedprice"))).alias("Gross Profit"),
        F.min("l_tax").alias("Total Assets"))
    lines = sums.unpivot(["l_suppkey", "period"], ["Total Revenue", "Gross Profit", "Total Assets"], "item", "value")
    return S.statement_rows(lines, "l_suppkey", "item", "period", "value").select(
        "l_suppkey", "period", "Year", "Quarter", "Revenue", "GrossProfit", "TotalAssets")


@query("ticker_lines", """
WITH l AS (SELECT doc_id, regexp_replace(unnest(string_split(text, chr(10))), '^[ \\t\\r\\f\\v]+|[ \\t\\r\\f\\v]+$', '', 'g') AS value FROM documents)
SELECT doc_id, CAST(count(*) AS BIGINT) AS lines, CAST(sum(length(value)) AS BIGINT) AS chars FROM l
WHERE value <> '' AND NOT starts_with(value, '#') GROUP BY doc_id
""")
def ticker_lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("value"))
    return R.ticker_lines(lines).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value").cast("long")).alias("chars"))


@query("watch_list", """
SELECT ticker FROM (SELECT CASE WHEN p_size > 40 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '.ks' ELSE p_name END AS ticker
                    FROM part WHERE p_type IN ('ECONOMY', 'PROMO')) WHERE NOT regexp_full_match(ticker, '[0-9]{6}\\.ks')
""")
def watch_list(spark, sf):
    local = F.concat(F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lit(".ks"))
    rows = table(spark, sf, "part").select(
        F.when(F.col("p_size") > 40, local).otherwise(F.col("p_name")).alias("Symbol"), F.col("p_type").alias("category"))
    return R.watch_list(rows, categories=["ECONOMY", "PROMO"])


@query("conformed_bars", """
SELECT lpad(CAST(entity AS VARCHAR), 6, '0') AS "Code", close AS "Close", volume AS "Volume", day AS "Date",
       CAST(NULL AS VARCHAR) AS "Name", CAST(NULL AS BIGINT) AS "Rank" FROM stored
""", ("stored",))
def conformed_bars(spark, sf):
    rows = stored(spark, sf).select(
        F.lpad(F.col("entity").cast("string"), 6, "0").alias("Code"), F.col("day").alias("Date"),
        F.col("close").alias("Close"), F.col("volume").alias("Volume"), F.lit(1).alias("unknown"))
    return conform(rows, KR_BARS).select("Code", "Close", "Volume", "Date", "Name", "Rank")


@query("month_partitions", """
SELECT strftime(o_orderdate, '%Y%m') AS yyyymm, CAST(count(*) AS BIGINT) AS "rows" FROM orders GROUP BY 1
""")
def month_partitions(spark, sf):
    """Orders written by month and found again partition by partition."""
    path = scratch_path(spark, "months")
    rows = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("yyyymm"))
    rows.hint("rebalance", "yyyymm").write.partitionBy("yyyymm").parquet(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("yyyymm", T.StringType())])
    return R.read_table(spark, path, schema).groupBy("yyyymm").agg(F.count(F.lit(1)).alias("rows"))


@query("partition_reads", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS "rows", max(o_orderkey) AS last_key FROM orders GROUP BY 1
""")
def partition_reads(spark, sf):
    """Orders written by year and read one partition at a time, an absent one among them."""
    from panelyard.plans.publish import partition_values
    path = scratch_path(spark, "years")
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    rows.hint("rebalance", "year").write.partitionBy("year").parquet(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType())])
    out = R.read_partition(spark, path, schema, "year", 1900)
    for year in partition_values(rows, "year"):
        out = out.unionByName(R.read_partition(spark, path, schema, "year", year))
    return out.groupBy("year").agg(F.count(F.lit(1)).alias("rows"), F.max("o_orderkey").alias("last_key"))


@query("file_inventory", """
SELECT 'orders.parquet' AS file, CAST(count(*) AS BIGINT) AS "rows" FROM orders
UNION ALL SELECT 'lineitem.parquet', CAST(count(*) AS BIGINT) FROM lineitem
""")
def file_inventory(spark, sf):
    both = R.inventory(table(spark, sf, "orders")).unionByName(R.inventory(table(spark, sf, "lineitem")))
    return both.select(F.element_at(F.split("file_path", "/"), -1).alias("file"), "rows")


@query("adhoc_sql", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
       CAST(count(*) AS BIGINT) AS n
FROM lineitem WHERE l_shipdate <= DATE '2000-09-02' GROUP BY l_returnflag, l_linestatus
""")
def adhoc_sql(spark, sf):
    R.register_tables(spark, {"lineitem": f"{sf}/lineitem.parquet"})
    return R.query(spark, """
        SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
               count(*) AS n
        FROM lineitem WHERE l_shipdate <= DATE '2000-09-02' GROUP BY l_returnflag, l_linestatus""")


@query("adhoc_join", """
SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2
""")
def adhoc_join(spark, sf):
    R.register_tables(spark, {t: f"{sf}/{t}.parquet" for t in ("orders", "customer", "nation")})
    return R.query(spark, """
        SELECT n_name, year(o_orderdate) AS year, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        GROUP BY n_name, year(o_orderdate)""")



# ---- files landed from the given tables, then read

PAGE_ORDERS = 20_000


@query("landed_listing", """
WITH e AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderdate FROM orders),
     n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM e)
SELECT 'C' || o_custkey AS symbol, o_orderkey AS id, o_totalprice AS price FROM n WHERE rn = 1""")
def landed_listing(spark, sf):
    """Listing pages as JSON files, quotes as list or as map by the day; a customer's orders are repeats of a symbol."""
    folder = scratch_path(spark, "listing")
    listing_pages(table(spark, sf, "orders")).repartition("page").write.partitionBy("page").text(folder)
    return R.read_listing(spark, f"{folder}/*").select("symbol", "id", "price")


def listing_pages(orders, most=PAGE_ORDERS):
    """``page, value``: responses of about ``most`` orders, so their number grows with the table; a customer is on one page."""
    quote = F.struct(F.col("o_totalprice").alias("price"))
    entry = lambda quotes: F.struct(F.concat(F.lit(" c"), F.col("o_custkey").cast("string")).alias("symbol"),
                                    F.col("o_orderkey").alias("id"), quotes.alias("quotes"))
    half = orders.count() // (2 * most) + 1                              # pages of either shape
    pages = None
    for shape in (F.array(quote), F.struct(quote.alias("USD"))):
        odd = 0 if pages is None else 1
        part = orders.where(F.col("o_custkey") % 2 == odd)
        page = part.groupBy((F.pmod(F.xxhash64("o_custkey"), F.lit(half)) * 2 + odd).alias("page")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), entry(shape).alias("e")))).alias("items"))
        page = page.select("page", F.to_json(F.struct(F.struct(F.col("items.e").alias("cryptoCurrencyList")).alias("data")))
                           .alias("value"))
        pages = page if pages is None else pages.unionByName(page)
    return pages


@query("landed_tickers", """
SELECT trim(c_mktsegment) || c_custkey AS ticker FROM customer WHERE c_custkey % 3 <> 0""")
def landed_tickers(spark, sf):
    """A ticker list with comments and blank lines between the symbols."""
    folder = scratch_path(spark, "tickers")
    name = F.concat("c_mktsegment", F.col("c_custkey").cast("string"))
    line = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("  "), name, F.lit("\t"))).when(
        F.col("c_custkey") % 2 == 0, F.concat(F.lit("# "), name)).otherwise("   ")
    table(spark, sf, "customer").select(line.alias("value")).write.text(folder)
    return R.read_ticker_list(spark, folder)


@query("foreign_names", """
SELECT DISTINCT 'orders' || year(o_orderdate) AS folder FROM orders WHERE year(o_orderdate) % 2 = 1""")
def foreign_names(spark, sf):
    """Yearly files under two naming rules: those that break the first are named."""
    folder = scratch_path(spark, "named")
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    orders.where("year % 2 = 0").repartition("year").write.partitionBy("year").parquet(folder)
    orders.where("year % 2 = 1").repartition("year").write.mode("append").option("compression", "gzip").partitionBy("year") \
        .parquet(folder)
    rows = spark.read.parquet(folder)
    names = R.foreign_files(rows, r"\.(zstd|snappy)\.parquet$")
    where = rows.select(F.col("_metadata.file_name").alias("file_name"), "year").distinct()
    return where.join(names, "file_name").select(F.concat(F.lit("orders"), F.col("year").cast("string")).alias("folder")).distinct()
