"""Fundamentals: account extraction, quarterly values, filing calendar, ratio projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import (
    finite_or_null, fraction_to_percent, parse_amount, per_share, quarter_end, strip_blank, zero_fill,
)
from panelyard.operators.ordered import quarterise
from panelyard.schemas import RATIOS, conform

# Account names of each field, best first.
QUARTER_ACCOUNTS = {
    "Revenue": ["매출액", "영업수익", "수익(매출액)"],
    "OperatingIncome": ["영업이익", "영업이익(손실)"],
    "NetIncome": ["당기순이익", "당기순이익(손실)", "분기순이익", "반기순이익"],
}
ANNUAL_ACCOUNTS = {
    "매출액": ["매출액", "영업수익", "수익(매출액)"],
    "매출원가": ["매출원가", "영업비용"],
    "영업이익": ["영업이익", "영업이익(손실)"],
    "당기순이익": ["당기순이익", "당기순이익(손실)", "분기순이익"],
    "자산총계": ["자산총계"],
    "부채총계": ["부채총계"],
    "자본총계": ["자본총계"],
    "영업현금흐름": ["영업활동현금흐름", "영업활동으로인한현금흐름"],
    "매출총이익": ["매출총이익"],
}
INCOME_STATEMENTS = ("IS", "CIS")
STATEMENT_ORDER = ("CFS", "OFS")

# Reports a quarter is computed from, and filing deadlines as (year offset, month, day).
QUARTER_REPORTS = {1: [1], 2: [1, 2], 3: [2, 3], 4: [3, 4]}
DEADLINES = {1: (0, 5, 15), 2: (0, 8, 14), 3: (0, 11, 14), 4: (1, 3, 31)}

# Provider field of each ratio column.
RATIO_TEXT = {"Name": "longName", "Sector": "sector", "Industry": "industry"}
RATIO_NUMBERS = {
    "MarketCap": "marketCap", "SharesOutstanding": "sharesOutstanding", "PE": "trailingPE", "ForwardPE": "forwardPE",
    "PB": "priceToBook", "PS": "priceToSalesTrailing12Months", "DebtToEquity": "debtToEquity", "Beta": "beta",
    "EPS": "trailingEps", "CurrentRatio": "currentRatio",
}
RATIO_PERCENTS = {
    "ROE": "returnOnEquity", "ROA": "returnOnAssets", "HeldPctInstitutions": "heldPercentInstitutions",
    "DividendYield": "dividendYield", "ProfitMargin": "profitMargins", "OperatingMargin": "operatingMargins",
    "RevenueGrowth": "revenueGrowth", "EarningsGrowth": "earningsGrowth",
}

# Kinds of instrument that have no sector.
SECTORLESS = ("ETF", "MUTUALFUND", "INDEX", "CRYPTOCURRENCY", "CURRENCY", "FUTURE", "OPTION")
TAG_SOURCES = {"Sector": "sector", "Industry": "industry"}


def _priority(name: Column, variants: Sequence[str]) -> Column:
    rank = F.when(name == variants[0], 0)
    for i, v in enumerate(variants[1:], start=1):
        rank = rank.when(name == v, i)
    return rank


def extract_accounts(
    rows: DataFrame, report: Sequence[str], accounts: Mapping[str, Sequence[str]], name: str = "account_nm",
    amount: str = "thstrm_amount", cumulative: str | None = "thstrm_add_amount", order: str = "ord",
    statement: str = "fs_div", section: str | None = "sj_div", sections: Sequence[str] = INCOME_STATEMENTS,
    statements: Sequence[str] = STATEMENT_ORDER,
) -> DataFrame:
    """One row per report: each field from its best-ranked account name.

    The consolidated statement is used when the report has one at all, else the separate one; within it the first
    row carrying the best name counts, its cumulative amount before its plain one.  One grouped pass with map-side
    partials covers both statements, so reports of any size stay distributed.
    """
    label = strip_blank(F.col(name))
    usable = F.lit(True) if section is None else F.col(section).isin(*sections)
    text = [cumulative, amount] if cumulative else [amount]

    def pick(kind: str, variants: Sequence[str]) -> Column:
        rank = F.when(usable & (F.col(statement) == kind), _priority(label, variants))
        return F.min_by(F.when(rank.isNotNull(), F.struct(*text)), F.when(rank.isNotNull(), F.struct(rank, F.col(order))))

    fields = list(accounts)
    picked = rows.where(F.col(statement).isin(*statements)).groupBy(*report).agg(
        *[F.bool_or(F.col(statement) == k).alias(f"_has_{k}") for k in statements],
        *[pick(k, accounts[f]).alias(f"_{k}_{i}") for k in statements for i, f in enumerate(fields)])

    def chosen(value) -> Column:
        out = F.when(F.col(f"_has_{statements[0]}"), value(statements[0]))
        for k in statements[1:]:
            out = out.when(F.col(f"_has_{k}"), value(k))
        return out

    def number(i: int):
        return lambda k: F.coalesce(*[parse_amount(F.col(f"_{k}_{i}.{t}")) for t in text])

    return picked.select(*report, chosen(F.lit).alias("fs_type"),
                         *[chosen(number(i)).alias(f) for i, f in enumerate(fields)])


def annual_accounts(rows: DataFrame, report: Sequence[str] = ("code", "year"), **options) -> DataFrame:
    """Annual fields; gross profit is revenue minus cost where it is not reported."""
    out = extract_accounts(rows, report, ANNUAL_ACCOUNTS, cumulative=None, section=None, **options)
    derived = F.coalesce(F.col("매출총이익"), F.col("매출액") - F.col("매출원가"))
    return out.withColumn("매출총이익", derived)


def quarterly_rows(
    cumulative: DataFrame, existing: DataFrame, shares: DataFrame, snap: Column, entity: str = "code",
    year: str = "year", report: str = "report_key", fields: Sequence[str] = tuple(QUARTER_ACCOUNTS),
    income: str = "NetIncome",
) -> DataFrame:
    """Quarter rows to store: differences, without empty and already stored quarters, with earnings per share.

    ``existing`` is (Ticker, Year, Quarter); ``shares`` is (Code, Stocks).
    """
    quarters = quarterise(cumulative, [entity, year], report, fields)
    some = F.coalesce(*[F.col(f) for f in fields]).isNotNull()
    rows = quarters.where(some).select(
        F.col(entity).alias("Ticker"), quarter_end(F.col(year), F.col(report)).alias("PeriodDate"),
        F.col(year).cast("int").alias("Year"), F.col(report).cast("int").alias("Quarter"), *fields)
    known = existing.select(zero_fill(F.col("Ticker").cast("string")).alias("Ticker"), "Year", "Quarter").distinct()
    fresh = rows.join(known, ["Ticker", "Year", "Quarter"], "left_anti")
    counts = shares.select(F.col("Code").alias("Ticker"), "Stocks")
    joined = fresh.join(counts, "Ticker", "left")
    return joined.select(*rows.columns, per_share(F.col(income), F.col("Stocks")).alias("DilutedEPS"),
                         snap.alias("SnapDate"))


def required_reports(existing: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reports still needed: dependencies of target quarters that are not stored.  Both are (keys, Quarter)."""
    needs = F.create_map(*[x for q, r in QUARTER_REPORTS.items() for x in (F.lit(q), F.array(*map(F.lit, r)))])
    open_quarters = targets.join(existing, [*keys, "Quarter"], "left_anti")
    return open_quarters.select(*keys, F.explode(F.try_element_at(needs, F.col("Quarter").cast("int"))).alias("report")
                                ).distinct()


def target_quarters(years: DataFrame, today: Column, year: str = "year") -> DataFrame:
    """Quarters whose reports are all past their deadline (the deadline day itself is too early)."""
    due = {r: F.make_date(F.col(year) + dy, F.lit(m), F.lit(d)) for r, (dy, m, d) in DEADLINES.items()}
    rows = F.array(*[
        F.struct(F.lit(q).alias("Quarter"), F.greatest(*[due[r] for r in reports], F.lit("0001-01-01").cast("date"))
                 .alias("deadline")) for q, reports in QUARTER_REPORTS.items()])
    return years.select(F.col(year), F.inline(rows)).where(today > F.col("deadline"))


def verify_universe(stored: DataFrame, live: DataFrame, days_between: Column, snap: Column) -> DataFrame:
    """Which universe may be used, from two one-row summaries (source_date, latest_known_date, size).

    ``stored``: must date from the snapshot's year, not after it.  ``live`` (source_date NULL when it has no caps,
    observed_date always) must not be older than anything stored; when newer it is used, unless it has no caps and
    no trading day lies in between.
    """
    one = stored.select(F.col("source_date").alias("s"), F.col("latest_known_date").alias("k"), F.lit(1).alias("_j"))
    two = live.select(F.col("source_date").alias("l"), F.col("observed_date").alias("o"), F.lit(1).alias("_j"))
    sound = (F.year("s") == F.year(snap)) & (F.col("s") <= snap) & (F.col("o") >= F.greatest("s", "k"))
    use_live = (F.col("l") == F.col("o")) & (F.col("l") <= snap)
    choice = (F.when(~F.coalesce(sound, F.lit(False)), "refused")
              .when(F.col("o") == F.col("s"), "stored")
              .when(F.coalesce(use_live, F.lit(False)), "live")
              .when(F.col("l").isNull() & (days_between == 0), "stored").otherwise("refused"))
    return one.join(two, "_j").select(choice.alias("use"), F.col("s").alias("stored_date"),
                                      F.col("o").alias("observed_date"), (choice != "refused").alias("ok"))


def ratio_snapshot(info: DataFrame, ticker: str, snap: Column) -> DataFrame:
    """Ratio rows from flat provider records; fractions become percent, undefined numbers NULL."""
    have = set(info.columns)

    def source(name: str, dtype: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).try_cast(dtype)

    columns = [F.col(ticker).alias("Ticker"), snap.alias("SnapDate")]
    columns += [source(f, "string").alias(c) for c, f in RATIO_TEXT.items()]
    columns += [finite_or_null(source(f, "double")).alias(c) for c, f in RATIO_NUMBERS.items()]
    columns += [fraction_to_percent(source(f, "double")).alias(c) for c, f in RATIO_PERCENTS.items()]
    return conform(info.select(*columns), RATIOS)


def listing_ratios(listing: DataFrame, second: DataFrame, snap: Column) -> DataFrame:
    """Ratio rows from an exchange listing, missing Beta and MarketCap filled from a second source by Ticker."""
    rows = listing.select(
        F.concat("symbol", F.lit("-USD")).alias("Ticker"), snap.alias("SnapDate"), F.col("name").alias("Name"),
        F.lit("Crypto").alias("Sector"), F.col("tag").alias("Industry"), F.col("market_cap").alias("_cap"),
        F.col("supply").alias("SharesOutstanding"), F.col("change_24h").alias("RevenueGrowth"),
        F.col("change_7d").alias("EarningsGrowth"))
    other = second.select("Ticker", F.col("Beta").alias("_b"), F.col("MarketCap").alias("_c"))
    joined = rows.join(other, "Ticker", "left").withColumn("MarketCap", F.coalesce("_cap", "_c")).withColumn(
        "Beta", F.col("_b"))
    return conform(joined, RATIOS)


def observe_tags(records: DataFrame, ticker: str = "Ticker") -> DataFrame:
    """Tag observations with the fields that failed.

    ``records`` has (Ticker, symbol, quoteType, sector, industry).  A record without symbol and quoteType proves
    nothing; a blank sector or industry is a failure unless the kind of instrument has none.
    """
    proven = F.col("symbol").isNotNull() | F.col("quoteType").isNotNull()
    kind = F.upper(strip_blank(F.coalesce("quoteType", F.lit(""))))
    exempt = kind.isin(*SECTORLESS)

    def blank(source: str) -> Column:
        return strip_blank(F.coalesce(F.col(source), F.lit(""))) == ""

    failed = F.array_compact(F.array(
        *[F.when(~proven | (blank(s) & ~exempt), F.lit(t)) for t, s in TAG_SOURCES.items()],
        F.when(~proven, F.lit("QuoteType"))))
    text = {t: F.when(proven & ~blank(s), F.col(s)).otherwise("") for t, s in TAG_SOURCES.items()}
    return records.select(ticker, *[c.alias(t) for t, c in text.items()],
                          F.when(proven, kind).otherwise("").alias("QuoteType"), failed.alias("fields"))
