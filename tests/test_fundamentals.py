import pytest
from pyspark.sql import functions as F

from panelyard.operators import fundamentals as FU
from panelyard.operators import ordered as O
from tests.conftest import d

SCHEMA = ("code string, year int, report_key int, fs_div string, sj_div string, account_nm string, "
          "thstrm_amount string, thstrm_add_amount string, ord int")


def accounts(spark, *rows):
    full = [("A", 2026, 1, fs, sj, name, amount, add, i) for i, (fs, sj, name, amount, add) in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    return FU.extract_accounts(df, ["code", "year", "report_key"], FU.QUARTER_ACCOUNTS).first()


def test_plain_amounts(spark):
    row = accounts(spark, ("CFS", "IS", "매출액", "1,000", None), ("CFS", "IS", "영업이익", "200", ""),
                   ("CFS", "CIS", "당기순이익", "150", "-"))
    assert (row.Revenue, row.OperatingIncome, row.NetIncome, row.fs_type) == (1000.0, 200.0, 150.0, "CFS")


def test_cumulative_amount_wins(spark):
    assert accounts(spark, ("CFS", "IS", "매출액", "300", "900")).Revenue == 900.0


def test_variants_and_negatives(spark):
    row = accounts(spark, ("CFS", "IS", " 영업수익 ", "500", None), ("CFS", "IS", "영업이익(손실)", "-30", None),
                   ("CFS", "IS", "분기순이익", "-50", None))
    assert (row.Revenue, row.OperatingIncome, row.NetIncome) == (500.0, -30.0, -50.0)


def test_best_name_wins_even_when_unreadable(spark):
    row = accounts(spark, ("CFS", "IS", "영업수익", "500", None), ("CFS", "IS", "매출액", "-", None))
    assert row.Revenue is None


def test_missing_account_and_balance_sheet_rows(spark):
    row = accounts(spark, ("CFS", "BS", "매출액", "1", None), ("CFS", "IS", "영업이익", "2", None))
    assert (row.Revenue, row.OperatingIncome, row.NetIncome) == (None, 2.0, None)


def test_consolidated_before_separate(spark):
    mixed = accounts(spark, ("OFS", "IS", "매출액", "1", None), ("OFS", "IS", "영업이익", "7", None), ("CFS", "IS", "매출액", "2", None))
    assert (mixed.Revenue, mixed.OperatingIncome, mixed.fs_type) == (2.0, None, "CFS")
    only = accounts(spark, ("OFS", "IS", "매출액", "1", None))
    assert (only.Revenue, only.fs_type) == (1.0, "OFS")


def test_first_row_of_a_repeated_name(spark):
    assert accounts(spark, ("CFS", "IS", "매출액", "5", None), ("CFS", "IS", "매출액", "6", None)).Revenue == 5.0


def quarters(spark, *rows):
    df = spark.createDataFrame([("A", 2026, *r) for r in rows], "code string, year int, report_key int, Revenue double, NetIncome double")
    out = O.quarterise(df, ["code", "year"], "report_key", ["Revenue", "NetIncome"])
    return {r.report_key: (r.Revenue, r.NetIncome) for r in out.collect()}


def test_quarter_differences(spark):
    assert quarters(spark, (1, 10.0, 1.0), (2, 25.0, 3.0), (3, 45.0, None), (4, 70.0, 10.0)) == {
        1: (10.0, 1.0), 2: (15.0, 2.0), 3: (20.0, None), 4: (25.0, None)}


def test_missing_half_year_blanks_two_quarters(spark):
    assert quarters(spark, (1, 10.0, 1.0), (3, 45.0, 2.0), (4, 70.0, 10.0)) == {
        1: (10.0, 1.0), 2: (None, None), 3: (None, None), 4: (25.0, 8.0)}


def test_quarterly_rows_skip_stored_and_empty(spark):
    cums = spark.createDataFrame([("005930", 2026, 1, 10.0), ("005930", 2026, 2, 30.0)], "code string, year int, report_key int, NetIncome double")
    held = spark.createDataFrame([("5930", 2026, 1)], "Ticker string, Year int, Quarter int")
    shares = spark.createDataFrame([("005930", 4)], "Code string, Stocks long")
    got = FU.quarterly_rows(cums, held, shares, F.lit("2026-09-01").cast("date"), fields=["NetIncome"]).collect()
    assert [(r.Ticker, r.PeriodDate, r.Quarter, r.NetIncome, r.DilutedEPS) for r in got] == [
        ("005930", d("2026-06-30"), 2, 20.0, 5.0)]


@pytest.mark.parametrize("today, expected", [
    ("2026-05-15", []), ("2026-05-16", [1]), ("2026-08-14", [1]), ("2026-08-15", [1, 2]), ("2026-11-15", [1, 2, 3]),
    ("2027-03-31", [1, 2, 3]), ("2027-04-01", [1, 2, 3, 4]),
])
def test_target_quarters(spark, today, expected):
    out = FU.target_quarters(spark.createDataFrame([(2026,)], "year int"), F.lit(today).cast("date"))
    assert sorted(r.Quarter for r in out.collect()) == expected


def test_required_reports(spark):
    want = spark.createDataFrame([("A", q) for q in (1, 2, 3, 4)], "code string, Quarter int")
    have = spark.createDataFrame([("A", 1), ("A", 2), ("A", 4)], "code string, Quarter int")
    assert sorted(r.report for r in FU.required_reports(have, want, ["code"]).collect()) == [2, 3]


def test_annual_gross_profit_is_derived(spark):
    rows = [("A", 2025, 4, "CFS", "IS", n, v, None, i) for i, (n, v) in enumerate([("매출액", "100"), ("영업비용", "60")])]
    out = FU.annual_accounts(spark.createDataFrame(rows, SCHEMA)).first()
    assert out["매출총이익"] == 40.0
    direct = rows + [("A", 2025, 4, "CFS", "IS", "매출총이익", "45", None, 9)]
    assert FU.annual_accounts(spark.createDataFrame(direct, SCHEMA)).first()["매출총이익"] == 45.0


CAPS = [("005930", 900.0), ("005935", 800.0), ("0126Z0", 700.0), ("000660", 600.0), ("00680K", 500.0), ("051905", 400.0)]


def snapshot(spark, caps, stocks=100):
    return spark.createDataFrame([(c, v, stocks, d("2026-09-22")) for c, v in caps], "Code string, Marcap double, Stocks long, Date date")


def test_top_universe_counts_common_stock_only(spark):
    df = snapshot(spark, CAPS)
    out = O.top_universe(df, "Code", "Date", "Marcap", "Stocks", 2)
    assert [r.Code for r in out.collect()] == ["005930", "000660"]
    short = O.top_universe(snapshot(spark, [("660", 5.0), ("5935", 9.0)]), "Code", "Date", "Marcap", "Stocks", 5)
    assert [r.Code for r in short.collect()] == ["000660"]


def test_universe_is_refused_not_shrunk(spark):
    df = snapshot(spark, CAPS).withColumn("Stocks", F.when(F.col("Code") != "000660", F.col("Stocks")))
    top = O.top_universe(df, "Code", "Date", "Marcap", "Stocks", 2)
    row = O.universe_verdict(df, top, "Code", "Date", "Marcap", "Stocks").first()
    assert (row.valid_count, row.without_shares, row.ok) == (2, 1, False)
    twice = snapshot(spark, CAPS + [("005930", 1.0)])
    row = O.universe_verdict(twice, O.top_universe(twice, "Code", "Date", "Marcap", "Stocks", 9), "Code", "Date", "Marcap", "Stocks").first()
    assert row.repeated_codes == 1 and not row.ok


def test_universe_uses_the_newest_date_with_caps(spark):
    later = snapshot(spark, [("005930", None), ("000660", 0.0)]).withColumn("Date", F.lit("2026-09-23").cast("date"))
    out = O.top_universe(snapshot(spark, CAPS).unionByName(later), "Code", "Date", "Marcap", "Stocks", 1).first()
    assert (out.source_date, out.latest_known_date) == (d("2026-09-22"), d("2026-09-23"))


@pytest.mark.parametrize("stored, latest, live, observed, between, use", [
    ("2026-09-22", "2026-09-22", "2026-09-22", "2026-09-22", 0, "stored"),
    ("2026-09-22", "2026-09-22", "2026-09-23", "2026-09-23", 1, "live"),
    ("2026-09-22", "2026-09-23", "2026-09-22", "2026-09-22", 0, "refused"),
    ("2026-09-25", "2026-09-25", None, "2026-09-27", 0, "stored"),
    ("2026-09-24", "2026-09-24", None, "2026-09-27", 1, "refused"),
    ("2025-12-30", "2025-12-30", "2026-01-05", "2026-01-05", 1, "refused"),
])
def test_universe_choice(spark, stored, latest, live, observed, between, use):
    to = lambda t: d(t) if t else None
    one = spark.createDataFrame([(to(stored), to(latest))], "source_date date, latest_known_date date")
    two = spark.createDataFrame([(to(live), to(observed))], "source_date date, observed_date date")
    assert FU.verify_universe(one, two, F.lit(between), F.lit("2026-09-30").cast("date")).first().use == use


def test_ratio_snapshot(spark):
    info = spark.createDataFrame([("A", "Name", "Infinity", 0.15, 3.0)], "t string, longName string, trailingPE string, returnOnEquity double, beta double")
    row = FU.ratio_snapshot(info, "t", F.lit("2026-09-01").cast("date")).first()
    assert (row.Name, row.PE, row.ROE, row.Beta, row.Sector) == ("Name", None, 15.0, 3.0, None)


def test_observed_tags(spark):
    rows = [("A", "A", "EQUITY", "Tech", ""), ("E", None, "etf", None, None), ("X", None, None, "Tech", "Chips")]
    df = spark.createDataFrame(rows, "Ticker string, symbol string, quoteType string, sector string, industry string")
    got = {r.Ticker: (r.Sector, r.Industry, r.QuoteType, r.fields) for r in FU.observe_tags(df).collect()}
    assert got == {"A": ("Tech", "", "EQUITY", ["Industry"]), "E": ("", "", "ETF", []),
                   "X": ("", "", "", ["Sector", "Industry", "QuoteType"])}
