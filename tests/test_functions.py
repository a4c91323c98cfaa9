import pytest
from pyspark.sql import functions as F

from panelyard import functions as X
from panelyard.operators import rows as R
from tests.conftest import d


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expr(F.col("c"))).collect()]


@pytest.mark.parametrize("raw, expected", [
    # two-letter exchange, single-letter exchange, digits before an exchange
    ("ZQ-PR.TO", "ZQ-PR.TO"), ("QWX.L", "QWX.L"), ("4418.T", "4418.T"), ("1933.HK", "1933.HK"),
    # class share, suffix too long for an exchange, inner dot before an exchange
    ("KLM.C", "KLM-C"), ("QWX.STUV", "QWX-STUV"), ("K.M.TO", "K-M.TO"),
    # stray characters, blanks and case
    ("$QWX", "QWX"), ("\tqwx  ", "QWX"), ("Q?W*X", "QWX"),
])
def test_normalise_ticker(spark, raw, expected):
    assert column(spark, [raw], X.normalise_ticker) == [expected]


def test_tick_size_bands(spark):
    bands = [(1, 2_000), (5, 5_000), (10, 20_000), (50, 50_000), (100, 200_000), (500, 500_000)]
    prices = [p for _, end in bands for p in (end - 1.0, float(end))]
    ticks = [t for t, _ in bands] + [1000]
    assert column(spark, prices, X.tick_size, "double") == [ticks[i] for n in range(6) for i in (n, n + 1)]


def test_parse_amount(spark):
    values = ["7,654,321", "  48", "-9.5 ", "", "-", None, "seven", "NaN", "4f", "25e1"]
    assert column(spark, values, X.parse_amount) == [7654321.0, 48.0, -9.5, None, None, None, None, None, None, 250.0]


def test_loose_number(spark):
    assert column(spark, ["86,420주", "-0.75%", "", None, "9.8.7", "none"], X.loose_number) == [
        86420.0, -0.75, None, None, None, None]


def test_zero_fill_does_not_cut(spark):
    assert column(spark, ["42", "031415", "2718281"], X.zero_fill) == ["000042", "031415", "2718281"]


def test_finite(spark):
    inf = float("inf")
    assert column(spark, [1.0, inf, -inf, float("nan"), None], X.finite, "double") == [True, False, False, False, False]


def test_same_text(spark):
    df = spark.createDataFrame([("1", "1.0"), (None, None), ("a", "a"), ("a", None), ("1", "a"), ("a", "b")],
                               "a string, b string")
    got = [r[0] for r in df.select(X.same_text(F.col("a"), F.col("b"))).collect()]
    assert got == [True, True, True, False, False, False]


@pytest.mark.parametrize("change, stored, expected", [
    (10.0, "4", "4"), (10.0, "1", "1"), (10.0, "5", "1"), (-1.0, "5", "5"), (-1.0, "1", "2"), (0.0, "0", "0"),
    (0.0, "1", "3"), (None, "1", None), (5.0, None, "1"),
])
def test_direction_code(spark, change, stored, expected):
    df = spark.createDataFrame([(change, stored)], "c double, s string")
    assert df.select(X.direction_code(F.col("c"), F.col("s"))).first()[0] == expected


def test_is_close(spark):
    df = spark.createDataFrame([(100.0, 100.0 + 1e-9), (100.0, 101.0), (0.0, 1e-9)], "a double, b double")
    assert [r[0] for r in df.select(X.is_close(F.col("a"), F.col("b"))).collect()] == [True, False, True]


def test_dates(spark):
    df = spark.createDataFrame([(d("2026-08-30"),), (d("2026-08-28"),), (d("2026-08-29"),)], "c date")
    rows = df.select(X.last_weekday(F.col("c")), X.month_end_weekday(F.col("c")),
                     X.quarter_end(F.year("c"), F.quarter("c")),
                     X.from_weekday_ordinal(X.weekday_floor(F.col("c")))).collect()
    for r in rows:
        assert r[0] == d("2026-08-28") and r[1] == d("2026-08-31") and r[2] == d("2026-09-30") and r[3] == r[0]


def test_per_share(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (None, 4.0), (10.0, None), (10.0, -1.0)], "i double, s double")
    assert [r[0] for r in df.select(X.per_share(F.col("i"), F.col("s"))).collect()] == [2.5, None, None, None, None]


def test_code_maps(spark):
    assert column(spark, ["STK", "KSQ", "KNX", "??"], R.market_name) == ["KOSPI", "KOSDAQ", "KONEX", None]
    assert column(spark, ["KOSDAQ GLOBAL", "nowhere"], R.market_id) == ["KSQ", "STK"]
    assert column(spark, ["KOSPI", "KONEX", None], lambda c: R.quote_symbol(F.lit("031415"), c)) == [
        "031415.KS", "031415.KQ", "031415.KS"]


def test_quote_symbols(spark):
    assert column(spark, ["zed-usd", " QOO-USDT"], X.strip_quote) == ["ZED", "QOO"]
    assert column(spark, ["ZED"], lambda c: X.id_symbol(c, F.lit(4077))) == ["ZED4077-USD"]
