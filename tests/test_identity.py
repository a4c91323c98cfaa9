import pytest

from panelyard.operators import identity as I
from tests.conftest import d

LISTING = [("ARB", 11841, 0.0759), ("JUP", 29210, 0.1692), ("SHIB", 5994, 0.0000044), ("LINK", 1975, 8.65), ("USDG", 33793, 0.9997)]


def listing(spark):
    return spark.createDataFrame(LISTING, "symbol string, id long, price double")


@pytest.mark.parametrize("ticker, price, expected", [
    ("ARB-USD", 0.000629, "ARB11841-USD"), ("LINK-USD", 8.6499, None), ("SHIB-USD", 0.00000439, None),
    ("LINK-USD", 8.65 * 1.15, None), ("USDG-USD", 5.4465, "USDG33793-USD"), ("NONE-USD", 1.0, None), ("ARB-USD", 0.0, None),
])
def test_price_overrides(spark, ticker, price, expected):
    seen = spark.createDataFrame([(ticker, price)], "ticker string, price double")
    assert [r.symbol for r in I.price_overrides(seen, listing(spark)).collect()] == ([expected] if expected else [])


def test_suspects_need_confirmation(spark):
    latest = spark.createDataFrame([("JUP-USD", 0.05, d("2026-10-01")), ("LINK-USD", 8.65, d("2026-09-27")), ("SHIB-USD", 0.0000044, d("2026-09-28"))],
                                   "ticker string, price double, last_date date")
    none = latest.select("ticker").where("false")
    found = I.suspects(latest, listing(spark), none)
    assert sorted(r.ticker for r in found.collect()) == ["JUP-USD", "LINK-USD"]     # SHIB is three days behind only
    probe = spark.createDataFrame([("JUP29210-USD", 0.17), ("LINK1975-USD", 20.0)], "symbol string, price double")
    assert [tuple(r) for r in I.confirmed_overrides(found, probe).collect()] == [("JUP-USD", "JUP29210-USD")]


def test_map_priority_purge_and_relabel(spark):
    bars = spark.createDataFrame([("ARB-USD", d("2026-10-01"), 0.000629), ("JUP-USD", d("2026-10-01"), 0.169)],
                                 "ticker string, Date date, Close double")
    none = spark.createDataFrame([], "symbol string, price double")
    found = spark.createDataFrame([("ARB-USD", "OTHER-USD"), ("UNI-USD", "UNI7083-USD")], "ticker string, symbol string")
    final = I.symbol_overrides(bars, listing(spark), none, found)
    assert sorted(map(tuple, final.select("ticker", "symbol").collect())) == [
        ("ARB-USD", "ARB11841-USD"), ("UNI-USD", "UNI7083-USD")]
    failed = spark.createDataFrame([(" uni-usd",)], "ticker string")
    assert [r.ticker for r in I.purge_targets(final, failed).collect()] == ["ARB-USD"]
    rows = spark.createDataFrame([("ARB11841-USD", 1), ("BTC-USD", 2)], "ticker string, v int")
    assert sorted(map(tuple, I.relabel(rows, final, "ticker").collect())) == [("ARB-USD", 1), ("BTC-USD", 2)]


def test_retry_order(spark):
    missing = spark.createDataFrame([("ARB-USD",), ("HYPE-USD",), ("LINK-USD",), ("C+-USD",)], "ticker string")
    found = spark.createDataFrame([("ARB-USD", "ARB99-USD"), ("HYPE-USD", "HYPE32196-USD"), ("LINK-USD", "LINK5-USD"),
                                   ("C+-USD", "C+7-USD")], "ticker string, symbol string")
    tried = spark.createDataFrame([("LINK-USD", "LINK1975-USD")], "ticker string, symbol string")
    got = {r.ticker: r.symbol for r in I.retry_candidates(missing, listing(spark), found, tried).collect()}
    assert got == {"ARB-USD": "ARB11841-USD", "HYPE-USD": "HYPE32196-USD", "LINK-USD": "LINK5-USD", "C+-USD": "C+7-USD"}
    wrong = spark.createDataFrame([("HYPE-USD", "HYPER1-USD")], "ticker string, symbol string")
    assert "HYPE-USD" not in {r.ticker for r in I.retry_candidates(missing, listing(spark), wrong, tried).collect()}
