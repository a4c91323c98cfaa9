import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelyard.operators import merge as M
from panelyard.operators import rows as R
from tests.conftest import d

KEYS = ["Code", "Date"]
ONE = "Code string, Date date, Close double, Amount double, Marcap double, Stocks long, Rank long, Name string"
STORED = [("005930", d("2026-09-21"), 100.0, 987.0, 100000.0, 1000, 1, "S")]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("missing", [None, 0])
def test_prices_only_merge_keeps_measurements(spark, missing):
    amount = None if missing is None else 0.0
    cap = None if missing is None else 0.0
    feed = spark.createDataFrame([("005930", d("2026-09-21"), 110.0, amount, cap, missing, missing, None)], ONE)
    out = M.merge_policy(spark.createDataFrame(STORED, ONE), feed, KEYS, M.KR_POLICY_PRICES_ONLY).first()
    assert (out.Close, out.Amount, out.Marcap, out.Stocks, out.Rank, out.Name) == (110.0, 987.0, 100000.0, 1000, 1, "S")


def test_plain_merge_stores_zero_amount(spark):
    feed = spark.createDataFrame([("005930", d("2026-09-21"), 110.0, 0.0, None, None, None, "T")], ONE)
    out = M.merge_policy(spark.createDataFrame(STORED, ONE), feed, KEYS, M.KR_POLICY).first()
    assert (out.Amount, out.Name, out.Marcap) == (0.0, "T", 100000.0)


def test_stored_zero_amount_beats_estimate(spark):
    held = spark.createDataFrame([("005930", d("2026-09-21"), 100.0, 0.0, 1.0, 1, 1, "S")], ONE)
    feed = spark.createDataFrame([("005930", d("2026-09-21"), 100.0, 1500.0, None, None, None, None)], ONE)
    assert M.merge_policy(held, feed, KEYS, M.KR_POLICY_PRICES_ONLY).first().Amount == 0.0


def test_policy_merge_nulls_prices_and_passes_new_columns(spark):
    feed = spark.createDataFrame([("005930", d("2026-09-21"), None, 7), ("000660", d("2026-09-21"), 5.0, 8)],
                                 "Code string, Date date, Close double, extra int")
    out = {r.Code: r for r in M.merge_policy(spark.createDataFrame(STORED, ONE), feed, KEYS, M.KR_POLICY).collect()}
    assert out["005930"].Close is None and out["005930"].Amount == 987.0 and out["005930"].extra == 7
    assert out["000660"].Marcap is None and out["000660"].extra == 8


def test_policy_merge_keeps_last_of_repeated_feed(spark):
    feed = spark.createDataFrame([("005930", d("2026-09-21"), 1.0, 1), ("005930", d("2026-09-21"), 2.0, 2)],
                                 "Code string, Date date, Close double, seq int")
    out = M.merge_policy(spark.createDataFrame(STORED, ONE), feed, KEYS, M.KR_POLICY, seq="seq").collect()
    assert len(out) == 1 and out[0].Close == 2.0


BAR = "Ticker string, Date date, Close double, MarketCap double"


@pytest.mark.parametrize("incoming, expected", [(None, 1000.0), (0.0, 0.0), (2000.0, 2000.0)])
def test_market_cap_preservation(spark, incoming, expected):
    held = spark.createDataFrame([("A", d("2026-09-21"), 10.0, 1000.0)], BAR)
    feed = spark.createDataFrame([("A", d("2026-09-21"), 11.0, incoming)], BAR)
    out = M.merge_last(held, M.preserve_measure(held, feed, ["Ticker", "Date"], "MarketCap"), ["Ticker", "Date"]).first()
    assert (out.Close, out.MarketCap) == (11.0, expected)


@pytest.mark.parametrize("stored", [-1.0, float("inf"), float("nan")])
def test_unusable_stored_cap_is_not_restored(spark, stored):
    held = spark.createDataFrame([("A", d("2026-09-21"), 10.0, stored)], BAR)
    feed = spark.createDataFrame([("A", d("2026-09-21"), 11.0, None)], BAR)
    assert M.preserve_measure(held, feed, ["Ticker", "Date"], "MarketCap").first().MarketCap is None


def test_purge_leaves_nothing_behind(spark):
    held = spark.createDataFrame([("ARB-USD", d("2022-01-03"), 1.0, 5.0), ("ARB-USD", d("2026-09-21"), 1.0, 1000.0),
                                  ("BTC-USD", d("2026-09-21"), 9.0, 7.0)], BAR)
    feed = spark.createDataFrame([("ARB-USD", d("2026-09-21"), 2.0, None)], BAR)
    targets = spark.createDataFrame([(" arb-usd ",)], "Ticker string")
    out = M.replace_entities(held, feed, targets, ["Ticker", "Date"], "Ticker", "MarketCap")
    assert rows(out, "Ticker", "Date", "Close", "MarketCap") == [
        ("ARB-USD", d("2026-09-21"), 2.0, None), ("BTC-USD", d("2026-09-21"), 9.0, 7.0)]


def test_coalesce_merge_unites_columns(spark):
    held = spark.createDataFrame([("A", 1, 10.0, "x"), ("B", 1, 20.0, "y")], "k string, p int, a double, only_old string")
    feed = spark.createDataFrame([("A", 1, None, 5.0), ("C", 1, 3.0, None)], "k string, p int, a double, only_new double")
    out = M.merge_coalesce(held, feed, ["k", "p"])
    assert sorted(map(tuple, out.select("k", "a", "only_old", "only_new").collect())) == [
        ("A", 10.0, "x", 5.0), ("B", 20.0, "y", None), ("C", 3.0, None, None)]


def test_latest_by_prefers_newer_then_incoming(spark):
    a = spark.createDataFrame([("X", "2026-01-02", "old"), ("Y", "2026-01-01", "old")], "k string, t string, v string")
    b = spark.createDataFrame([("X", "2026-01-01", "new"), ("Y", "2026-01-01", "new")], "k string, t string, v string")
    assert rows(M.latest_by([a, b], ["k"], "t"), "k", "v") == [("X", "old"), ("Y", "new")]


def test_failed_fields_restore_value_and_stamp(spark):
    cols = "Ticker string, Sector string, Industry string, updated_at string, QuoteType string"
    prior = spark.createDataFrame([("A", "Tech", "Chips", "2026-01-01", "EQUITY")], cols)
    fresh = spark.createDataFrame([("A", "", "Soft", "2026-02-01", "EQUITY"), ("N", "junk", "", "2026-02-01", "")], cols)
    failures = spark.createDataFrame([("A", ["Sector"]), ("N", ["Sector"])], "Ticker string, fields array<string>")
    out = M.preserve_failed_fields(fresh, prior, failures, "Ticker", ["Sector", "Industry", "QuoteType"])
    assert rows(out, "Ticker", "Sector", "Industry", "updated_at") == [
        ("A", "Tech", "Soft", "2026-01-01"), ("N", "", "", "2026-02-01")]
    bad = spark.createDataFrame([("A", ["Market"])], "Ticker string, fields array<string>")
    assert M.unknown_failed_fields(bad, ["Sector"]).count() == 1


def test_orphan_dates(spark):
    df = spark.createDataFrame([("AAPL", d("2026-01-02")), ("U-UN.TO", d("2026-01-02")), ("U-UN.TO", d("2026-01-19"))],
                               "Ticker string, Date date")
    kept, dropped = R.split_orphan_dates(df, "Ticker", "Date")
    assert kept.count() == 2 and rows(dropped, "Date") == [(d("2026-01-19"),)]


def test_delete_rows_and_lost_keys(spark):
    held = spark.createDataFrame([("A", d("2026-01-01")), ("A", d("2026-01-02")), ("B", d("2026-01-02"))],
                                 "Code string, Date date")
    dates = spark.createDataFrame([(d("2026-01-01"),)], "Date date")
    one = spark.createDataFrame([("B", d("2026-01-02"))], "Code string, Date date")
    left = M.delete_rows(held, dates, one, "Date", KEYS)
    assert rows(left, "Code", "Date") == [("A", d("2026-01-02"))]
    assert M.lost_keys(held, left, KEYS).count() == 2


cell = st.one_of(st.none(), st.integers(0, 3))
feed_rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), cell), max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(feed_rows, feed_rows)
def test_merge_last_matches_dictionary(spark, old, new):
    schema = "k int, p int, v int, seq int"
    base = {(k, p): v for k, p, v in old}
    expected = {**base, **{(k, p): v for k, p, v in new}}
    held = spark.createDataFrame([(k, p, v, 0) for (k, p), v in base.items()], schema)
    feed = spark.createDataFrame([(k, p, v, i) for i, (k, p, v) in enumerate(new)], schema)
    got = {(r.k, r.p): r.v for r in M.merge_last(held, feed, ["k", "p"], seq="seq").collect()}
    assert got == expected


def test_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(0, 20000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("seq"))
    kept = M.keep_one(hot, ["k"], [F.col("seq").desc()])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert kept.where("k = 1").first().seq == 19998
