from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from panelyard.operators.calendar import day_range, session_status
from panelyard.operators.gates import GateRefused
from panelyard.plans import jobs as J
from panelyard.plans.lake import Lake
from panelyard.schemas import KR_BARS, TAGS, conform
from tests.conftest import d, weekdays

LOOSE = J.Limits(min_universe=1000)
RAW = ("Ticker string, Date date, Open double, High double, Low double, Close double, Volume double, "
       "Dividends double, `Stock Splits` double")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def raw(spark, spans, close=10.0, dividends=0.0):
    rows = [(t, x, close, close, close, close, 100.0, dividends, 0.0) for t, days in spans.items() for x in days]
    return spark.createDataFrame(rows, RAW)


def names(spark, tickers):
    return spark.createDataFrame([(t,) for t in tickers], "Ticker string")


def nobody(spark):
    return names(spark, ["x"]).where("false")


def test_incremental_update_then_late_correction(spark, lake):
    days = weekdays("2025-12-29", 5)                       # spans two year partitions
    tickers = [f"T{i}" for i in range(4)]
    today = F.lit(days[3].isoformat()).cast("date")
    caps = names(spark, tickers).withColumn("MarketCap", F.lit(500.0))
    first = J.update_bars(lake, "us", raw(spark, {t: days[:4] for t in tickers}), names(spark, tickers), nobody(spark),
                          today, caps, limits=LOOSE).first()
    assert (first.status, first.cursor) == ("ok", days[3])
    stored = lake.read(lake.bars("us"))
    assert stored.count() == 16 and {r.year for r in stored.select("year").distinct().collect()} == {2025, 2026}
    newest = stored.where(F.col("Date") == days[3]).first()
    assert newest.MarketCap == 500.0 and newest.ChangesRatio == 0.0 and newest.Amount == 1000.0

    second = J.update_bars(lake, "us", raw(spark, {t: days[2:5] for t in tickers}), names(spark, tickers), nobody(spark),
                           F.lit(days[4].isoformat()).cast("date"), limits=LOOSE).first()
    assert second.cursor == days[4]
    after = {(r.Ticker, r.Date): r for r in lake.read(lake.bars("us")).collect()}
    assert after[("T0", days[3])].MarketCap == 500.0       # a later run without caps keeps the observed one
    assert after[("T0", days[4])].MarketCap is None
    assert after[("T0", days[3])].ChangesRatio == 0.0      # the first re-read day still has its predecessor
    state = lake.read(lake.cursors()).first()
    assert (state.market, state.last_updated, state.ticker_count) == ("us", days[4], 4)


def test_drift_is_refused_and_nothing_changes(spark, lake):
    days = weekdays("2026-09-14", 4)
    tickers = ["A", "B"]
    today = F.lit(days[3].isoformat()).cast("date")
    J.update_bars(lake, "us", raw(spark, {t: days for t in tickers}), names(spark, tickers), nobody(spark), today, limits=LOOSE)
    with pytest.raises(GateRefused) as refusal:
        J.update_bars(lake, "us", raw(spark, {t: days for t in tickers}, close=5.0), names(spark, tickers), nobody(spark),
                      today, limits=LOOSE)
    assert refusal.value.gate == "price_basis"
    assert {r.Close for r in lake.read(lake.bars("us")).collect()} == {10.0}


def test_action_entities_queue_for_rebase_and_are_replaced(spark, lake):
    days = weekdays("2026-09-14", 5)
    tickers = ["A", "B"]
    today = F.lit(days[4].isoformat()).cast("date")
    J.update_bars(lake, "us", raw(spark, {t: days for t in tickers}), names(spark, tickers), nobody(spark), today,
                  names(spark, tickers).withColumn("MarketCap", F.lit(7.0)), limits=LOOSE)
    paid = raw(spark, {"A": days}, dividends=1.0, close=9.0).unionByName(raw(spark, {"B": days}))
    J.update_bars(lake, "us", paid, names(spark, tickers), nobody(spark), today, limits=LOOSE)
    assert [r.Ticker for r in lake.queue("us", "rebase").collect()] == ["A"]
    kept = J.rebase_bars(lake, "us", raw(spark, {"A": days[:2]}, close=8.0), nobody(spark), LOOSE).first()
    assert not kept.safe and lake.queue("us", "rebase").count() == 1
    done = J.rebase_bars(lake, "us", raw(spark, {"A": days}, close=8.0), nobody(spark), LOOSE).first()
    assert done.safe and lake.queue("us", "rebase").count() == 0
    rows = {(r.Ticker, r.Date): r for r in lake.read(lake.bars("us")).collect()}
    assert rows[("A", days[0])].Close == 8.0 and rows[("B", days[0])].Close == 10.0
    assert rows[("A", days[4])].MarketCap == 7.0


def test_new_entities_are_backfilled_without_moving_the_cursor(spark, lake):
    days = weekdays("2026-09-14", 4)
    J.update_bars(lake, "us", raw(spark, {t: days for t in "AB"}), names(spark, "AB"), nobody(spark),
                  F.lit(days[3].isoformat()).cast("date"), limits=LOOSE)
    older = weekdays("2026-08-03", 3)
    got = J.backfill_new(lake, "us", raw(spark, {"C": older + days + [days[3] + timedelta(days=3)], "A": older}),
                         names(spark, "ABC"), nobody(spark), LOOSE).collect()
    assert [(r.Ticker, r.kind) for r in got] == [("C", "new")]
    state = lake.read(lake.cursors()).first()
    assert (state.last_updated, state.oldest_date) == (days[3], older[0])
    assert lake.queue("us", "backfill").count() == 0
    assert lake.read(lake.bars("us")).where("Ticker = 'A'").count() == 4
    with pytest.raises(GateRefused):
        J.backfill_new(lake, "us", raw(spark, {"E": days}), names(spark, "ABCDE"), names(spark, "D"), LOOSE)
    assert {r.Ticker for r in lake.queue("us", "backfill").collect()} == {"D", "E"}


def test_backfill_purges_corrected_symbols(spark, lake):
    days = weekdays("2026-09-14", 3)
    J.backfill_bars(lake, "crypto", raw(spark, {"ARB-USD": days, "BTC-USD": days}), nobody(spark), limits=LOOSE)
    fixed = spark.createDataFrame([("ARB-USD", "ARB11841-USD")], "ticker string, symbol string")
    J.backfill_bars(lake, "crypto", raw(spark, {"ARB-USD": days[2:]}, close=99.0), names(spark, ["ETH-USD"]), fixed, LOOSE)
    left = lake.read(lake.bars("crypto")).where("Ticker = 'ARB-USD'").collect()
    assert [(r.Date, r.Close) for r in left] == [(days[2], 99.0)]
    assert [r.Ticker for r in lake.queue("crypto", "backfill").collect()] == ["ETH-USD"]


def test_broken_prices_refuse_the_feed(spark, lake):
    bad = raw(spark, {"A": weekdays("2026-09-14", 2)}).withColumn("High", F.lit(float("nan")))
    with pytest.raises(GateRefused) as refusal:
        J.backfill_bars(lake, "us", bad, nobody(spark), limits=LOOSE)
    assert refusal.value.gate == "price_values"


CODES = [f"{i:05d}0" for i in range(10)]
DAYS = weekdays("2026-09-14", 8)
LIM = J.Limits(min_universe=5)


def kr(spark, days, close=1000.0, codes=CODES, cap=True, market="STK"):
    rows = [(c, x, close, close, close, close, 100, 1e6 + i if cap else None, 50, f"N{c}") for i, c in enumerate(codes) for x in days]
    df = spark.createDataFrame(rows, "Code string, Date date, Open double, High double, Low double, Close double, Volume long, "
                                     "Marcap double, Stocks long, Name string")
    return conform(df.withColumn("MarketId", F.lit(market)).withColumn("Market", F.lit("KOSPI")), KR_BARS)


def calendar(spark):
    days = day_range(spark, "2026-09-01", "2026-10-31")
    holidays = spark.createDataFrame([(DAYS[6], "holiday")], "date date, name string")
    return session_status(days, holidays, days.select(F.year("date").alias("year")))


def test_kr_save_gates_coverage(spark, lake):
    J.save_kr_bars(lake, kr(spark, DAYS[:5]), limits=LIM)
    with pytest.raises(GateRefused) as refusal:
        J.save_kr_bars(lake, kr(spark, [DAYS[5]], codes=CODES[:8]), limits=LIM)
    assert refusal.value.gate == "write_coverage"
    J.save_kr_bars(lake, kr(spark, [DAYS[5]], codes=CODES[:9]), limits=LIM)
    assert lake.read(lake.bars("kr")).count() == 59


def test_kr_settlement_is_idempotent_and_logged(spark, lake):
    J.save_kr_bars(lake, kr(spark, DAYS[:5], 1000.0), limits=LIM)
    official = kr(spark, DAYS[:4], 1010.0)
    floor = F.lit("2026-09-01").cast("date")
    plan = J.settle_kr(lake, official, 2026, floor, limits=LIM, apply=False).first()
    assert (plan.rows_replaced, plan.rows_added, plan.written, plan.missing_rows) == (40, 0, False, 0)
    assert {r.Close for r in lake.read(lake.bars("kr")).collect()} == {1000.0}
    first = J.settle_kr(lake, official, 2026, floor, limits=LIM).first()
    assert first.written and first.mismatch_Close == 0 and first.final_rows == 50
    closes = {r.Date: r.Close for r in lake.read(lake.bars("kr")).where(F.col("Code") == CODES[0]).collect()}
    assert closes[DAYS[3]] == 1010.0 and closes[DAYS[4]] == 1000.0
    again = J.settle_kr(lake, official, 2026, floor, limits=LIM).first()
    assert not again.written and again.rows_replaced == 0
    assert lake.read(lake.settlement_log()).count() == 1
    assert lake.read(lake.boundary()).first().official_through == DAYS[3]
    assert J.settle_kr(lake, official, 2020, floor).first().skipped == "closed_year"


def test_kr_settlement_refuses_mass_change(spark, lake):
    J.save_kr_bars(lake, kr(spark, DAYS[:3], 1000.0), limits=LIM)
    with pytest.raises(GateRefused) as refusal:
        J.settle_kr_years(lake, kr(spark, DAYS[:3], 1100.0), [2026], F.lit("2026-09-01").cast("date"), limits=LIM)
    assert refusal.value.gate == "mass_change"


def test_kr_settlement_deletes_a_proven_copy(spark, lake):
    J.save_kr_bars(lake, kr(spark, DAYS[:6] + [DAYS[6]]), limits=LIM)
    official = kr(spark, DAYS[:6] + [DAYS[7]])
    drops = spark.createDataFrame([(DAYS[6],)], "Date date")
    row = J.settle_kr(lake, official, 2026, F.lit("2026-09-01").cast("date"), calendar(spark), drops, limits=LIM).first()
    assert row.rows_dropped == 10 and row.extra_dates == 0
    assert lake.read(lake.bars("kr")).where(F.col("Date") == DAYS[6]).count() == 0
    with pytest.raises(GateRefused):
        J.settle_kr(lake, official, 2026, F.lit("2026-09-01").cast("date"), calendar(spark),
                    spark.createDataFrame([(DAYS[2],)], "Date date"), limits=LIM)


def test_kr_daily_fills_supplements_and_settles(spark, lake):
    J.save_kr_bars(lake, kr(spark, DAYS[:3]), limits=LIM)
    closed = J.kr_daily(lake, DAYS[6].isoformat(), calendar(spark), None, kr(spark, []), kr(spark, []), limits=LIM).first()
    assert closed.status == "closed"
    archive = kr(spark, [DAYS[3]])
    secondary = kr(spark, DAYS[1:6], cap=False)
    snapshot = kr(spark, [DAYS[5]], 1000.0, CODES[:9])
    out = J.kr_daily(lake, DAYS[5].isoformat(), calendar(spark), snapshot, archive, secondary,
                     kr(spark, DAYS[:4], 1001.0), F.lit("2026-09-01").cast("date"), LIM).first()
    assert (out.Date, out.n, out.baseline) == (DAYS[5], 10, 10.0)
    rows = {(r.Code, r.Date): r for r in lake.read(lake.bars("kr")).collect()}
    assert len(rows) == 60
    assert rows[(CODES[0], DAYS[3])].Close == 1001.0 and rows[(CODES[0], DAYS[3])].Marcap is not None
    assert rows[(CODES[0], DAYS[4])].Marcap is None           # gap filled from the second provider
    assert rows[(CODES[9], DAYS[5])].Marcap is None and rows[(CODES[8], DAYS[5])].Rank == 1


def test_kr_daily_fallback_needs_agreement(spark, lake):
    J.save_kr_bars(lake, kr(spark, DAYS[:5]), limits=LIM)
    off = kr(spark, [DAYS[4]], 500.0, cap=False).unionByName(kr(spark, [DAYS[5]], 1000.0, cap=False))
    with pytest.raises(GateRefused) as refusal:
        J.kr_daily(lake, DAYS[5].isoformat(), calendar(spark), None, kr(spark, []), off, limits=LIM)
    assert refusal.value.gate == "nothing_collected"
    good = kr(spark, DAYS[4:6], 1000.0, cap=False)
    assert J.kr_daily(lake, DAYS[5].isoformat(), calendar(spark), None, kr(spark, []), good, limits=LIM).first().n == 10


def test_kr_backfill_keeps_agreeing_entities(spark, lake):
    J.save_kr_bars(lake, kr(spark, DAYS[2:5]), limits=LIM)
    cand = kr(spark, DAYS[:4], 1000.0, CODES[:9], cap=False).unionByName(kr(spark, DAYS[:4], 900.0, CODES[9:], cap=False))
    got = J.kr_backfill(lake, cand, F.lit(DAYS[0].isoformat()).cast("date"), F.lit(DAYS[3].isoformat()).cast("date"), limits=LIM).first()
    assert (got.verified, got.rejected, got.unmatched) == (9, 1, 0)
    rows = {(r.Code, r.Date): r for r in lake.read(lake.bars("kr")).collect()}
    assert (CODES[9], DAYS[0]) not in rows and rows[(CODES[0], DAYS[2])].Marcap is not None
    assert rows[(CODES[0], DAYS[1])].Changes == 0.0


FIN = "Ticker string, PeriodDate date, Year int, Quarter int, Revenue double, NetIncome double, SnapDate date"


def test_fundamentals_coalesce_and_validation(spark, lake):
    one = [("AAPL", d("2026-06-30"), 2026, 2, 10.0, 10.0, d("2026-09-22"))]
    J.save_fundamentals(lake, "us", "financials", spark.createDataFrame(one, FIN))
    two = [("AAPL", d("2026-06-30"), 2026, 2, None, 12.0, d("2026-10-01")), ("AAPL", d("2025-12-31"), 2025, 4, 1.0, 1.0, d("2026-10-01"))]
    J.save_fundamentals(lake, "us", "financials", spark.createDataFrame(two, FIN))
    rows = {r.PeriodDate: r for r in lake.read(lake.financials("us")).collect()}
    assert (rows[d("2026-06-30")].Revenue, rows[d("2026-06-30")].NetIncome) == (10.0, 12.0) and len(rows) == 2
    for bad in [("AAPL", d("2026-06-30"), 2025, 2, 1.0, 1.0, d("2026-10-01")), ("AAPL", d("2026-06-30"), 2026, 3, 1.0, 1.0, d("2026-10-01")),
                (" AAPL", d("2026-06-30"), 2026, 2, 1.0, 1.0, d("2026-10-01")), ("AAPL", d("2026-06-30"), 2026, 2, float("inf"), 1.0, d("2026-10-01"))]:
        with pytest.raises(GateRefused):
            J.save_fundamentals(lake, "us", "financials", spark.createDataFrame([bad], FIN))
    ratio = spark.createDataFrame([("AAPL", d("2026-10-01"), float("inf"), 2.0)], "Ticker string, SnapDate date, PE double, PB double")
    J.save_fundamentals(lake, "us", "ratios", ratio)
    assert lake.read(lake.ratios("us")).first().PE is None


def test_kr_fundamentals_in_one_plan(spark, lake):
    rows = [("005930", 2026, k, "CFS", "IS", "매출액", str(100 * k), None, 1) for k in (1, 2, 3)] + [("999990", 2026, 1, "CFS", "IS", "매출액", "5", None, 1)]
    accounts = spark.createDataFrame(rows, "code string, year int, report_key int, fs_div string, sj_div string, account_nm string, "
                                           "thstrm_amount string, thstrm_add_amount string, ord int")
    universe = spark.createDataFrame([("005930", 10)], "Code string, Stocks long")
    J.kr_fundamentals(lake, accounts, universe, F.lit("2026-09-01").cast("date"))
    got = {r.Quarter: r.Revenue for r in lake.read(lake.financials("kr")).collect()}
    assert got == {1: 100.0, 2: 100.0}                        # the third quarter is not due yet


def test_tags_restore_failed_fields_and_refuse_shrink(spark, lake):
    row = lambda t, sector, stamp: (t, "US", sector, "i", stamp, "EQUITY")
    prior = spark.createDataFrame([row(f"T{i}", "Tech", "2026-01-01T00:00:00") for i in range(10)], TAGS)
    none = spark.createDataFrame([], "Ticker string, fields array<string>")
    J.save_tags(lake, "us", prior, none)
    fresh = spark.createDataFrame([row(f"T{i}", "", "2026-02-01T00:00:00") for i in range(10)], TAGS)
    lost = spark.createDataFrame([("T0", ["Sector"])], "Ticker string, fields array<string>")
    J.save_tags(lake, "us", fresh, lost)
    got = {r.Ticker: (r.Sector, r.updated_at[:7]) for r in lake.read(lake.tags("us")).collect()}
    assert got["T0"] == ("Tech", "2026-01") and got["T1"] == ("", "2026-02")
    with pytest.raises(GateRefused):
        J.save_tags(lake, "us", fresh.limit(9), none)


def test_month_tables_and_checkpoints(spark, lake):
    price = lambda day, t, c: (day, t, c, c, c, c, 1.0)
    cols = "date string, ticker string, open double, high double, low double, close double, volume double"
    J.save_month_prices(lake, spark.createDataFrame([price("20260901", "A", 1.0), price("20260901", "B", 0.0)], cols))
    J.save_month_prices(lake, spark.createDataFrame([price("20260901", "A", 2.0), price("20260831", "A", 3.0)], cols))
    assert sorted((r.date, r.close) for r in lake.read(lake.month_prices()).collect()) == [("20260831", 3.0), ("20260901", 2.0)]
    daily = spark.createDataFrame([("20260529", "A", 5.0), ("20260531", "A", 6.0), ("20260610", "A", 7.0)], "date string, ticker string, PER double")
    J.month_snapshots(lake, daily, "202605", "202605")
    assert [(r.date, r.PER) for r in lake.read(lake.month_snapshots()).collect()] == [("202605", 5.0)]
    J.month_snapshots(lake, daily.withColumn("PER", F.lit(0.0)), "202605", "202606")
    assert sorted((r.date, r.PER) for r in lake.read(lake.month_snapshots()).collect()) == [("202605", 5.0), ("202606", 0.0)]


def test_audits_and_rewrite(spark, lake):
    days = weekdays("2026-09-14", 3)
    J.backfill_bars(lake, "us", raw(spark, {"A": days, "B": days[1:], "U.TO": days + [d("2026-09-19")]}), nobody(spark), limits=LOOSE)
    found = J.audit_backfill(lake, "us", F.lit("2026-09-14").cast("date"), fix=True).collect()
    assert [(r.Ticker, r.state) for r in found] == [("B", "new")]
    assert [r.Ticker for r in lake.queue("us", "backfill").collect()] == ["B"]
    assert J.audit_backfill(lake, "us", F.lit("2026-09-14").cast("date")).first().state == "pending"
    report = J.rewrite(lake, "us", LOOSE).first()
    assert (report.rows_before, report.rows_after, report.ok) == (8, 8, True)
    J.save_kr_bars(lake, kr(spark, [DAYS[0], DAYS[2]]), limits=LIM)
    years, gaps = J.audit_kr(lake, F.lit(DAYS[2].isoformat()).cast("date"))
    assert years.first().gaps == 1 and gaps.first().gap_start == DAYS[1]


def years_of(spark, spans, close=10.0):
    return raw(spark, {t: [x for y in years for x in weekdays(f"{y}-06-01", 3)] for t, years in spans.items()}, close)


def test_each_year_is_judged_by_itself(spark, lake):
    spans = {f"A{i}": [2015] for i in range(30)} | {f"B{i}": [2015, 2016] for i in range(10)}
    J.backfill_bars(lake, "us", years_of(spark, spans), nobody(spark), limits=J.Limits(min_universe=5))
    assert lake.read(lake.bars("us")).groupBy("year").count().count() == 2


def test_purge_reaches_years_without_new_rows(spark, lake):
    J.backfill_bars(lake, "us", years_of(spark, {"X": [2021, 2023], "Y": [2023]}), nobody(spark), limits=LOOSE)
    named = spark.createDataFrame([("X", "X1")], "ticker string, symbol string")
    fresh = years_of(spark, {"X": [2023]}, close=99.0)
    J.backfill_bars(lake, "us", fresh, nobody(spark), named, J.Limits(min_universe=1000, allow_shrink=True))
    got = {(r.Ticker, r.year, r.Close) for r in lake.read(lake.bars("us")).collect()}
    assert got == {("X", 2023, 99.0), ("Y", 2023, 10.0)}


def test_changes_follow_the_true_predecessor(spark, lake):
    def put(day, close):
        J.backfill_bars(lake, "us", raw(spark, {"X": [d(day)]}, close), nobody(spark), limits=LOOSE)

    def ratio(day):
        return lake.read(lake.bars("us")).where(F.col("Date") == d(day)).first().ChangesRatio

    put("2020-05-04", 10.0)
    put("2024-01-02", 20.0)
    assert ratio("2024-01-02") == pytest.approx(100.0)         # years lie between
    put("2023-12-29", 40.0)
    assert ratio("2023-12-29") == pytest.approx(300.0) and ratio("2024-01-02") == pytest.approx(-50.0)


def test_padding_gains_and_repeated_keys(spark, lake):
    day = d("2025-03-03")
    cols = RAW + ", `Capital Gains` double"
    good = ("G", day, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 2.0)
    padding = ("P", day) + (None,) * 8
    _, gates, acted = J.finalise_feed(spark.createDataFrame([good, padding], cols))
    assert all(g.first().ok for _, g in gates) and [r.Ticker for r in acted.collect()] == ["G"]
    bare = ("B", day) + (None,) * 5 + (0.5, 0.0, 0.0)          # a dividend without prices is no padding
    verdicts = {n: g.first().ok for n, g in J.finalise_feed(spark.createDataFrame([good, bare], cols))[1]}
    assert verdicts == {"actions": True, "price_values": False, "feed_keys": True}
    twice = spark.createDataFrame([good + (1,), good[:5] + (7.0,) + good[6:] + (2,)], cols + ", seq long")
    assert not dict(J.finalise_feed(twice.drop("seq"))[1])["feed_keys"].first().ok
    bars, gates, _ = J.finalise_feed(twice, "seq")
    assert dict(gates)["feed_keys"].first().ok and bars.first().Close == 7.0


def test_history_of_entities_with_actions_may_differ(spark, lake):
    days = weekdays("2025-03-03", 3)
    J.backfill_bars(lake, "us", raw(spark, {"X": days}, 10.0), nobody(spark), limits=LOOSE)
    with pytest.raises(GateRefused):
        J.backfill_bars(lake, "us", raw(spark, {"X": days}, 8.0), nobody(spark), limits=LOOSE)
    J.backfill_bars(lake, "us", raw(spark, {"X": days}, 8.0, dividends=1.0), nobody(spark), limits=LOOSE)
    assert {r.Close for r in lake.read(lake.bars("us")).collect()} == {8.0}


def test_rewrite_keeps_the_row_written_last(spark, lake):
    table = lake.bars("us")
    for close in (1.0, 2.0, 3.0):
        bars = J.finalise_feed(raw(spark, {"X": [d("2025-03-03")]}, close))[0]
        bars.coalesce(1).write.mode("append").partitionBy("year").parquet(table.path)
    J.rewrite(lake, "us", LOOSE)
    assert [r.Close for r in lake.read(table).collect()] == [3.0]


def test_update_reads_no_file_of_other_years(spark, lake, tmp_path):
    """Files of years a run does not touch are made unreadable: predecessors and counts come from the stored ends."""
    table = lake.bars("us")
    everyone = names(spark, ["A", "B"])
    for year in ("2022", "2023", "2025"):
        J.backfill_bars(lake, "us", raw(spark, {t: weekdays(f"{year}-06-02", 3) for t in "AB"}, float(year)), nobody(spark),
                        limits=LOOSE)
    for key, folder in table.manifest(spark).data.items():
        if key != "year=2025":
            for f in (tmp_path / "us" / "bars" / folder).glob("*.parquet"):
                f.write_bytes(b"no parquet")
    days = weekdays("2025-06-05", 2)
    J.update_bars(lake, "us", raw(spark, {t: days for t in "AB"}, 4050.0), everyone, nobody(spark),
                  F.lit(days[1].isoformat()).cast("date"), limits=LOOSE)
    rows = {(r.Ticker, r.Date): r for r in table.read(spark).where("year = 2025").collect()}
    assert len(rows) == 10 and rows["A", days[0]].ChangesRatio == pytest.approx(100.0)
    first = rows["B", d("2025-06-02")]
    assert first.ChangesRatio == pytest.approx((2025 / 2023 - 1) * 100)       # over the year between
    assert {(r.Ticker, r.year): (r.last, r.last_value) for r in lake.ends(table).collect()}["A", 2025] == (days[1], 4050.0)
    assert J.audit_backfill(lake, "us", F.lit("2023-01-01").cast("date")).count() == 0


def test_kr_fundamentals_refuses_failures_and_unproven_universes(spark, lake):
    accounts = spark.createDataFrame([("005930", 2026, 1, "CFS", "IS", "매출액", "100", None, 1)], "code string, year int, report_key int, "
                                     "fs_div string, sj_div string, account_nm string, thstrm_amount string, thstrm_add_amount string, ord int")
    universe, today = spark.createDataFrame([("005930", 10)], "Code string, Stocks long"), F.lit("2026-09-01").cast("date")
    for n, gate in ((9, "failure_rate"), (8, None)):
        requests = spark.range(10).select((F.col("id") < n).alias("failed"))
        if gate:
            with pytest.raises(GateRefused) as refusal:
                J.kr_fundamentals(lake, accounts, universe, today, requests=requests)
            assert refusal.value.gate == gate and lake.read(lake.financials("kr")).count() == 0
        else:
            J.kr_fundamentals(lake, accounts, universe, today, requests=requests)
    with pytest.raises(GateRefused) as refusal:
        J.kr_fundamentals(lake, accounts, universe, today, proof=spark.range(1).select(F.lit(False).alias("ok")))
    assert refusal.value.gate == "universe" and lake.read(lake.financials("kr")).count() == 1


def test_years_are_settled_in_one_plan(spark, lake):
    """A refused year stays, the others are settled; more years bring no more jobs."""
    floor, limits = F.lit("2020-01-01").cast("date"), J.Limits(min_universe=1000)
    spans = {y: weekdays(f"{y}-03-02", 2) for y in (2026, 2027, 2028, 2029, 2030)}
    days = [x for s in spans.values() for x in s]
    J.save_kr_bars(lake, kr(spark, days), limits=limits)

    def settle(years, close):
        official = kr(spark, spans[2026] + spans[2028] + spans[2029] + spans[2030], close).unionByName(kr(spark, spans[2027], 2000.0))
        spark.sparkContext.setJobGroup(f"settle-{len(years)}", "")
        out = {r.year: r for r in J.settle_kr_years(lake, official, years, floor, limits, refuse=False).collect()}
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"settle-{len(years)}")
        spark.sparkContext.setJobGroup("other", "")
        return out, len(jobs)

    out, few = settle([2025, 2026, 2027], 1001.0)
    assert {y: r.refused for y, r in out.items()} == {2025: "closed_year", 2026: None, 2027: "mass_change"}
    assert (out[2026].rows_replaced, out[2026].written, out[2026].mismatched_rows) == (20, True, 0)
    assert {(r.year, r.Close) for r in lake.read(lake.bars("kr")).select("year", "Close").distinct().collect()} == {
        (2026, 1001.0), (2027, 1000.0), (2028, 1000.0), (2029, 1000.0), (2030, 1000.0)}
    out, many = settle([2026, 2027, 2028, 2029, 2030], 1002.0)
    assert sorted(y for y, r in out.items() if r.written) == [2026, 2028, 2029, 2030]
    assert many <= few + 8
    assert {r.year for r in lake.read(lake.boundary()).collect()} == {2026, 2028, 2029, 2030}
    with pytest.raises(GateRefused) as refusal:
        J.settle_kr_years(lake, kr(spark, spans[2027], 2000.0), [2027], floor, limits)
    assert refusal.value.gate == "mass_change"
