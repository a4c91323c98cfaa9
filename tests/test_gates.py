import pytest
from pyspark.sql import functions as F

from panelyard.operators import gates as G
from panelyard.operators import ordered as O
from panelyard.operators.calendar import session_status
from tests.conftest import d, weekdays

DAYS = weekdays("2026-09-01", 8)


def universe(spark, day_counts):
    """Rows (Code, Date) with the given number of codes on each date."""
    rows = [(f"{i:06d}", day) for day, n in day_counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "Code string, Date date")


@pytest.mark.parametrize("count, ok", [(270, True), (269, False)])
def test_write_coverage_boundary(spark, count, ok):
    stored = universe(spark, {day: 300 for day in DAYS[:5]})
    merged = stored.unionByName(universe(spark, {DAYS[5]: count}))
    targets = spark.createDataFrame([(DAYS[5],)], "Date date")
    row = G.write_coverage(merged, stored, targets, "Code", "Date").first()
    assert (row.n, row.baseline, row.ok) == (count, 300.0, ok)


def test_small_universe_and_missing_baseline_pass(spark):
    targets = spark.createDataFrame([(DAYS[5],)], "Date date")
    small = universe(spark, {day: 99 for day in DAYS[:5]})
    assert G.write_coverage(universe(spark, {DAYS[5]: 1}), small, targets, "Code", "Date").first().ok
    alone = universe(spark, {DAYS[5]: 150})
    row = G.write_coverage(alone, alone, targets, "Code", "Date").first()
    assert row.ok and not row.verified


def test_baseline_ignores_written_dates_and_looks_ahead(spark):
    counts = spark.createDataFrame([(DAYS[i], n) for i, n in enumerate([10, 20, 30, 40, 50, 60, 70, 80])], "Date date, n long")
    targets = spark.createDataFrame([(DAYS[0],), (DAYS[3],), (DAYS[7],)], "Date date")
    got = {r.Date: r.baseline for r in O.coverage_baseline(counts, targets, "Date").collect()}
    # usable: 20 30 50 60 70 (indices 1 2 4 5 6)
    assert got == {DAYS[0]: 50.0, DAYS[3]: 25.0, DAYS[7]: 50.0}


def test_previous_year_joins_a_short_baseline(spark):
    targets = spark.createDataFrame([(DAYS[1],)], "Date date")
    short = universe(spark, {DAYS[0]: 40})
    last_year = universe(spark, {day: 200 for day in weekdays("2025-12-22", 5)})
    merged = short.unionByName(universe(spark, {DAYS[1]: 150}))
    assert G.write_coverage(merged, short, targets, "Code", "Date").first().ok
    row = G.write_coverage(merged, short, targets, "Code", "Date", extra=last_year).first()
    assert row.baseline == 200.0 and not row.ok


@pytest.mark.parametrize("after, ok", [(100, True), (95, True), (94, False)])
def test_shrink_tolerance(spark, after, ok):
    before = universe(spark, {DAYS[0]: 100})
    row = G.shrink_guard(before, universe(spark, {DAYS[0]: after}), "Code").first()
    assert row.ok is ok


def test_shrink_first_write_and_exempt(spark):
    before, after = universe(spark, {DAYS[0]: 100}), universe(spark, {DAYS[0]: 50})
    assert G.shrink_guard(before.where("false"), after, "Code").first().ok
    gone = before.join(after, "Code", "left_anti").select("Code")
    assert G.shrink_guard(before, after, "Code", exempt=gone).first().ok


@pytest.mark.parametrize("second, ok", [(101, True), (180, False), (181, True)])
def test_continuity(spark, second, ok):
    first = 200 if second > 101 else 101
    df = universe(spark, {DAYS[0]: first, DAYS[1]: second})
    assert (G.coverage_continuity(df, "Code", "Date").where("not ok").count() == 0) is ok


def test_continuity_ignores_small_universe_and_new_dates(spark):
    assert G.coverage_continuity(universe(spark, {DAYS[0]: 99, DAYS[1]: 10}), "Code", "Date").where("not ok").count() == 0
    grown = universe(spark, {DAYS[0]: 200, DAYS[1]: 1, DAYS[2]: 200})
    known = universe(spark, {DAYS[0]: 1, DAYS[2]: 1})
    assert G.coverage_continuity(grown, "Code", "Date", only_dates=known).where("not ok").count() == 0


PRICE = "Ticker string, Date date, Open double, High double, Low double, Close double"


def bar(ticker, day, close):
    return (ticker, d(day), close, close, close, close)


@pytest.mark.parametrize("factor, ok", [(0.5, False), (2.0, False), (1.01, False), (1.0, True), (1 + 1e-9, True)])
def test_price_drift(spark, factor, ok):
    stored = spark.createDataFrame([bar("A", "2026-09-18", 100.0)], PRICE)
    feed = spark.createDataFrame([bar("A", "2026-09-18", 100.0 * factor), bar("A", "2026-09-21", 1.0)], PRICE)
    assert G.price_drift(stored, feed, "Ticker", "Date").first().ok is ok


def test_price_drift_tolerates_five_percent_of_entities(spark):
    stored = spark.createDataFrame([bar(f"T{i}", "2026-09-18", 100.0) for i in range(40)], PRICE)
    moved = stored.withColumn("Close", F.when(F.col("Ticker").isin("T1", "T2"), 50.0).otherwise(F.col("Close")))
    row = G.price_drift(stored, moved, "Ticker", "Date").first()
    assert row.ok and row.mismatched == 2 and row.compared == 40
    worse = stored.withColumn("Close", F.when(F.col("Ticker").isin("T1", "T2", "T3"), 50.0).otherwise(F.col("Close")))
    assert not G.price_drift(stored, worse, "Ticker", "Date").first().ok
    exempt = spark.createDataFrame([("T2",), ("T3",)], "Ticker string")     # 1 of 38 left
    assert G.price_drift(stored, worse, "Ticker", "Date", exempt=exempt).first().ok


def test_unsettled_bars_are_not_compared(spark):
    stored = spark.createDataFrame([bar("B", "2026-09-18", 1.0), bar("B", "2026-09-20", 1.0), bar("B", "2026-09-21", 1.0)], PRICE)
    late = spark.createDataFrame([bar("B", "2026-09-21", 9.0)], PRICE)
    settled = spark.createDataFrame([bar("B", "2026-09-18", 9.0)], PRICE)
    as_of = F.lit("2026-09-22").cast("date")
    assert G.price_drift(stored, late, "Ticker", "Date", unsettled_as_of=as_of).first().ok
    assert not G.price_drift(stored, settled, "Ticker", "Date", unsettled_as_of=as_of).first().ok


def test_non_finite_prices_refuse(spark):
    stored = spark.createDataFrame([bar("A", "2026-09-18", 100.0)], PRICE)
    broken = stored.withColumn("High", F.lit(float("nan")))
    assert not G.price_drift(stored, broken, "Ticker", "Date").first().ok


def test_verify_entities_within_one_tick(spark):
    schema = "Code string, Date date, Close double"
    ref = spark.createDataFrame([("005930", d("2026-09-23"), 85000.0), ("247540", d("2026-09-23"), 120000.0),
                                 ("000660", d("2026-09-23"), 700000.0)], schema)
    cand = spark.createDataFrame([("005930", d("2026-09-23"), 85000.0), ("000660", d("2026-09-23"), 700900.0),
                                  ("247540", d("2026-09-23"), 60000.0), ("111110", d("2026-09-23"), 1.0),
                                  ("005930", d("2026-09-28"), 86000.0)], schema)
    states = G.verify_entities(cand, ref, "Code", "Date")
    assert {r.Code: r.state for r in states.collect()} == {
        "005930": "verified", "000660": "verified", "247540": "rejected", "111110": "unmatched"}
    kept = G.accepted_rows(cand, states, "Code", "Date", F.lit("2026-09-28").cast("date"))
    assert [(r.Code, r.Date) for r in kept.collect()] == [("005930", d("2026-09-28"))]
    assert tuple(G.evidence(states).first()) == (2, 1, 1)


@pytest.mark.parametrize("moved, ok", [(20, True), (21, False)])
def test_mass_change_limit(spark, moved, ok):
    rows = [(DAYS[0], 100.0, 105.0 if i < moved else 100.0) for i in range(100)] + [(DAYS[0], 0.0, 5.0), (DAYS[0], 7.0, None)]
    row = G.mass_change(spark.createDataFrame(rows, "Date date, old double, new double"), "Date", "old", "new").first()
    assert (row.comparable, row.ok) == (100, ok)


def closed_case(spark, copies=100, same=100, holiday="2026-09-25", official_last="2026-09-28"):
    names = [f"{i:06d}" for i in range(100)]
    held = [(c, d("2026-09-24"), 10.0, 5.0) for c in names]
    held += [(c, d(holiday), 10.0 if i < same else 11.0, 5.0) for i, c in enumerate(names[:copies])]
    stored = spark.createDataFrame(held, "Code string, Date date, Close double, Volume double")
    official = spark.createDataFrame([(c, d(day)) for c in names for day in ("2026-09-24", official_last)],
                                     "Code string, Date date")
    drops = spark.createDataFrame([(d(holiday),)], "Date date")
    days = drops.select(F.col("Date").alias("date"))
    holidays = days.select("date", F.lit("harvest").alias("name"))
    status = session_status(days, holidays, days.select(F.year("date").alias("year")))
    return G.closed_copies(stored, official, drops, status, "Code", "Date").first()


def test_closed_copy_evidence(spark):
    assert closed_case(spark).ok
    assert closed_case(spark, same=99).ok and not closed_case(spark, same=98).ok
    assert not closed_case(spark, official_last="2026-09-25").ok      # the source does not reach past the day
    assert closed_case(spark).reason == "harvest"


def test_prelisting_rows(spark):
    stored = spark.createDataFrame([("A", d("2026-09-01"), 0.0), ("B", d("2026-09-01"), 3.0), ("C", d("2026-09-01"), None)],
                                   "Code string, Date date, Volume double")
    official = spark.createDataFrame([("A", d("2026-09-02")), ("B", d("2026-09-02")), ("C", d("2026-09-01")), ("Z", d("2026-09-01"))],
                                     "Code string, Date date")
    got = {r.Code: r.ok for r in G.prelisting_rows(stored, official, stored, "Code", "Date").collect()}
    assert got == {"A": True, "B": False, "C": False}


def test_provisional_sessions(spark):
    stored = universe(spark, {day: 1 for day in weekdays("2026-09-01", 11)})
    floor = F.lit("2026-09-01").cast("date")
    none = spark.createDataFrame([], "official_through date")
    assert not G.provisional_sessions(stored, none, "Date", floor).first().ok
    known = spark.createDataFrame([(d("2026-09-01"),)], "official_through date")
    assert G.provisional_sessions(stored, known, "Date", floor).first().provisional == 10


def test_rebase_safe(spark):
    old = [("A", y) for y in (2024, 2025) for _ in range(10)] + [("B", 2024)] * 10 + [("C", 2024)] * 10
    new = [("A", 2024)] * 9 + [("A", 2025)] * 10 + [("B", 2024)] * 8 + [("C", 2024)] * 10
    frame = lambda rows: spark.createDataFrame(rows, "Ticker string, y int")
    names = spark.createDataFrame([("a",), ("B",), ("C",), ("NEW",)], "Ticker string")
    failed = spark.createDataFrame([("c ",)], "Ticker string")
    got = {r.Ticker: r.safe for r in G.rebase_safe(frame(old), frame(new), names, failed, "Ticker", F.col("y")).collect()}
    assert got == {"A": True, "B": False, "C": False, "NEW": True}


def test_require_raises_with_the_offending_row(spark):
    verdict = spark.createDataFrame([(1, True), (2, False)], "n int, ok boolean")
    with pytest.raises(G.GateRefused) as refusal:
        G.require("demo", verdict)
    assert refusal.value.row["n"] == 2


def test_session_acceptance(spark):
    rows = [(DAYS[0], 1.0)] * 9 + [(DAYS[0], None)] + [(DAYS[1], 1.0)] * 8 + [(DAYS[1], 0.0)] * 2
    got = {r.d: r.ok for r in G.session_acceptance(spark.createDataFrame(rows, "d date, cap double"), "d", "cap").collect()}
    assert got == {DAYS[0]: True, DAYS[1]: False}
