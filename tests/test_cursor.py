from pyspark.sql import functions as F

from panelyard.operators import cursor as C
from tests.conftest import d, weekdays

DAYS = weekdays("2026-09-14", 10)
PREV, TODAY = DAYS[0], DAYS[9]


def run(spark, spans, required=None, failed=(), previous=PREV, today=TODAY, **options):
    """``spans`` maps a ticker to its dates."""
    rows = [(t, day, "us") for t, days in spans.items() for day in days]
    df = spark.createDataFrame(rows, "Ticker string, Date date, cohort string")
    names = spark.createDataFrame([(t,) for t in (required or spans)], "Ticker string")
    lost = spark.createDataFrame([(t,) for t in failed], "Ticker string")
    return C.completeness_cursor(df, names, lost, "Ticker", "Date", "cohort", F.lit(previous), F.lit(today), **options).first()


def full(n, days=DAYS):
    return {f"T{i:02d}": list(days) for i in range(n)}


def test_complete_feed_moves_to_the_last_date(spark):
    row = run(spark, full(4))
    assert (row.status, row.cursor, row.holed, row.stale) == ("ok", DAYS[9], 0, 0)


def test_slowest_sound_entity_decides(spark):
    assert run(spark, {**full(5), "SLOW": DAYS[:9]}).cursor == DAYS[8]


def test_holed_and_stale_entities_do_not_decide(spark):
    row = run(spark, {**full(6), "HOLE": DAYS[:3] + DAYS[4:6], "DEAD": DAYS[:5]})
    assert (row.cursor, row.holed, row.stale) == (DAYS[9], 1, 1)


def test_three_days_behind_still_waits(spark):
    days = weekdays("2026-09-14", 5)            # Monday to Friday
    row = run(spark, {**full(3, days), "LATE": days[:2]}, previous=days[0], today=days[4])
    assert (row.cursor, row.stale) == (days[1], 0)


def test_refusals(spark):
    assert run(spark, full(2), required=["T00"]).status == "unexpected_entity"
    assert run(spark, full(10), required=[f"T{i:02d}" for i in range(11)]).status == "incomplete"
    assert run(spark, full(20), required=[f"T{i:02d}" for i in range(21)]).status == "ok"
    assert run(spark, {"A": DAYS[:2] + DAYS[:1]}).status == "invalid_dates"
    assert run(spark, {"A": [DAYS[0], DAYS[2]], "B": [DAYS[0], DAYS[1], DAYS[3]], "C": [DAYS[1], DAYS[3]]}).status == "session_unverified"
    assert run(spark, full(3), failed=["T00", "T01", "T02"]).status == "incomplete"


def test_empty_feed(spark):
    df = spark.createDataFrame([], "Ticker string, Date date, cohort string")
    names = spark.createDataFrame([("A",)], "Ticker string")
    row = C.completeness_cursor(df, names, names.where("false"), "Ticker", "Date", "cohort", F.lit(PREV), F.lit(TODAY)).first()
    assert row.status == "empty_unverified" and row.cursor is None


def test_sparse_date_holds_then_is_abandoned(spark):
    sparse = {t: [x for x in days if x != DAYS[3]] for t, days in full(6).items()}
    sparse["T00"] = DAYS
    row = run(spark, sparse, today=DAYS[5])
    assert (row.held, row.cursor) == (True, DAYS[2])
    late = run(spark, sparse, today=d("2026-09-30"))
    assert (late.held, late.cursor) == (False, DAYS[9])


def test_cursor_never_moves_back(spark):
    assert run(spark, full(3, DAYS[:4]), previous=DAYS[6]).cursor == DAYS[6]


def test_exchanges_keep_their_own_calendars(spark):
    rows = [(t, x, "us") for t in ("A", "B") for x in DAYS] + [(t, x, ".TO") for t in ("C.TO", "E.TO") for x in DAYS if x != DAYS[4]]
    df = spark.createDataFrame(rows, "Ticker string, Date date, cohort string")
    names = df.select("Ticker").distinct()
    row = C.completeness_cursor(df, names, names.where("false"), "Ticker", "Date", "cohort", F.lit(PREV), F.lit(TODAY)).first()
    assert (row.holed, row.cursor) == (0, DAYS[9])


def test_backfill_candidates_keep_universe_columns(spark):
    universe = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "Ticker string, position int")
    known = spark.createDataFrame([("A",), ("B",)], "Ticker string")
    pending = spark.createDataFrame([("B",), ("X",)], "Ticker string")
    got = C.backfill_candidates(universe, known, pending, "Ticker").orderBy("position").collect()
    assert [(r.Ticker, r.kind) for r in got] == [("B", "retry"), ("C", "new")]


def test_subset_run_only_lowers_the_oldest_date(spark):
    schema = "market string, last_updated date, ticker_count long, oldest_date date, updated_at timestamp"
    state = spark.createDataFrame([("us", d("2026-09-20"), 10, d("2021-01-01"), None)], schema)
    sub = spark.createDataFrame([("us", d("2026-09-22"), 11, d("2020-01-02"), None)], schema)
    row = C.advance_state(state, sub, subset=True).first()
    assert (row.last_updated, row.oldest_date, row.ticker_count) == (d("2026-09-20"), d("2020-01-02"), 11)
    assert C.advance_state(state, sub).first().last_updated == d("2026-09-22")
    assert C.advance_state(state.where("false"), sub, subset=True).first().last_updated == d("2026-09-22")


def test_prefix_stops_at_the_first_failure(spark):
    verdict = spark.createDataFrame([(DAYS[0], True), (DAYS[1], True), (DAYS[2], False), (DAYS[3], True)], "day date, ok boolean")
    assert sorted(r.day for r in C.accept_prefix(verdict, "day").collect()) == DAYS[:2]


def test_lookback(spark):
    assert spark.range(1).select(C.lookback_start(F.lit(d("2026-09-22")))).first()[0] == d("2026-09-16")


def test_missing_today_defaults(spark):
    hist = spark.createDataFrame([("A", d("2026-09-20"), None, ""), ("B", d("2026-09-20"), "b", "KOSDAQ"), ("OLD", d("2026-08-01"), "o", "K")],
                                 "Code string, Date date, Name string, Market string")
    now = spark.createDataFrame([("B",)], "Code string")
    got = C.missing_today(hist, now, "Code", "Date", F.lit(d("2026-09-22")), "Name", "Market").collect()
    assert [tuple(r) for r in got] == [("A", "", "KOSPI")]
