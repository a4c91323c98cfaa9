from pyspark.sql import functions as F

from panelyard.operators import calendar as C
from panelyard.operators import ordered as O
from tests.conftest import d, weekdays


def status(spark, start="2026-09-21", end="2026-09-30", covered=(2026,)):
    days = C.day_range(spark, start, end)
    holidays = spark.createDataFrame([(d("2026-09-24"), "harvest"), (d("2026-09-25"), "harvest")], "date date, name string")
    years = spark.createDataFrame([(y,) for y in covered], "year int")
    return C.session_status(days, holidays, years)


def test_session_status(spark):
    got = {r.date.isoformat(): (r.status, r.reason) for r in status(spark).collect()}
    assert got["2026-09-23"] == ("open", "") and got["2026-09-24"] == ("closed", "harvest")
    assert got["2026-09-26"] == ("closed", "weekend")
    blind = {r.date.isoformat(): r.status for r in status(spark, covered=(2025,)).collect()}
    assert blind["2026-09-24"] == "unknown" and blind["2026-09-26"] == "closed"
    assert C.trading_days(status(spark, covered=(2025,))).count() == 8


def test_holidays_are_no_gap(spark):
    stored = spark.createDataFrame([(d("2026-09-23"),)], "date date")
    assert C.gap_since_last(stored, status(spark), F.lit("2026-09-26").cast("date")).count() == 0
    gap = C.gap_since_last(stored, status(spark), F.lit("2026-09-30").cast("date"))
    assert sorted(r.date for r in gap.collect()) == [d("2026-09-28"), d("2026-09-29")]


def islands(spark, dates, until):
    df = spark.createDataFrame([("A", d(x)) for x in dates], "e string, day date")
    return [(str(r.gap_start), str(r.gap_end), r.weekdays) for r in
            C.gap_islands(df, ["e"], "day", F.lit(until).cast("date")).orderBy("gap_start").collect()]


def test_gap_islands(spark):
    # Friday and Monday are consecutive weekdays: one island across the weekend
    assert islands(spark, ["2026-09-03", "2026-09-08"], "2026-09-08") == [("2026-09-04", "2026-09-07", 2)]
    assert islands(spark, ["2026-09-01", "2026-09-03"], "2026-09-07") == [("2026-09-02", "2026-09-02", 1), ("2026-09-04", "2026-09-07", 2)]
    assert islands(spark, ["2026-09-05", "2026-09-08"], "2026-09-08") == [("2026-09-07", "2026-09-07", 1)]
    assert islands(spark, ["2026-09-03", "2026-09-05", "2026-09-07"], "2026-09-07") == [("2026-09-04", "2026-09-04", 1)]
    assert islands(spark, ["2026-09-04", "2026-09-07"], "2026-09-06") == []


def test_missing_months(spark):
    done = spark.createDataFrame([("market", "202512", "done"), ("market", "202601", "in_progress"), ("prices", "202602", "done")],
                                 "dtype string, key string, status string")
    assert sorted(r.key for r in C.missing_months(done, spark, "202511", "202602", "market").collect()) == ["202511", "202601", "202602"]


def test_month_end_snapshot(spark):
    days = ["2026-05-28", "2026-05-29", "2026-05-31", "2026-06-10"]     # 31 May is a Sunday
    df = spark.createDataFrame([(d(x),) for x in days], "day date")
    got = {r.yyyymm: str(r.day) for r in O.month_end_snapshot(df, "day").collect()}
    assert got == {"202605": "2026-05-29", "202606": "2026-06-10"}


def test_internal_holes_against_brute_force(spark):
    days = weekdays("2026-09-01", 6)
    spans = {"A": days, "B": [days[0], days[3]], "C": [days[1], days[2], days[5]], "D": days[2:4]}
    df = spark.createDataFrame([("us", e, x) for e, xs in spans.items() for x in xs], "cohort string, e string, day date")
    expected = {(e, x) for e, xs in spans.items() for x in days if min(xs) < x < max(xs) and x not in xs}
    assert {(r.e, r.day) for r in O.internal_holes(df, "e", "day", ["cohort"]).collect()} == expected
    holes = {r.e: r.holes for r in O.entity_spans(df, "e", "day", ["cohort"]).collect()}
    assert holes == {e: sum(1 for k, _ in expected if k == e) for e in spans}


def test_rank_matches_the_plain_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 4000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 37 % 97).cast("double")).alias("v"), "id")
    w = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    plain = {r.id: r.rank for r in df.select("id", F.when(F.col("v").isNotNull(), F.rank().over(w)).alias("rank")).collect()}
    for spread in (2, 8):
        assert {r.id: r.rank for r in O.rank_within(df, ["g"], "v", spread=spread).collect()} == plain


def test_changes(spark):
    df = spark.createDataFrame([("A", d("2026-01-01"), 10.0), ("A", d("2026-01-02"), 11.0), ("A", d("2026-01-05"), 0.0), ("A", d("2026-01-06"), 5.0)],
                               "e string, day date, close double")
    got = [(r.changes, r.changes_ratio) for r in O.with_changes(df, "e", "day", "close").orderBy("day").collect()]
    assert got[0] == (None, None) and abs(got[1][1] - 10.0) < 1e-9 and got[3] == (5.0, None)
