import pytest
from pyspark.sql import functions as F

from panelyard.operators import merge as M
from panelyard.operators import settlement as S
from panelyard.schemas import KR_BARS, conform
from tests.conftest import d, weekdays

DAYS = weekdays("2026-09-01", 8)
CODES = [f"{i:05d}0" for i in range(12)]
FLOOR = "2026-09-01"


def panel(spark, days, close, volume, codes=CODES, **extra):
    rows = [(c, day, close, close, close + 5, close - 5, volume, 1e6 + i) for i, c in enumerate(codes) for day in days]
    df = spark.createDataFrame(rows, "Code string, Date date, Close double, Open double, High double, Low double, "
                                     "Volume long, Marcap double")
    df = df.withColumn("MarketId", F.lit("STK")).withColumn("Stocks", F.lit(100).cast("long"))
    for name, value in extra.items():
        df = df.withColumn(name, value)
    return conform(df, KR_BARS)


def settle(stored, official, floor=FLOOR):
    floor = F.lit(floor).cast("date")
    rules = S.kr_rules()
    compared = S.compare_settlement(stored, official, rules, floor)
    final = M.merge_policy(stored, S.rows_to_write(compared, rules), ["Code", "Date"], rules.policy)
    return compared, final, S.settlement_report(compared, official, rules, floor).first()


def test_replaces_measures_and_keeps_later_days(spark):
    stored = panel(spark, DAYS[:5], 1000.0, 100)
    official = panel(spark, DAYS[:4], 1010.0, 120)
    _, final, report = settle(stored, official)
    assert (report.rows_added, report.rows_replaced, report.dates) == (0, 4 * len(CODES), 4)
    got = {r.Date: r for r in final.where(F.col("Code") == CODES[0]).collect()}
    assert (got[DAYS[0]].Open, got[DAYS[0]].High, got[DAYS[0]].Low, got[DAYS[0]].Close, got[DAYS[0]].Volume) == (
        1010.0, 1015.0, 1005.0, 1010.0, 120)
    assert got[DAYS[4]].Close == 1000.0
    assert got[DAYS[0]].Market == "KOSPI"


def test_restores_missing_rows_and_days(spark):
    stored = panel(spark, [DAYS[0], DAYS[2]], 1010.0, 120, CODES[:-1])
    official = panel(spark, DAYS[:3], 1010.0, 120)
    _, final, report = settle(stored, official)
    assert report.rows_added == 2 + len(CODES)
    assert final.count() == 3 * len(CODES)


def test_second_settlement_changes_nothing(spark):
    stored = panel(spark, DAYS[:4], 1000.0, 100, CODES[1:], Name=F.lit("kept"), ChangeCode=F.lit("4"), Changes=F.lit(-1.0))
    official = panel(spark, DAYS[:3], 1010.0, 120, CODES[:-1], Changes=F.lit(10.0), Name=F.lit("theirs"),
                     Marcap=F.when(F.col("Code") == CODES[2], F.lit(None)).otherwise(F.lit(5.0)))
    _, final, _ = settle(stored, official)
    final = spark.createDataFrame(final.collect(), final.schema)
    compared, again, report = settle(final, official)
    assert (report.rows_added, report.rows_replaced) == (0, 0)
    assert S.rows_to_write(compared, S.kr_rules()).count() == 0
    row = final.where((F.col("Code") == CODES[3]) & (F.col("Date") == DAYS[0])).first()
    assert row.Name == "kept" and row.ChangeCode == "4"


def test_floor_and_unpublished_dates_stay(spark):
    stored = panel(spark, DAYS[:4], 1000.0, 100)
    official = panel(spark, DAYS[:4], 1010.0, 120)
    _, final, report = settle(stored, official, DAYS[2].isoformat())
    assert report.dates == 2
    assert {r.Date: r.Close for r in final.where(F.col("Code") == CODES[0]).collect()} == {
        DAYS[0]: 1000.0, DAYS[1]: 1000.0, DAYS[2]: 1010.0, DAYS[3]: 1010.0}


def test_rank_is_by_market_and_counts_rows_the_source_lacks(spark):
    market = F.when(F.col("Code").isin(*CODES[:3]), "KSQ").otherwise("STK")
    stored = panel(spark, DAYS[:1], 1000.0, 100, CODES[:5]).withColumn("MarketId", market).withColumn(
        "Market", F.when(market == "KSQ", "KOSDAQ").otherwise("KOSPI")).withColumn(
        "Marcap", F.when(F.col("Code") == CODES[4], 9e9).otherwise(F.col("Marcap")))
    official = panel(spark, DAYS[:1], 1010.0, 120, CODES[:4]).withColumn("MarketId", market)
    _, final, _ = settle(stored, official)
    got = {r.Code: r.Rank for r in final.collect()}
    assert got == {CODES[0]: 3, CODES[1]: 2, CODES[2]: 1, CODES[3]: 2, CODES[4]: 1}


def test_limit_code_survives_only_in_its_direction(spark):
    stored = panel(spark, DAYS[:1], 1000.0, 100, CODES[:3]).withColumn(
        "ChangeCode", F.when(F.col("Code") == CODES[0], "4").when(F.col("Code") == CODES[1], "5").otherwise("1"))
    official = panel(spark, DAYS[:1], 1010.0, 120, CODES[:3], Changes=F.lit(10.0))
    _, final, _ = settle(stored, official)
    assert {r.Code: r.ChangeCode for r in final.collect()} == {CODES[0]: "4", CODES[1]: "1", CODES[2]: "1"}


def test_reconcile_counts(spark):
    official = panel(spark, DAYS[:3], 1010.0, 120)
    final = panel(spark, [DAYS[0], DAYS[2]], 1010.0, 120, CODES[:-1]).unionByName(
        panel(spark, [DAYS[2]], 999.0, 120, ["ZZZ990"]))
    row = S.reconcile(final, official, ["Code", "Date"], "Date", ["Open", "Close"], F.lit(FLOOR).cast("date")).first()
    assert (row.missing_dates, row.extra_dates, row.missing_rows, row.extra_rows) == (1, 0, len(CODES) + 2, 1)
    assert (row.mismatch_Close, row.duplicate_keys, row.final_rows) == (0, 0, 2 * len(CODES) - 1)


@pytest.mark.parametrize("year, expected", [(2026, d("2026-09-04")), (2025, None)])
def test_boundary_lookup(spark, year, expected):
    table = spark.createDataFrame([(2026, d("2026-09-04"))], "year int, official_through date")
    assert S.boundary_of(table, year).first()[0] == expected
