import json

import pytest
from pyspark.sql import functions as F

from panelyard.operators import aggregates as A
from panelyard.operators import gates as G
from panelyard.operators import ordered as O
from panelyard.operators import rows as R
from panelyard.schemas import BARS
from panelyard.sources import checks as K
from panelyard.sources import readers as S
from panelyard.sources import reshape as H
from tests.conftest import d


def test_absent_table_is_empty_and_partition_is_pruned(spark, tmp_path):
    assert S.read_table(spark, str(tmp_path / "none"), BARS).count() == 0
    path = str(tmp_path / "t")
    spark.createDataFrame([("A", 2024), ("B", 2025)], "Ticker string, year int").write.partitionBy("year").parquet(path)
    part = S.read_partition(spark, path, BARS, "year", 2025)
    assert [r.Ticker for r in part.collect()] == ["B"]
    assert "PartitionFilters: [isnotnull(year" in part._jdf.queryExecution().executedPlan().toString()
    files = spark.read.parquet(path)
    assert S.foreign_files(files, r"^part-.*\.parquet$").count() == 0
    assert S.foreign_files(files, r"^us_[0-9]{4}\.parquet$").count() == 2
    assert S.inventory(files).count() == 2


def test_nan_reads_as_null(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.createDataFrame([("A", float("nan"))], "Ticker string, Close double").write.parquet(path)
    assert S.read_table(spark, path).first().Close is None


def test_snapshot_csv(spark, tmp_path):
    (tmp_path / "2026-09-22.csv").write_text(",Code,MarketId,Close,Marcap,Stocks,ChagesRatio,Date\n"
                                             "0,005930,STK,85000,1e12,100,1.5,2026-09-22\n1,00680K,KSQ,x,,5,,2026-09-22\n")
    (tmp_path / "2026-09-23.csv").write_text(",Code,MarketId,Close,Marcap,Stocks,ChagesRatio,Date\n0,12,ZZZ,1,1,1,1,2026-09-24\n")
    rows = R.repair_name(S.read_snapshots(spark, str(tmp_path)))
    got = {r.Code: r for r in rows.collect()}
    assert got["005930"].Date == d("2026-09-22") and got["005930"].ChangesRatio == 1.5
    assert got["00680K"].Close is None and got["00680K"].Marcap is None
    verdict = {r.partition: r for r in K.validate_snapshot(rows, "Code", "MarketId", F.col("Date"), "own_date").collect()}
    assert verdict[d("2026-09-22")].ok
    bad = verdict[d("2026-09-23")]
    assert (bad.bad_code, bad.bad_market, bad.bad_date, bad.ok) == (1, 1, 1, False)


def test_snapshot_files_keep_their_own_header(spark, tmp_path):
    (tmp_path / "2026-09-22.csv").write_text('Code,Name,Close,MarketId\n000010,"A, B",100,STK\n')
    (tmp_path / "2026-09-23.csv").write_text("MarketId,Close,Code,Marcap\nKSQ,1.5,000020,7\n,,000030,\n")
    got = {r.Code: r for r in S.read_snapshots(spark, str(tmp_path)).collect()}
    assert (got["000010"].Name, got["000010"].Close, got["000010"].MarketId, got["000010"].Marcap) == ("A, B", 100.0, "STK", None)
    assert (got["000020"].Name, got["000020"].Close, got["000020"].MarketId, got["000020"].Marcap) == (None, 1.5, "KSQ", 7.0)
    assert got["000030"].MarketId is None and got["000030"].Date == d("2026-09-23")


def test_repeated_symbols_keep_the_last_entry(spark):
    entries = [{"symbol": "abc", "id": 1, "quotes": []}, {"symbol": "ABC ", "id": 2, "quotes": []}, {"symbol": "abc", "quotes": []}]
    rows = S.parse_listing(spark.createDataFrame([(json.dumps(entries),)], "items string")).collect()
    assert [(r.symbol, r.id) for r in rows] == [("ABC", 2)]


def test_a_response_is_hashed_before_its_entries_are_rows(spark):
    rows = S.parse_listing(spark.createDataFrame([("[]",)], "items string"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    generate = next(i for i, line in enumerate(plan) if "Generate posexplode" in line)
    hashed = [i for i, line in enumerate(plan) if "xxhash64(" in line]
    assert hashed and min(hashed) > generate                             # below the step that makes rows of entries


def test_listing_pages_grow_in_number_not_in_size(spark):
    from panelyard.workload.scans import listing_pages
    rows = [(c * 7 + n, c, 1.0 + n) for c in range(400) for n in range(5)] + [(9, None, 1.0), (9, 3, 2.0), (9, 3, 2.0)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double")
    pages = listing_pages(orders, most=100).collect()
    held = [[e["symbol"] for e in json.loads(r.value)["data"]["cryptoCurrencyList"]] for r in pages]
    assert len({r.page for r in pages}) == len(pages) > 16 and max(map(len, held)) < 250
    assert sum(map(len, held)) == len(rows) - 1                          # all but the order of nobody
    assert sum(len(set(h)) for h in held) == 400                         # a customer is on one page


def test_listing_json_both_shapes(spark, tmp_path):
    quote = {"price": 1.5, "marketCap": 9.0, "percentChange24h": 2.0, "percentChange7d": 3.0}
    entries = [{"symbol": " btc", "id": 1, "name": "Bitcoin", "circulatingSupply": 5.0, "tags": ["mineable", "pow"], "quotes": [quote]},
               {"symbol": "eth", "id": 2, "name": "Ether", "tags": [], "quotes": {"USD": quote}},
               {"symbol": "", "id": 3, "quotes": []}]
    (tmp_path / "a.json").write_text(json.dumps({"data": {"cryptoCurrencyList": entries}}))
    (tmp_path / "b.json").write_text(json.dumps({"data": entries[:1]}, indent=1))
    rows = S.read_listing(spark, str(tmp_path)).collect()
    assert sorted((r.symbol, r.id, r.price, r.tag) for r in rows) == [
        ("BTC", 1, 1.5, "mineable"), ("ETH", 2, 1.5, None)]


def test_ticker_and_watch_lists(spark, tmp_path):
    (tmp_path / "u.txt").write_text("# list\n AAPL \n\nMSFT\n#x\n")
    assert [r.ticker for r in S.read_ticker_list(spark, str(tmp_path / "u.txt")).collect()] == ["AAPL", "MSFT"]
    df = spark.createDataFrame([("미국", "AAPL"), ("ETF", "069500.ks"), ("한국", "X"), ("ETF", "SPY")], "category string, ticker string")
    assert [r.ticker for r in S.watch_list(df).collect()] == ["AAPL", "SPY"]
    with pytest.raises(ValueError):
        S.watch_list(df.drop("ticker"))


@pytest.mark.parametrize("form", ["{t}|{m}", "{m}|{t}"])
def test_wide_to_long(spark, form):
    names = [form.format(t=t, m=m) for t in ("QWX", "KLM-C") for m in ("Close", "Stock Splits")]
    df = spark.createDataFrame([(d("2026-09-22"), 1.0, 0.0, 2.0, None)], "Date date, " + ", ".join(f"`{n}` double" for n in names))
    out = H.wide_to_long(df, "Date").orderBy("ticker").collect()
    assert [(r.ticker, r.Close, r["Stock Splits"]) for r in out] == [("KLM-C", 2.0, None), ("QWX", 1.0, 0.0)]


def test_flat_frame_needs_a_ticker(spark):
    df = spark.createDataFrame([(d("2026-09-22"), 1.0)], "Date date, Close double")
    assert tuple(H.wide_to_long(df, "Date", ticker="QWX").first()) == ("QWX", d("2026-09-22"), 1.0)


def test_statement_rows_unite_periods(spark):
    rows = [("A", "Total Revenue", d("2026-06-30"), 5.0), ("A", "Total Assets", d("2026-03-31"), 7.0), ("A", "Other", d("2026-06-30"), 1.0)]
    out = H.statement_rows(spark.createDataFrame(rows, "t string, item string, p date, v double"), "t", "item", "p", "v")
    assert [(r.Quarter, r.Revenue, r.TotalAssets) for r in out.orderBy("p").collect()] == [(1, None, 7.0), (2, 5.0, None)]


def official(spark, **change):
    row = dict(Code="005930", Date=d("2026-09-22"), Open=1.0, High=2.0, Low=1.0, Close=1.0, Volume=1.0, Amount=1.0, Marcap=1.0, Stocks=1.0, MarketId="STK")
    row.update(change)
    return spark.createDataFrame([tuple(row.values())], "Code string, Date date, Open double, High double, Low double, Close double, "
                                 "Volume double, Amount double, Marcap double, Stocks double, MarketId string")


@pytest.mark.parametrize("change, field", [
    ({}, None), ({"Code": "5930"}, "bad_code"), ({"MarketId": "X"}, "bad_market"), ({"Amount": -1.0}, "bad_value"),
    ({"Open": float("inf")}, "bad_value"), ({"Close": None}, "no_close"), ({"High": 0.5}, "crossed"),
])
def test_official_rules(spark, change, field):
    row = K.validate_official(official(spark, **change)).first()
    assert row.ok is (field is None)
    assert field is None or row[field] == 1


def test_official_needs_its_columns(spark):
    with pytest.raises(ValueError):
        K.validate_official(official(spark).drop("Marcap"))
    row = K.validate_official(official(spark), max_rows=0).first()
    assert not row.ok


def test_key_rules(spark):
    df = spark.createDataFrame([("A", d("2026-01-01"), 2026), ("A", d("2026-01-01"), 2026), (" ", d("2026-01-02"), 2026), ("B", d("2025-01-02"), 2026)],
                               "t string, day date, year int")
    row = K.validate_bars(df, "t", "day", F.col("year")).first()
    assert (row.rows, row.blank_keys, row.duplicate_rows, row.wrong_partition, row.ok) == (4, 1, 1, 1, False)
    assert K.validate_bars(df.limit(2), "t", "day", F.col("year"), allow_duplicates=True).first().ok


def test_tag_rules(spark):
    cols = "Ticker string, Market string, Sector string, Industry string, updated_at string"
    good = spark.createDataFrame([("A", "US", None, "i", "2026-01-01T00:00:00")], cols)
    assert K.validate_tags(K.upgrade_tags(good)).first().ok and K.upgrade_tags(good).first().QuoteType == ""
    twice = good.unionByName(good.withColumn("Ticker", F.lit(" a ")))
    assert K.validate_tags(K.upgrade_tags(twice)).first().duplicate_rows == 1
    assert K.validate_tags(K.upgrade_tags(good.withColumn("updated_at", F.lit("soon")))).first().bad_stamp == 1


def test_dated_proof(spark):
    rows = spark.createDataFrame([(d("2026-09-22"),), (d("2026-09-22"),)], "Date date")
    proof = lambda text: spark.createDataFrame([(text,)], "source_date string")
    assert K.undated_rows(rows, proof("2026-09-22"), "Date").first().ok
    assert not K.undated_rows(rows, proof("2026-09-21"), "Date").first().ok
    assert not K.undated_rows(rows, proof("22.09.2026"), "Date").first().ok


def test_ascii_symbols_count_before_the_filter(spark):
    df = spark.createDataFrame([("BTC", 1), ("币安人生", 2), ("eth", 3), ("", 4), ("SOL", 5)], "s string, r int")
    assert [r.ticker for r in R.ascii_symbols(df, "s", "r", 4).orderBy("r").collect()] == ["BTC-USD", "ETH-USD"]


def test_ordered_union_and_actions(spark):
    from panelyard.functions import normalise_ticker
    a = spark.createDataFrame([("brk.b", 0), ("AAPL", 1)], "t string, n int")
    b = spark.createDataFrame([("BRK-B", 0), ("MSFT", 1)], "t string, n int")
    out = O.union_distinct([a, b], "t", "n", normalise_ticker).orderBy("source", "position")
    assert [r.t for r in out.collect()] == ["BRK-B", "AAPL", "MSFT"]
    df = spark.createDataFrame([("A", 0.0, 1.0), ("B", 0.5, 0.0), ("C", 0.0, 2.0), ("E", None, 0.0)], "t string, dv double, sp double")
    got = {r.t: (r.action, r.complete) for r in A.corporate_actions(df, "t", "dv", "sp").collect()}
    assert got == {"A": (False, True), "B": (True, True), "C": (True, True), "E": (False, False)}
    run = spark.createDataFrame([(i < 9,) for i in range(10)], "bad boolean")
    assert not A.failure_rate(run, F.col("bad")).first().ok
    assert A.failure_rate(run.limit(0), F.col("bad")).first().ok
    with pytest.raises(G.GateRefused) as refusal:
        G.require_all([("first", A.failure_rate(run, F.lit(False))), ("second", A.failure_rate(run, F.col("bad")))])
    assert refusal.value.gate == "second" and refusal.value.row["failed"] == 9
