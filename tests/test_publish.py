import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.operators import gates as G
from panelyard.plans import publish as P
from panelyard.plans import versions as V
from panelyard.session import shared_dir
from tests.conftest import d

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def frame(spark, year, n=10, v="a"):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(v).alias("v"), F.lit(year).alias("year"))


@pytest.fixture
def table(tmp_path):
    return P.Table(str(tmp_path / "t"), SCHEMA, ("k",), "year")


def test_only_touched_partitions_are_replaced(spark, table):
    P.publish(frame(spark, 2024).unionByName(frame(spark, 2025)), table)
    P.publish(frame(spark, 2025, 3, "b"), table)
    got = {(r.year, r.v): r["count"] for r in table.read(spark).groupBy("year", "v").count().collect()}
    assert got == {(2024, "a"): 10, (2025, "b"): 3}


def test_only_touched_files_are_read(spark, table):
    for year in range(2016, 2026):
        P.publish(frame(spark, year), table)
    feed = frame(spark, 2021, 2)
    rows = P.touched(table.read(spark), feed, "year")
    assert rows.count() == 10
    assert len(rows.inputFiles()) >= 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 2021" in plan
    assert P.touched(table.read(spark), feed.where("false"), "year").count() == 0


def test_emptied_partitions_are_removed(spark, table):
    P.publish(frame(spark, 2024).unionByName(frame(spark, 2025)).unionByName(frame(spark, 2026)), table)
    P.publish(frame(spark, 2025, 3, "b"), table, partitions=[2024, 2025])
    got = {(r.year, r.v): r["count"] for r in table.read(spark).groupBy("year", "v").count().collect()}
    assert got == {(2025, "b"): 3, (2026, "a"): 10}


def test_refusal_keeps_old_rows(spark, table):
    P.publish(frame(spark, 2024), table)
    no = lambda rows: rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("ok", F.lit(False))
    with pytest.raises(G.GateRefused):
        P.publish(frame(spark, 2024, 1, "z"), table, [("no", no)])
    assert table.read(spark).where("v = 'a'").count() == 10


def test_damaged_stage_is_noticed(spark, table, monkeypatch):
    P.publish(frame(spark, 2024), table)
    real = spark.read.__class__.parquet

    def shortened(self, *paths, **options):
        df = real(self, *paths, **options)
        return df.limit(4) if "/data/_version=" in str(paths[0]) else df

    monkeypatch.setattr(spark.read.__class__, "parquet", shortened)
    with pytest.raises(G.GateRefused) as refusal:
        P.publish(frame(spark, 2024, 8, "z"), table)
    monkeypatch.undo()
    assert refusal.value.gate == "staged_readback"
    assert table.read(spark).where("v = 'a'").count() == 10


def test_fingerprint_sees_moved_nulls(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k long, v string")
    b = spark.createDataFrame([(1, "x"), (2, None)], "k long, v string")
    code = lambda df: df.agg(*P._fingerprint(df, ["k", "v"])).first()["code"]
    assert code(a) != code(b) and code(a) == code(a.orderBy(F.desc("k")))


def test_merge_may_read_the_table_it_replaces(spark, table):
    P.publish(frame(spark, 2024), table)
    grown = table.read(spark).unionByName(frame(spark, 2024, 2, "new").withColumn("k", F.col("k") + 100))
    P.publish(grown, table)
    assert table.read(spark).count() == 12


def test_log_keeps_every_entry_that_changed_something(spark):
    cols = "year int, at timestamp, official_through date, rows_added long, rows_replaced long, rows_dropped long, first_date date, last_date date"
    import datetime as dt
    row = lambda day, n: (2026, dt.datetime(2026, 1, 1) + dt.timedelta(days=day), d("2026-01-01"), n, 0, 0, None, None)
    log = spark.createDataFrame([row(i, 1) for i in range(30)], cols)
    out = P.append_log(log, spark.createDataFrame([row(40, 2)], cols))
    assert out.count() == 31 and out.agg(F.max("rows_added"), F.min("at")).first()[1].day == 1
    assert P.append_log(log, spark.createDataFrame([row(41, 0)], cols)).agg(F.max("rows_added")).first()[0] == 1


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named.rstrip("/")


def test_crash_before_the_switch_leaves_the_old_version(spark, table, monkeypatch):
    P.publish(frame(spark, 2024).unionByName(frame(spark, 2025)), table)
    with monkeypatch.context() as lost:
        lost.setattr(V, "commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            P.publish(frame(spark, 2024, 3, "z").unionByName(frame(spark, 2025, 3, "z")), table)
    assert {(r.year, r.v) for r in table.read(spark).collect()} == {(2024, "a"), (2025, "a")}


def test_crash_between_two_partitions_leaves_the_old_version(spark, table):
    """The second partition cannot be written; nothing of the first is seen."""
    P.publish(frame(spark, 2024).unionByName(frame(spark, 2025)), table)
    broken = frame(spark, 2025, 3, "z").withColumn("k", F.when(F.col("k") < 2, F.col("k")).otherwise(
        F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        P.publish(frame(spark, 2024, 3, "z").unionByName(broken), table)
    assert {(r.year, r.v, r.k) for r in table.read(spark).collect()} == {
        (y, "a", k) for y in (2024, 2025) for k in range(10)}
    assert [n for n in V.names(spark, f"{table.path}/data")] == [V.latest(spark, table.path).data["year=2024"].split("/")[1]]


def test_half_written_manifest_is_no_version(spark, table, tmp_path):
    P.publish(frame(spark, 2024), table)
    (tmp_path / "t" / "manifest" / "000000000002.json").write_text('{"number": 2, "data": {"ye')
    assert table.read(spark).count() == 10
    P.publish(frame(spark, 2025, 4), table)
    assert V.latest(spark, table.path).number == 3 and table.read(spark).count() == 14


def test_slower_publication_is_refused(spark, table):
    P.publish(frame(spark, 2024), table)

    def meanwhile(rows):
        P.publish(frame(spark, 2025, 2, "b"), table)
        return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("ok", F.lit(True))

    with pytest.raises(V.PublicationConflict):
        P.publish(frame(spark, 2024, 1, "z"), table, [("meanwhile", meanwhile)])
    assert {(r.year, r.v) for r in table.read(spark).collect()} == {(2024, "a"), (2025, "b")}


def test_every_partition_is_written_once(spark, table):
    P.publish(frame(spark, 2024).unionByName(frame(spark, 2025)), table)
    first = V.latest(spark, table.path).data
    P.publish(frame(spark, 2025, 3, "b"), table)
    second = V.latest(spark, table.path).data
    assert second["year=2024"] == first["year=2024"] and second["year=2025"] != first["year=2025"]
    assert V.names(spark, f"{table.path}/data/{second['year=2025'].split('/')[1]}") == ["_SUCCESS", "year=2025"]


def test_reader_keeps_its_version_until_vacuum(spark, table):
    P.publish(frame(spark, 2024), table)
    before = table.read(spark)
    P.publish(frame(spark, 2024, 3, "b"), table)
    assert before.count() == 10 and table.read(spark).count() == 3
    P.publish(frame(spark, 2024, 2, "c"), table)
    gone = V.vacuum(spark, table.path, keep=2)
    assert [g.split("/")[0] for g in gone] == ["data", "manifest"]
    assert table.read(spark).count() == 2 and V.vacuum(spark, table.path, keep=2) == []


def test_landed_folders_are_adopted(spark, table):
    frame(spark, 2023).unionByName(frame(spark, 2024)).write.partitionBy("year").parquet(table.path)
    P.publish(frame(spark, 2024, 2, "b"), table)
    got = {(r.year, r.v): r["count"] for r in table.read(spark).groupBy("year", "v").count().collect()}
    assert got == {(2023, "a"): 10, (2024, "b"): 2}


def test_unpartitioned_and_empty_tables(spark, tmp_path):
    small = P.Table(str(tmp_path / "s"), SCHEMA, ("k",))
    assert small.read(spark).count() == 0
    small.create(spark)
    small.create(spark)
    assert small.read(spark).count() == 0 and V.latest(spark, small.path).number == 1
    P.publish(frame(spark, 1, 3).drop("year"), small)
    P.publish(small.read(spark).where("k > 0"), small)
    assert small.read(spark).count() == 2
    P.publish(small.read(spark).where("false"), small)
    assert small.read(spark).count() == 0


def test_ends_follow_the_rows(spark, tmp_path):
    dated = P.Table(str(tmp_path / "e"), SCHEMA, ("k",), "year", ends=P.Ends("v", "k", "k"))
    frame(spark, 2022, 4, "old").write.partitionBy("year").parquet(dated.path)
    P.publish(frame(spark, 2024).unionByName(frame(spark, 2025, 4, "b")), dated)
    P.publish(frame(spark, 2024, 3, "c"), dated, partitions=[2024, 2025])
    assert {tuple(r) for r in dated.read_ends(spark).collect()} == {("old", 2022, 0, 3, 3, 4), ("c", 2024, 0, 2, 2, 3)}
    assert dated.read_ends(spark).columns == ["v", "year", "first", "last", "last_value", "rows"]
