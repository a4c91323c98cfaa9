"""Registry and the panel views derived from the given tables, in Spark and in SQL.

The panel is made of daily bars of users (events by user and day).  ``stored`` is the same panel as known at 16:00
(events before that hour), ``incoming`` a feed of the events from 08:00 on: their keys overlap, their values
differ, and together they cover every event.  ``official`` is the settled panel up to 25 January.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEYS = ["entity", "day"]
PRICES = ["open", "high", "low", "close"]
VALUES = [*PRICES, "volume", "amount"]
OFFICIAL_UNTIL, FLOOR, TODAY = "2024-01-25", "2024-01-05", "2024-01-30"

_BAR_SQL = """
    SELECT user_id AS entity, CAST(ts AS DATE) AS day, arg_min(value, ts) AS open, max(value) AS high,
           min(value) AS low, arg_max(value, ts) AS close, CAST(count(*) AS BIGINT) AS volume,
           CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS amount
    FROM events {where} GROUP BY 1, 2"""

KINDS = ("view", "purchase", "signup", "click", "error")
_KIND_SQL = "user_id * 5 + CASE event_type " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"

# Name -> (views it needs, SQL).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "bars": ((), _BAR_SQL.format(where="")),
    "stored": ((), _BAR_SQL.format(where="WHERE hour(ts) < 16")),
    "incoming": ((), _BAR_SQL.format(where="WHERE hour(ts) >= 8")),
    "official": (("bars",), f"SELECT * FROM bars WHERE day <= DATE '{OFFICIAL_UNTIL}'"),
    "sparse_bars": ((), _BAR_SQL.replace("FROM events", f"FROM (SELECT * REPLACE ({_KIND_SQL} AS user_id) FROM events)").format(
        where="")),
    "instruments": ((), """
    SELECT c_custkey AS entity, c_mktsegment AS market, r_name AS region,
           'U' || CAST(c_custkey AS VARCHAR)
             || CASE r_name WHEN 'EUROPE' THEN '.L' WHEN 'ASIA' THEN '.HK' ELSE '' END AS ticker
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "panel": (("bars", "instruments"), """
    SELECT bars.*, market, region, ticker FROM bars JOIN instruments USING (entity)"""),
}


def with_views(sql: str, *names: str) -> str:
    """Prefix a query with the views it uses."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in VIEWS[name][0]:
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    if not order:
        return sql.strip()
    head = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; ``sql`` (with the named views in front) must give the same rows."""

    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return fn

    return wrap


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def exact_sum(c: str) -> Column:
    """Sum in decimals, so the result does not depend on the order of rows."""
    return F.sum(F.col(c).cast("decimal(18,4)")).cast("double")


def to_bars(events: DataFrame) -> DataFrame:
    """Daily bars; (user, ts) is unique, so first and last value of a day are."""
    return events.groupBy(F.col("user_id").alias("entity"), F.to_date("ts").alias("day")).agg(
        F.min_by("value", "ts").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.max_by("value", "ts").alias("close"), F.count(F.lit(1)).alias("volume"), exact_sum("value").alias("amount"))


def bars(spark: SparkSession, sf: str) -> DataFrame:
    return to_bars(table(spark, sf, "events"))


def stored(spark: SparkSession, sf: str) -> DataFrame:
    return to_bars(table(spark, sf, "events").where(F.hour("ts") < 16))


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    return to_bars(table(spark, sf, "events").where(F.hour("ts") >= 8))


def official(spark: SparkSession, sf: str) -> DataFrame:
    return bars(spark, sf).where(F.col("day") <= day(OFFICIAL_UNTIL))


def sparse_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of every user and kind of event as an entity of its own: all events, but few days with a bar each."""
    kind = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])[F.col("event_type")]
    return to_bars(table(spark, sf, "events").withColumn("user_id", F.col("user_id") * 5 + kind))


def instruments(spark: SparkSession, sf: str) -> DataFrame:
    """Users as listed instruments: market, region and a ticker with the exchange suffix of the region."""
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suffix = F.when(F.col("r_name") == "EUROPE", ".L").when(F.col("r_name") == "ASIA", ".HK").otherwise("")
    return table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("market"), F.col("r_name").alias("region"),
        F.concat(F.lit("U"), F.col("c_custkey").cast("string"), suffix).alias("ticker"))


def markets(spark: SparkSession, sf: str) -> DataFrame:
    """Only the market of each user, without the region joins."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_mktsegment").alias("market"))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Bars with their market."""
    return bars(spark, sf).join(markets(spark, sf), "entity")


def named_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Bars with market, region and ticker."""
    return bars(spark, sf).join(instruments(spark, sf), "entity")


def day(text: str) -> Column:
    return F.lit(text).cast("date")
