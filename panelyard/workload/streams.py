"""Structured Streaming over the events table, run until everything available is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelyard.operators import gates as G
from panelyard.operators import merge as M
from panelyard.plans import publish as P
from panelyard.session import scratch_path
from panelyard.streaming import bars as S
from panelyard.workload.base import KEYS, query, table
from panelyard.workload.publication import _BARS


def _halves(spark, sf):
    """Events landed as six files in no order of time, in two goes: each go is a run, the second from the first's progress."""
    events, landed = table(spark, sf, "events"), scratch_path(spark, "landed")
    for half in (0, 1):
        some = events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        some.repartition(3, F.xxhash64("event_id")).write.mode("append").parquet(landed)
        yield S.open_events(spark, landed, "*.parquet", "ts", files_per_batch=1)


def _bars_of_halves(spark, sf):
    root, bars = scratch_path(spark, "bar-state"), None
    for events in _halves(spark, sf):
        bars, _ = S.collect_bars(events, root, "user_id", "ts", "value")
    return bars


@query("stream_bars", "SELECT entity, day, open, high, low, close, volume, amount FROM bars", ("bars",))
def stream_bars(spark, sf):
    """State-store aggregation over unordered files, stopped halfway; what came behind the watermark is in the side table."""
    return _bars_of_halves(spark, sf).select("entity", "day", "open", "high", "low", "close", "volume", "amount")


@query("stream_final_flags", """
SELECT entity, day, close, day + INTERVAL 1 DAY <= (SELECT max(date_trunc('millisecond', ts)) FROM events) - INTERVAL 7 DAY AS final,
       day < (SELECT max(day) FROM bars) - 7 AS final_by_day
FROM bars
""", ("bars",))
def stream_final_flags(spark, sf):
    """Bars whose day the stateful query's own watermark has passed are final; beside it the rule by the newest day."""
    bars = _bars_of_halves(spark, sf)
    edge = bars.agg(F.max("day")).scalar()
    return bars.select("entity", "day", "close", "final", (F.col("day") < F.date_sub(edge, 7)).alias("final_by_day"))


@query("stream_dedup", """
SELECT event_id, user_id, event_type, ts FROM events
""")
def stream_dedup(spark, sf):
    """The feed of 20 days and again its last days with the rest, both delivered twice and each a run: every event counts
    once, and the state holds the look-back only."""
    events, landed, root = table(spark, sf, "events"), scratch_path(spark, "landed"), scratch_path(spark, "once")
    out = None
    for first, last in ((1, 20), (15, 31)):
        some = events.where(F.dayofmonth("ts").between(first, last)).select("event_id", "user_id", "event_type", "ts")
        for turn in range(2):
            some.coalesce(1).write.mode("append").parquet(landed)
        out, _ = S.collect_once(S.open_events(spark, landed, "*.parquet", "ts", files_per_batch=2), root, ["event_id"], "ts")
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_upsert", """
SELECT entity, day, open, high, low, close, volume, amount, CAST(week(day) AS INTEGER) AS week FROM bars
""", ("bars",))
def stream_upsert(spark, sf):
    """Events landed in six files that cut across days, one file a batch, upserted through merge, gate and publication;
    the stream stops after half of them and goes on from its checkpoint."""
    target = P.Table(scratch_path(spark, "upserted"), _BARS, KEYS, "week")
    target.create(spark)
    events, landed = table(spark, sf, "events"), scratch_path(spark, "landed")
    parts, progress = scratch_path(spark, "parts"), scratch_path(spark, "upsert-progress")

    def publish(whole):
        feed = whole.select("*", F.weekofyear("day").alias("week"))
        current = P.touched(target.read(spark), feed, "week")
        merged = M.merge_last(current, feed, KEYS)
        P.publish(merged, target, [("shrink", lambda staged: G.shrink_guard(current, staged, "entity", ["week"]))])

    for half in (0, 1):
        some = events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half)
        some.repartition(3).write.mode("append").parquet(landed)
        S.upsert_stream(S.open_events(spark, landed, "*.parquet", "ts", files_per_batch=1), parts, F.weekofyear("day"),
                        "user_id", "ts", "value", publish, checkpoint=progress)
    return target.read(spark)
