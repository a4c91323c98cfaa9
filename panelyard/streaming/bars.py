"""Event streams -> daily bars, with a one-week look-back for late data."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.operators.merge import keep_one
from panelyard.session import scratch_path
from panelyard.sources.readers import read_table

LOOKBACK_DAYS = 7


def open_events(spark: SparkSession, folder: str, pattern: str, time: str, files_per_batch: int = 64) -> DataFrame:
    """Stream Parquet files of a folder; event time becomes a zoned timestamp, which watermarks need."""
    schema = spark.read.option("pathGlobFilter", pattern).parquet(folder).schema
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", pattern)
           .option("maxFilesPerTrigger", files_per_batch).parquet(folder))
    return raw.withColumn(time, F.col(time).cast("timestamp"))


@dataclass(frozen=True)
class Run:
    """What a run's progress says: rows the state store refused, the watermark at its end, rows of state at most."""

    dropped: int
    watermark: datetime | None
    state_rows: int


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], label: str, mode: str = "update",
    checkpoint: str | None = None,
) -> Run:
    """Process everything available now, then stop.

    ``checkpoint`` is the folder (shared storage) that keeps the progress: a later run with the same folder goes on
    where this one stopped.  Without it the run starts anew.  A query keeps its last progress entries only, so they
    are gathered while it runs.
    """
    spark = stream.sparkSession
    dropped, state, marks, running = {}, {}, {}, []

    def gather() -> None:
        for progress in running[0].recentProgress if running else ():
            marks[progress["batchId"]] = progress["eventTime"].get("watermark")
            for i, op in enumerate(progress["stateOperators"]):
                at = progress["batchId"], i
                dropped[at] = max(dropped.get(at, 0), int(op["numRowsDroppedByWatermark"]))
                state[at] = int(op["numRowsTotal"])

    def counted(batch: DataFrame, number: int) -> None:
        if number % 10 == 0:
            gather()
        sink(batch, number)

    query = (stream.writeStream.outputMode(mode).foreachBatch(counted)
             .option("checkpointLocation", checkpoint or scratch_path(spark, f"{label}-progress"))
             .trigger(availableNow=True).start())
    running.append(query)
    query.awaitTermination()
    gather()
    found = [m for m in marks.values() if m]
    return Run(sum(dropped.values()), datetime.fromisoformat(max(found)) if found else None, max(state.values(), default=0))


# ---- stateful operators; rows behind the watermark go to a side table instead of being lost

def split_late(events: DataFrame, root: str, time: str, expires: Column, days: int = LOOKBACK_DAYS) -> None:
    """Land a stream below ``root/split``, each micro-batch split into rows in time and rows that are ``late``.

    A row is late when ``expires`` (the moment at which its state is closed) is not after the watermark: the newest
    event time of the batches before, less the look-back.  Each batch is written once, into a folder of its own that
    a repeated batch overwrites; its newest time follows from that write and is carried from batch to batch, so
    the split does not depend on how often a batch is tried.
    """
    spark = events.sparkSession

    def split(batch: DataFrame, number: int) -> None:
        before = None
        if number:
            before = spark.read.parquet(f"{root}/marks/batch={number - 1}").first().newest
        seen = Observation(f"newest-{number}-{uuid.uuid4().hex}")
        newest = F.date_trunc("millisecond", F.max(time))       # watermarks count milliseconds
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")
        late = F.coalesce(expires <= mark, F.lit(False))
        batch.observe(seen, newest.alias("newest")).withColumn("late", late).write.mode("overwrite").partitionBy(
            "late").parquet(f"{root}/split/batch={number}")
        both = [m for m in (before, seen.get["newest"]) if m is not None]
        spark.createDataFrame([(max(both, default=None),)], "newest timestamp").coalesce(1).write.mode("overwrite").parquet(
            f"{root}/marks/batch={number}")

    run_available(events, split, "split", "append", f"{root}/progress/split")


def _in_time(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The landed rows in time, as a stream.  A run takes all of them as one batch, with the watermark of the run
    before, so none is behind it."""
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{root}/split/batch=*/late=false")


def _late(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The side table: all rows that came late."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType()), T.StructField("late", T.BooleanType())])
    return spark.read.schema(full).parquet(f"{root}/split").where("late").select(*schema.names)


def _watermark(spark: SparkSession, root: str, run: Run) -> datetime | None:
    """The watermark that the stateful query itself reached; a run without new rows leaves the one before."""
    stored = f"{root}/watermark"
    if run.watermark is not None:
        spark.createDataFrame([(run.watermark.astimezone(timezone.utc).isoformat(),)], "at string").coalesce(1).write.mode(
            "append").parquet(stored)
    found = read_table(spark, stored, T.StructType([T.StructField("at", T.StringType())])).agg(F.max("at")).first()[0]
    return datetime.fromisoformat(found) if found else None


def collect_bars(
    events: DataFrame, root: str, entity: str, time: str, value: str, days: int = LOOKBACK_DAYS,
) -> tuple[DataFrame, Run]:
    """Daily bars of a stream of events from state-store aggregation, with ``final``; and what the run's progress says.

    ``root`` (shared storage) keeps landed rows, state, versions and progress: a later call goes on where this one
    stopped.  State is one row per entity and day inside the look-back.  Each run writes the bars that changed; the
    newest version of a bar counts.  Events behind the watermark are in the side table and are combined with their
    bars on reading, so none is lost, however late it comes.  A bar is ``final`` when its day ended by the stateful
    query's own watermark.
    """
    spark = events.sparkSession
    end = F.window(time, "1 day").end
    split_late(events, root, time, end, days)
    timed = _in_time(spark, root, events.schema).withWatermark(time, f"{days} days")
    parts = timed.groupBy(F.window(time, "1 day").alias("w"), F.col(entity).alias("entity")).agg(*_bar_columns(time, value)) \
        .select("entity", F.to_date("w.start").alias("day"), *_PARTS)
    versions = f"{root}/versions"
    run = run_available(parts, lambda batch, n: batch.write.mode("overwrite").parquet(f"{versions}/batch={n}"), "bars",
                        checkpoint=f"{root}/progress/bars")
    if run.dropped:
        raise ValueError(f"{run.dropped} rows in time were refused by the state store")
    kept = T.StructType([*parts.schema.fields, T.StructField("batch", T.IntegerType())])
    newest = keep_one(read_table(spark, versions, kept), ["entity", "day"], [F.col("batch").desc()]).drop("batch")
    late = bar_parts(_late(spark, root, events.schema), entity, time, value)
    bars = combine_parts(newest.unionByName(late))
    reached = _watermark(spark, root, run)
    ends = F.date_add("day", 1).cast("timestamp")
    return bars.withColumn("final", F.coalesce(ends <= F.lit(reached).cast("timestamp"), F.lit(False))), run


def collect_once(
    events: DataFrame, root: str, keys: list[str], time: str, days: int = LOOKBACK_DAYS,
) -> tuple[DataFrame, Run]:
    """The rows of a stream, each key once, and what the run's progress says.

    Repeats inside the look-back are dropped by the state store, whose state is the keys of two look-backs, also
    across restarts with the same ``root``.  Rows behind the watermark are in the side table; of them, on reading,
    those whose key was not passed on count, once.
    """
    spark = events.sparkSession
    split_late(events, root, time, F.col(time), days)
    once = _in_time(spark, root, events.schema).withWatermark(time, f"{days} days").dropDuplicatesWithinWatermark(keys)
    passed = f"{root}/passed"
    run = run_available(once, lambda batch, n: batch.write.mode("overwrite").parquet(f"{passed}/batch={n}"), "once", "append",
                        f"{root}/progress/once")
    if run.dropped:
        raise ValueError(f"{run.dropped} rows in time were refused by the state store")
    out = read_table(spark, passed, events.schema).select(*events.columns)
    late = _late(spark, root, events.schema).dropDuplicates(keys).join(out.select(*keys), keys, "left_anti")
    return out.unionByName(late.select(*out.columns)), run


# ---- bars from batches that share days

_EXACT = "decimal(38,4)"


_PARTS = ("opened", "open", "high", "low", "closed", "close", "volume", "amount")


def _bar_columns(time: str, value: str) -> list[Column]:
    return [F.min(time).alias("opened"), F.min_by(value, time).alias("open"), F.max(value).alias("high"),
            F.min(value).alias("low"), F.max(time).alias("closed"), F.max_by(value, time).alias("close"),
            F.count(F.lit(1)).alias("volume"), F.sum(F.col(value).cast("decimal(18,4)")).cast(_EXACT).alias("amount")]


def bar_parts(events: DataFrame, entity: str, time: str, value: str) -> DataFrame:
    """What one batch knows of each bar, in a form that combines: open and close keep their times."""
    return events.groupBy(F.col(entity).alias("entity"), F.to_date(time).alias("day")).agg(*_bar_columns(time, value))


def combine_parts(parts: DataFrame) -> DataFrame:
    """Whole bars from the parts of all batches."""
    return parts.groupBy("entity", "day").agg(
        F.min_by("open", "opened").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "closed").alias("close"), F.sum("volume").alias("volume"),
        F.sum("amount").cast("double").alias("amount"))


def upsert_stream(
    events: DataFrame, parts_path: str, by: Column, entity: str, time: str, value: str,
    publish: Callable[[DataFrame], None], label: str = "upsert", checkpoint: str | None = None,
) -> None:
    """Bars of a stream of events, published batch by batch; a day may be spread over any number of batches.

    Each batch writes its parts below ``parts_path``, in a folder of its own that a repeated batch overwrites, split
    by ``by`` (an expression over ``day``, the partition of the target, named ``part``).  Then the whole bars of the
    partitions it touched are combined from all parts of those partitions and given to ``publish``.
    """
    spark = events.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        own = f"{parts_path}/batch={number}"
        bar_parts(batch, entity, time, value).withColumn("part", by).write.mode("overwrite").partitionBy(
            "part").parquet(own)
        touched = [r[0] for r in spark.read.option("basePath", parts_path).parquet(own).select("part").distinct().collect()]
        if touched:
            publish(combine_parts(spark.read.parquet(parts_path).where(F.col("part").isin(*touched))))

    run_available(events, merge, label, mode="append", checkpoint=checkpoint)
