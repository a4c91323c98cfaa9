"""Trading calendars and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelyard.functions import from_weekday_ordinal, is_weekday, weekday_floor


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day."""
    bounds = spark.range(1).select(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date")).alias("d"))
    return bounds.select(F.explode("d").alias("date"))


def session_status(days: DataFrame, holidays: DataFrame, covered: DataFrame) -> DataFrame:
    """open / closed / unknown with a reason, for ``days(date)``.

    ``holidays`` is (date, name); ``covered`` is (year) — a weekday of a year outside it is unknown.
    """
    known = covered.select(F.col("year").cast("int").alias("_year")).distinct().withColumn("_covered", F.lit(True))
    rows = (days.join(holidays.select("date", F.col("name").alias("_name")), "date", "left")
            .withColumn("_year", F.year("date")).join(known, "_year", "left"))
    status = (F.when(~is_weekday(F.col("date")), "closed").when(F.col("_covered").isNull(), "unknown")
              .when(F.col("_name").isNotNull(), "closed").otherwise("open"))
    reason = (F.when(~is_weekday(F.col("date")), "weekend")
              .when(F.col("_covered").isNotNull(), F.coalesce("_name", F.lit(""))).otherwise(""))
    return rows.select("date", status.alias("status"), reason.alias("reason"))


def trading_days(status: DataFrame) -> DataFrame:
    """Days counted as sessions; an unknown day counts."""
    return status.where(F.col("status") != "closed").select("date")


def missing_sessions(expected: DataFrame, actual: DataFrame, date: str = "date") -> DataFrame:
    """Expected dates without data."""
    return expected.select(date).join(actual.select(date).distinct(), date, "left_anti")


def gap_islands(df: DataFrame, entity: list[str], date: str, until: Column) -> DataFrame:
    """Runs of missing weekdays of each entity, from its first date to ``until``.

    Consecutive own weekdays are compared by running weekday number, so a run costs one row whatever its length.
    Weekend rows count as no session, dates after ``until`` are not looked at.
    """
    df = df.where(F.col(date) <= until)
    first = df.groupBy(*entity).agg(F.min(date).alias(date))
    sessions = df.where(is_weekday(F.col(date))).select(*entity, date).unionByName(first.select(*entity, date))
    numbered = sessions.select(*entity, weekday_floor(F.col(date)).alias("_no")).distinct()
    w = Window.partitionBy(*entity).orderBy("_no") if entity else Window.orderBy("_no")
    following = F.coalesce(F.lead("_no").over(w), weekday_floor(until) + 1)
    gaps = numbered.withColumn("_next", following).where(F.col("_next") - F.col("_no") > 1)
    return gaps.select(*entity, from_weekday_ordinal(F.col("_no") + 1).alias("gap_start"),
                       from_weekday_ordinal(F.col("_next") - 1).alias("gap_end"),
                       (F.col("_next") - F.col("_no") - 1).cast("long").alias("weekdays"))


def gap_since_last(
    sessions: DataFrame, status: DataFrame, today: Column, date: str = "date"
) -> DataFrame:
    """Trading days after the last stored session up to yesterday (from 1 January when nothing is stored)."""
    last = sessions.agg(F.coalesce(F.date_add(F.max(date), 1), F.trunc(today, "year")).alias("start"))
    return trading_days(status).where(
        (F.col("date") >= last.scalar()) & (F.col("date") <= F.date_sub(today, 1)))


def missing_months(done: DataFrame, spark: SparkSession, first: str, last: str, dtype: str) -> DataFrame:
    """Months of the range whose checkpoint is not 'done'.  ``done`` is (dtype, key 'yyyyMM', status)."""
    months = spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(first), "yyyyMM"), F.to_date(F.lit(last), "yyyyMM"), F.expr("interval 1 month"))).alias("m"))
    wanted = months.select(F.date_format("m", "yyyyMM").alias("key"))
    finished = done.where((F.col("dtype") == dtype) & (F.col("status") == "done")).select("key")
    return wanted.join(finished, "key", "left_anti")


def missing_years(done: DataFrame, spark: SparkSession, first: int, last: int, dtype: str) -> DataFrame:
    years = spark.range(first, last + 1).select(F.col("id").cast("string").alias("key"))
    finished = done.where((F.col("dtype") == dtype) & (F.col("status") == "done")).select("key")
    return years.join(finished, "key", "left_anti")
