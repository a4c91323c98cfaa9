"""Report frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.operators.aggregates import year_summary
from panelyard.operators.calendar import gap_islands
from panelyard.operators.cursor import backfill_audit
from panelyard.operators.gates import coverage_continuity


def gap_list(df: DataFrame, date: str, until: Column) -> DataFrame:
    """Missing weekday runs of each year of the panel, up to the year's end or ``until``."""
    sessions = df.select(F.year(date).alias("year"), F.col(date).alias("date")).distinct()
    end = F.least(F.make_date(F.col("year"), F.lit(12), F.lit(31)), until)
    return gap_islands(sessions, ["year"], "date", end)


def year_report(df: DataFrame, entity: str, date: str, until: Column) -> DataFrame:
    """Status of each year with the number of gaps and of missing weekdays."""
    gaps = gap_list(df, date, until).groupBy("year").agg(
        F.count(F.lit(1)).alias("gaps"), F.sum("weekdays").alias("missing_weekdays"))
    return year_summary(df, entity, date).join(gaps, "year", "left").fillna(0, ["gaps", "missing_weekdays"])


def backfill_report(panels: dict[str, tuple[DataFrame, DataFrame]], entity: str, date: str, after: Column) -> DataFrame:
    """Late starters of every market: ``panels`` maps a market to (bars, pending)."""
    out = None
    for market, (bars, pending) in panels.items():
        part = backfill_audit(bars, pending, entity, date, after).select(F.lit(market).alias("market"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def coverage_metrics(verdict: DataFrame, date: str) -> DataFrame:
    """Date, count, baseline and ratio of a coverage verdict."""
    return verdict.select(date, "n", "baseline", F.try_divide(F.col("n") * 100.0, F.col("baseline")).alias("ratio_pct"))


def rewrite_report(before: DataFrame, after: DataFrame, entity: str, date: str) -> DataFrame:
    """Rows and refused days per year before and after a rewrite; ``ok`` when no refused day remains."""

    def counted(df: DataFrame, tag: str) -> DataFrame:
        daily = coverage_continuity(df.withColumn("year", F.year(date)), entity, date, by=["year"]).groupBy("year").agg(
            F.count_if(~F.col("ok")).alias(f"bad_{tag}"))
        rows = df.groupBy(F.year(date).alias("year")).agg(F.count(F.lit(1)).alias(f"rows_{tag}"))
        return rows.join(daily, "year")

    facts = after.groupBy(F.year(date).alias("year")).agg(
        F.countDistinct(entity).alias("entities"), F.max(date).alias("last_date"))
    return counted(before, "before").join(counted(after, "after"), "year").join(facts, "year").withColumn(
        "ok", F.col("bad_after") == 0)
