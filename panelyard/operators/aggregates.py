"""Grouped summaries.  Every one has a map-side partial, so a hot entity or date does not load a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import same_value, strip_blank


def session_counts(df: DataFrame, entity: str, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct entities per date (and group)."""
    return df.groupBy(*by, date).agg(F.countDistinct(entity).alias("n"))


def known_entities(df: DataFrame, entity: str) -> DataFrame:
    return df.select(entity).distinct()


def first_seen(df: DataFrame, entity: str, date: str) -> DataFrame:
    return df.groupBy(entity).agg(F.min(date).alias("first_date"))


def last_date(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.max(date).alias("last_date"))


def entity_count(df: DataFrame, entity: str, exempt: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Distinct entities (no case, no surrounding blanks), leaving exempt ones out."""
    keyed = df.select(*by, F.upper(strip_blank(F.col(entity).cast("string"))).alias("_e"))
    if exempt is not None:
        named = exempt.select(F.upper(strip_blank(F.col(entity).cast("string"))).alias("_e")).distinct()
        keyed = keyed.join(named, "_e", "left_anti")
    return keyed.groupBy(*by).agg(F.countDistinct("_e").alias("n"))


def year_summary(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Rows, sessions, first and last date and entities of each year."""
    return df.groupBy(F.year(date).alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(date).alias("sessions"), F.min(date).alias("first_date"),
        F.max(date).alias("last_date"), F.countDistinct(entity).alias("entities"))


def last_observation(df: DataFrame, entity: str, date: str, values: Sequence[str]) -> DataFrame:
    """Latest date of each entity with its values on that date."""
    top = F.max_by(F.struct(*values), F.col(date))
    return (df.groupBy(entity).agg(F.max(date).alias("last_date"), top.alias("_top"))
            .select(entity, "last_date", *[F.col(f"_top.{v}").alias(v) for v in values]))


def latest_names(df: DataFrame, entity: str, date: str, name: str, market: str) -> DataFrame:
    """Latest name and market of each entity, with the defaults '' and 'KOSPI'."""
    newest = last_observation(df, entity, date, [name, market])
    return newest.select(entity, F.coalesce(name, F.lit("")).alias(name),
                         F.coalesce(F.nullif(F.col(market), F.lit("")), F.lit("KOSPI")).alias(market))


def share(flag: Column, base: Column | None = None) -> Column:
    """Percentage of rows with the flag among the base rows; NULL without base rows."""
    base = F.lit(True) if base is None else base
    return F.try_divide(F.count_if(flag & base) * 100.0, F.count_if(base))


def all_within(df: DataFrame, entity: str, difference: Column, tolerance: Column) -> DataFrame:
    """Per entity: does every row keep within its tolerance?"""
    return df.groupBy(entity).agg(F.every(difference <= tolerance).alias("within"), F.count(F.lit(1)).alias("overlap"))


def difference_counts(df: DataFrame, columns: Sequence[str], left: str, right: str) -> DataFrame:
    """One row: differing rows per column, for a joined frame with two aliases."""
    return df.agg(*[F.count_if(~same_value(F.col(f"{left}.{c}"), F.col(f"{right}.{c}"))).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each key.  Counting per key first keeps a hot key out of any single task."""
    per_key = df.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(*by).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def corporate_actions(
    df: DataFrame, entity: str, dividends: str = "Dividends", splits: str = "Splits", gains: str | None = None
) -> DataFrame:
    """Entities with a dividend, a split or a distribution in the window, and whether the evidence is complete."""
    observed = (F.coalesce(F.col(dividends), F.lit(0.0)) != 0) | ~F.coalesce(F.col(splits), F.lit(0.0)).isin(0.0, 1.0)
    complete = F.col(dividends).isNotNull() & F.col(splits).isNotNull()
    if gains:
        observed = observed | (F.coalesce(F.col(gains), F.lit(0.0)) != 0)
        complete = complete & F.col(gains).isNotNull()
    return df.groupBy(entity).agg(F.bool_or(observed).alias("action"), F.bool_and(complete).alias("complete"))


def checkpoint_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("dtype").agg(F.count_if(F.col("status") == "done").alias("done"),
                                   F.count(F.lit(1)).alias("total"))


def failure_rate(df: DataFrame, failed: Column, limit: float = 0.9) -> DataFrame:
    """One row: refuse when at least ``limit`` of the entities failed (an empty run passes)."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(failed).alias("failed")).withColumn(
        "ok", (F.col("total") == 0) | (F.col("failed") < F.col("total") * limit))
