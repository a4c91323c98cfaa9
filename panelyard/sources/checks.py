"""Strict table checks.  Each returns verdict rows (per partition year), computed in one pass over pruned columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import finite, strip_blank
from panelyard.functions.text import SNAPSHOT_CODE
from panelyard.schemas import TAGS, conform

# Limits and columns of the official yearly file.
OFFICIAL_MEASURES = ("Open", "High", "Low", "Close", "Volume", "Amount", "Marcap", "Stocks")
MARKET_IDS = ("STK", "KSQ", "KNX")
TAG_TEXT = ("Sector", "Industry", "QuoteType")


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Schema test on the driver: required columns present, none repeated."""
    if len(set(df.columns)) != len(df.columns):
        raise ValueError("repeated column names")
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")


def validate_keys(
    df: DataFrame, keys: Sequence[str], partition: Column, expected: Column | None = None,
    rules: Mapping[str, Column] | None = None, allow_duplicates: bool = False,
) -> DataFrame:
    """Per partition: rows, blank keys, repeated keys, rows outside their partition, and broken rules.

    ``expected`` is the partition value the row should have (for instance the year of its date); ``rules`` maps a
    name to the condition that marks a bad row.  Rows are counted per key before they are counted per partition,
    so a key with very many copies is reduced where it is read.
    """
    require_columns(df, list(keys))
    rules = dict(rules or {})
    blank = F.lit(False)
    for k in keys:
        blank = blank | F.col(k).isNull() | (strip_blank(F.col(k).cast("string")) == "")
    wrong = F.lit(False) if expected is None else ~partition.eqNullSafe(expected)
    counted = [F.count_if(blank).alias("_blank"), F.count_if(wrong).alias("_wrong"),
               *[F.count_if(c).alias(f"_r_{n}") for n, c in rules.items()]]
    per_key = df.groupBy(partition.alias("partition"), *keys).agg(F.count(F.lit(1)).alias("_n"), *counted)
    out = per_key.groupBy("partition").agg(
        F.sum("_n").alias("rows"), F.sum("_blank").alias("blank_keys"),
        F.sum(F.col("_n") - 1).alias("duplicate_rows"), F.sum("_wrong").alias("wrong_partition"),
        *[F.sum(f"_r_{n}").alias(n) for n in rules])
    bad = F.col("blank_keys") + F.col("wrong_partition")
    for n in rules:
        bad = bad + F.col(n)
    if not allow_duplicates:
        bad = bad + F.col("duplicate_rows")
    return out.withColumn("ok", bad == 0)


def validate_bars(df: DataFrame, entity: str, date: str, year: Column | None = None, **options) -> DataFrame:
    """Bars: unique non-blank (entity, date); every date present and inside its partition year."""
    expected = F.year(date)
    return validate_keys(df, [entity, date], expected if year is None else year, expected, **options)


def infinity_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ratios only: an undefined ratio arrives as infinity and counts as missing."""
    cols = set(columns)
    return df.select(*[
        F.when(F.abs(F.col(c)) < float("inf"), F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def validate_fundamentals(
    df: DataFrame, entity: str, period: str, measures: Sequence[str], year: str | None = "Year",
    quarter: str | None = "Quarter",
) -> DataFrame:
    """Trimmed text keys, numbers finite or missing, and Year/Quarter equal to those of the period date."""
    rules = {
        "untrimmed": F.col(entity).cast("string") != strip_blank(F.col(entity).cast("string")),
        "bad_value": F.greatest(*[(F.col(c).isNotNull() & ~finite(F.col(c))).cast("int") for c in measures], F.lit(0)) > 0,
    }
    if year and quarter:
        rules["bad_period"] = ~((F.col(year) == F.year(period)) & (F.col(quarter) == F.quarter(period)))
    return validate_keys(df, [entity, period], F.year(period), rules=rules)


def upgrade_tags(df: DataFrame) -> DataFrame:
    """Tag table in today's layout: absent text fields become ''."""
    require_columns(df, [c for c in TAGS.names if c != "QuoteType"])
    out = conform(df, TAGS)
    return out.select(*[F.coalesce(c, F.lit("")).alias(c) if c in TAG_TEXT else F.col(c) for c in out.columns])


def validate_tags(df: DataFrame) -> DataFrame:
    """One verdict row: unique tickers without regard to case, a market on every row, readable UTC stamps."""
    key = F.upper(strip_blank(F.col("Ticker")))
    per_key = df.groupBy(key.alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.coalesce(strip_blank(F.col("Market")), F.lit("")) == "").alias("_m"),
        F.count_if(F.try_to_timestamp(F.col("updated_at")).isNull()).alias("_t"))
    out = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.coalesce("_k", F.lit("")) == "", F.col("_n"))), F.lit(0)).alias("blank_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum("_m"), F.lit(0)).alias("blank_market"),
        F.coalesce(F.sum("_t"), F.lit(0)).alias("bad_stamp"))
    return out.withColumn("ok", F.col("blank_keys") + F.col("duplicate_rows") + F.col("blank_market")
                          + F.col("bad_stamp") == 0)


def validate_snapshot(df: DataFrame, code: str, market_id: str, partition: Column,
                      date: str | None = None) -> DataFrame:
    """Daily snapshot files: unique codes of the right form, known markets; an own date column must agree."""
    rules = {"bad_code": ~F.coalesce(F.col(code).rlike(SNAPSHOT_CODE), F.lit(False)),
             "bad_market": ~F.coalesce(F.col(market_id).isin(*MARKET_IDS), F.lit(False))}
    if date:
        rules["bad_date"] = ~F.col(date).eqNullSafe(partition)
    return validate_keys(df, [code], partition, rules=rules)


def validate_official(
    df: DataFrame, code: str = "Code", date: str = "Date", market_id: str = "MarketId",
    measures: Sequence[str] = OFFICIAL_MEASURES, close: str = "Close", high: str = "High", low: str = "Low",
    volume: str = "Volume", markets: Sequence[str] = MARKET_IDS, code_pattern: str = SNAPSHOT_CODE,
    max_rows: int | None = None,
) -> DataFrame:
    """Official yearly tables, one verdict row per year.  ``max_rows`` refuses larger years; there is no limit else."""
    require_columns(df, [code, date, market_id, close, high, low, volume, *measures])
    broken = [(F.col(c).isNotNull() & (~finite(F.col(c)) | (F.col(c) < 0))).cast("int") for c in measures]
    verdict = validate_keys(df, [code, date], F.year(date), rules={
        "bad_code": ~F.coalesce(F.col(code).cast("string").rlike(code_pattern), F.lit(False)),
        "bad_market": ~F.coalesce(F.col(market_id).isin(*markets), F.lit(False)),
        "bad_value": F.greatest(*broken, F.lit(0)) > 0,
        "no_close": F.col(close).isNull(),
        "crossed": (F.col(volume) > 0) & (F.col(high) < F.col(low)),
    })
    return verdict if max_rows is None else verdict.withColumn("ok", F.col("ok") & (F.col("rows") <= max_rows))


def undated_rows(df: DataFrame, proof: DataFrame, date: str, source_date: str = "source_date") -> DataFrame:
    """One row: snapshot rows whose date differs from the date the source declared (text, ISO form)."""
    declared = proof.agg(F.max(F.when(F.col(source_date).rlike(r"^\d{4}-\d{2}-\d{2}$"),
                                      F.try_to_date(F.col(source_date))))).scalar()
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_if(~F.col(date).eqNullSafe(declared)).alias("mismatched")).withColumn(
        "ok", (F.col("rows") > 0) & (F.col("mismatched") == 0))
