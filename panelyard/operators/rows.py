"""Filters and projections over panel rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelyard.functions import finite, is_common_stock, is_foreign, month_end_weekday, zero_fill

# Market identifiers, their names, and the quote suffix of each market.
MARKET_OF_ID = {"STK": "KOSPI", "KSQ": "KOSDAQ", "KNX": "KONEX"}
ID_OF_MARKET = {"KOSPI": "STK", "KOSDAQ": "KSQ", "KOSDAQ GLOBAL": "KSQ", "KONEX": "KNX"}
SUFFIX_OF_MARKET = {"KOSPI": ".KS", "KOSDAQ": ".KQ", "KOSDAQ GLOBAL": ".KQ", "KONEX": ".KQ"}
DEFAULT_SUFFIX, DEFAULT_MARKET_ID = ".KS", "STK"

PRICES = ("Open", "High", "Low", "Close", "Volume")


def all_missing(columns: Sequence[str]) -> Column:
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).isNull()
    return test


def drop_empty_rows(df: DataFrame, columns: Sequence[str] = PRICES) -> DataFrame:
    """Padding rows in which every measure is missing."""
    return df.where(~all_missing(columns))


def nonfinite_rows(df: DataFrame, columns: Sequence[str] = PRICES) -> DataFrame:
    """Rows that must refuse the feed: some, but not all, measures are not real numbers."""
    bad = F.lit(False)
    for c in columns:
        bad = bad | ~finite(F.col(c))
    return df.where(bad & ~all_missing(columns))


def positive_close(df: DataFrame, close: str = "Close") -> DataFrame:
    return df.where(F.col(close) > 0)


def split_orphan_dates(df: DataFrame, entity: str, date: str) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): suffixed instruments lose the dates on which no unsuffixed instrument trades."""
    foreign = is_foreign(F.col(entity).cast("string"))
    home_dates = df.where(~foreign).select(date).distinct().withColumn("_home", F.lit(True))
    flagged = df.join(home_dates, date, "left")
    orphan = foreign & F.col("_home").isNull()
    return flagged.where(~orphan).select(*df.columns), flagged.where(orphan).select(*df.columns)


def common_stock(df: DataFrame, code: str) -> DataFrame:
    filled = zero_fill(F.trim(F.col(code).cast("string")))
    return df.withColumn(code, filled).where(is_common_stock(F.col(code)))


def ascii_symbols(df: DataFrame, symbol: str, rank: str, first: int) -> DataFrame:
    """'{SYM}-USD' for the first N listed rows with an ASCII symbol; N counts before the text filter."""
    clean = F.upper(F.trim(F.col(symbol)))
    return (df.where(F.col(rank) <= first).withColumn("ticker", clean)
            .where((F.col("ticker") != "") & F.col("ticker").rlike(r"^[\x00-\x7F]+$"))
            .withColumn("ticker", F.concat("ticker", F.lit("-USD"))))


def recent_rows(df: DataFrame, date: str, as_of: Column, days: int = 7) -> DataFrame:
    return df.where(F.col(date) >= F.date_sub(as_of, days))


def outside_range(df: DataFrame, date: str, start: Column, end: Column) -> DataFrame:
    """Rows that refuse a backfill: dates outside the requested range."""
    return df.where(~F.col(date).between(start, end))


def month_window(df: DataFrame, date: str) -> DataFrame:
    """Rows up to the last weekday of their own month."""
    return df.where(F.col(date) <= month_end_weekday(F.col(date)))


def target_entities(df: DataFrame, targets: DataFrame, entity: str) -> DataFrame:
    """Rows of the named entities, compared in upper case."""
    named = targets.select(F.upper(F.col(entity).cast("string")).alias("_entity")).distinct()
    return (df.withColumn("_entity", F.upper(F.col(entity).cast("string"))).join(named, "_entity", "left_semi")
            .select(*df.columns))


def exclude_dates(df: DataFrame, dates: DataFrame, date: str) -> DataFrame:
    return df.join(dates.select(date).distinct(), date, "left_anti").select(*df.columns)


def drop_unnamed(df: DataFrame, prefix: str = "Unnamed") -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(prefix)])


def repair_name(df: DataFrame, wrong: str = "ChagesRatio", right: str = "ChangesRatio") -> DataFrame:
    """Rename a misspelt column, or drop it when the right one is present."""
    if wrong not in df.columns:
        return df
    return df.drop(wrong) if right in df.columns else df.withColumnRenamed(wrong, right)


def mapped(c: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Look a value up in a small fixed table."""
    literal = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(literal, c)
    return found if default is None else F.coalesce(found, F.lit(default))


def market_name(market_id: Column) -> Column:
    return mapped(market_id, MARKET_OF_ID)


def market_id(market: Column) -> Column:
    return mapped(market, ID_OF_MARKET, DEFAULT_MARKET_ID)


def quote_symbol(code: Column, market: Column) -> Column:
    return F.concat(code, mapped(market, SUFFIX_OF_MARKET, DEFAULT_SUFFIX))


def only_on(day: Column, as_of: Column, value: Column) -> Column:
    """A current observation may be written on today's row only, never back-filled."""
    return F.when(day == as_of, value)
