"""Instrument identity: does a symbol really carry the prices of the listed instrument?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.functions import id_symbol, strip_blank, strip_quote, symmetric_ratio
from panelyard.operators.aggregates import last_observation
from panelyard.operators.merge import first_source
from panelyard.session import materialise

# Price ratios that replace, suspect and confirm a symbol; days without bars that raise suspicion.
MISMATCH_RATIO, SUSPECT_RATIO, CONFIRM_RATIO, STALE_DAYS = 5.0, 2.0, 1.5, 3


def _listed(observed: DataFrame, listing: DataFrame) -> DataFrame:
    """Observed tickers beside their listing entry and its id-suffixed symbol."""
    entries = listing.select(F.col("symbol").alias("_base"), F.col("id").alias("_id"), F.col("price").alias("_listed"))
    rows = observed.withColumn("_base", strip_quote(F.col("ticker"))).join(entries, "_base")
    return (rows.where((F.col("price") > 0) & (F.col("_listed") > 0))
            .withColumn("_ratio", symmetric_ratio(F.col("price"), F.col("_listed")))
            .withColumn("symbol", id_symbol(F.col("_base"), F.col("_id"))))


def price_overrides(observed: DataFrame, listing: DataFrame, ratio: float = MISMATCH_RATIO) -> DataFrame:
    """(ticker, symbol) where the observed price is further than ``ratio`` from the listed one, either way.

    ``observed`` is (ticker, price); ``listing`` is (symbol, id, price), unique by symbol.
    """
    return _listed(observed, listing).where(F.col("_ratio") > ratio).select("ticker", "symbol")


def suspects(
    latest: DataFrame, listing: DataFrame, decided: DataFrame, ratio: float = SUSPECT_RATIO, days: int = STALE_DAYS
) -> DataFrame:
    """Undecided tickers whose price is off by more than ``ratio`` or whose bars stopped; with the alternate symbol.

    ``latest`` is (ticker, price, last_date).
    """
    newest = latest.agg(F.max("last_date")).scalar()
    rows = _listed(latest, listing).join(decided.select("ticker"), "ticker", "left_anti")
    stopped = F.datediff(newest, F.col("last_date")) > days
    return rows.where((F.col("_ratio") > ratio) | stopped).select(
        "ticker", "symbol", F.col("_listed").alias("listed_price"))


def confirmed_overrides(candidates: DataFrame, alternates: DataFrame, ratio: float = CONFIRM_RATIO) -> DataFrame:
    """Suspects whose alternate symbol trades close to the listing.  ``alternates`` is (symbol, price)."""
    probe = alternates.select("symbol", F.col("price").alias("_probe"))
    close = symmetric_ratio(F.col("_probe"), F.col("listed_price")) <= ratio
    return candidates.join(probe, "symbol").where(close).select("ticker", "symbol")


def symbol_overrides(
    bars: DataFrame, listing: DataFrame, alternates: DataFrame, discovered: DataFrame, date: str = "Date",
    close: str = "Close",
) -> DataFrame:
    """The final map: price mismatches, then confirmed suspects, then symbols found by search."""
    latest = materialise(last_observation(bars, "ticker", date, [close]).withColumnRenamed(close, "price"), "latest")
    wrong = price_overrides(latest, listing)
    confirmed = confirmed_overrides(suspects(latest, listing, wrong), alternates)
    return first_source([wrong, confirmed, discovered.select("ticker", "symbol")], ["ticker"])


def purge_targets(overrides: DataFrame, failed: DataFrame) -> DataFrame:
    """Overridden tickers whose download did not fail outright; only their stored rows may be dropped."""
    lost = failed.select(F.upper(strip_blank(F.col("ticker"))).alias("_t")).distinct()
    return (overrides.withColumn("_t", F.upper(strip_blank(F.col("ticker")))).join(lost, "_t", "left_anti")
            .select("ticker"))


def retry_candidates(missing: DataFrame, listing: DataFrame, found: DataFrame, tried: DataFrame) -> DataFrame:
    """The next symbol to try per missing ticker: the id-suffixed one, else a search hit of the right shape.

    ``found`` is (ticker, symbol) search hits; ``tried`` is (ticker, symbol) already queried.
    """
    base = missing.select("ticker", strip_quote(F.col("ticker")).alias("_base"))
    by_id = base.join(listing.select(F.col("symbol").alias("_base"), "id"), "_base").select(
        "ticker", id_symbol(F.col("_base"), F.col("id")).alias("symbol"), F.lit(0).alias("_order"))
    shape = F.concat(F.lit(r"(?i)^\Q"), F.col("_base"), F.lit(r"\E[0-9]*-USD$"))
    searched = base.join(found, "ticker").where(F.regexp_like("symbol", shape))
    options = by_id.unionByName(searched.select("ticker", "symbol", F.lit(1).alias("_order")))
    asked = tried.select("ticker", F.upper("symbol").alias("_s")).unionByName(
        missing.select("ticker", F.upper("ticker").alias("_s"))).distinct()
    fresh = options.withColumn("_s", F.upper("symbol")).join(asked, ["ticker", "_s"], "left_anti")
    return fresh.groupBy("ticker").agg(F.min_by("symbol", F.struct("_order", "symbol")).alias("symbol"))


def relabel(df: DataFrame, overrides: DataFrame, ticker: str) -> DataFrame:
    """Rows fetched under an alternate symbol are stored under the original ticker."""
    names = overrides.select(F.col("symbol").alias("_symbol"), F.col("ticker").alias("_original"))
    joined = df.join(names, df[ticker] == F.col("_symbol"), "left")
    return joined.select(*[
        F.coalesce(F.col("_original"), df[ticker]).alias(c) if c == ticker else df[c] for c in df.columns])
