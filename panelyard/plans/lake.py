"""The stored tables of one panel lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard import schemas as SC
from panelyard.plans.publish import Ends, Table


@dataclass(frozen=True)
class Lake:
    """Tables below one root folder on storage every executor can reach."""

    spark: SparkSession
    root: str

    def _table(self, name: str, schema, keys, partition="year", codec="snappy", ends=None) -> Table:
        return Table(f"{self.root}/{name}", schema, keys, partition, codec, ends)

    def bars(self, market: str) -> Table:
        if market == "kr":
            return self._table("kr/bars", SC.KR_BARS, ("Code", "Date"), ends=Ends("Code", "Date", "Close"))
        return self._table(f"{market}/bars", SC.BARS, ("Ticker", "Date"), ends=Ends("Ticker", "Date", "Close"))

    def financials(self, market: str) -> Table:
        return self._table(f"{market}/financials", SC.FINANCIALS, ("Ticker", "PeriodDate"), "period_year")

    def ratios(self, market: str) -> Table:
        return self._table(f"{market}/ratios", SC.RATIOS, ("Ticker", "SnapDate"))

    def tags(self, market: str) -> Table:
        return self._table(f"{market}/tags", SC.TAGS, ("Ticker",), None)

    def month_prices(self) -> Table:
        return self._table("prices", SC.MONTH_PRICES, ("date", "ticker"), "yyyymm", "zstd")

    def month_snapshots(self) -> Table:
        return self._table("market", SC.MARKET_SNAPSHOT, ("date", "ticker"), "yyyymm", "zstd")

    def cursors(self) -> Table:
        return self._table("state/cursors", SC.CURSORS, ("market",), None)

    def pending(self) -> Table:
        return self._table("state/pending", SC.PENDING, ("market", "kind", "ticker"), None)

    def checkpoints(self) -> Table:
        return self._table("state/checkpoints", SC.CHECKPOINTS, ("dtype", "key"), None)

    def boundary(self) -> Table:
        return self._table("state/boundary", SC.BOUNDARY, ("year",), None)

    def settlement_log(self) -> Table:
        return self._table("state/settlement_log", SC.SETTLEMENT_LOG, ("year", "at"), None)

    def read(self, table: Table) -> DataFrame:
        return table.read(self.spark)

    def ends(self, table: Table) -> DataFrame:
        """First and last date, last value and rows of every entity and partition; no rows are read."""
        return table.read_ends(self.spark)

    def queue(self, market: str, kind: str) -> DataFrame:
        """Tickers waiting in one of the market's retry lists."""
        rows = self.read(self.pending())
        return rows.where((F.col("market") == market) & (F.col("kind") == kind)).select(F.col("ticker").alias("Ticker"))


def by_year(df: DataFrame, date: str, name: str = "year") -> DataFrame:
    return df.withColumn(name, F.year(date))


def by_month(df: DataFrame, date: str = "date") -> DataFrame:
    """Month partition of a YYYYMMDD or YYYYMM text date."""
    return df.withColumn("yyyymm", F.substring(date, 1, 6).cast("int"))
