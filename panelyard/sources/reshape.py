"""Wide provider frames -> long panel rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Provider metrics of a bar, and statement line items with their field names.
METRICS = ("Open", "High", "Low", "Close", "Volume", "Dividends", "Stock Splits")
LINE_ITEMS = {
    "Total Revenue": "Revenue", "Gross Profit": "GrossProfit", "Operating Income": "OperatingIncome",
    "Net Income": "NetIncome", "EBITDA": "EBITDA", "Diluted EPS": "DilutedEPS",
    "Total Assets": "TotalAssets", "Total Liabilities Net Minority Interest": "TotalLiabilities",
    "Stockholders Equity": "Equity", "Operating Cash Flow": "OperatingCashFlow", "Free Cash Flow": "FreeCashFlow",
    "Capital Expenditure": "CapEx",
}


def wide_to_long(df: DataFrame, date: str, metrics: Sequence[str] = METRICS, ticker: str | None = None,
                 sep: str = "|") -> DataFrame:
    """(ticker, date, metric...) from columns named 'ticker|metric' or 'metric|ticker', or flat with ``ticker``.

    Which side is the metric is read from the names, so nothing is pivoted by a job: every wide row is unfolded
    into one row per ticker inside the same task.
    """
    values = [c for c in df.columns if c != date]
    if ticker is not None and not any(sep in c for c in values):
        return df.select(F.lit(ticker).alias("ticker"), date, *[F.col(f"`{c}`") for c in values])
    cells: dict[str, dict[str, int]] = {}
    for place, c in enumerate(values):
        left, right = c.split(sep, 1)
        name, metric = (left, right) if right in metrics else (right, left)
        cells.setdefault(name, {})[metric] = place
    used = [m for m in metrics if any(m in found for found in cells.values())]
    # the row's cells as one array, and one constant that says which cell is whose; a place of -1 reads as NULL
    layout = json.dumps([{"ticker": name, "at": [found.get(m, -1) for m in used]} for name, found in cells.items()])
    owners = F.from_json(F.lit(layout), "array<struct<ticker:string,at:array<int>>>")
    cell = F.array(*[F.col(f"`{c}`").cast("double") for c in values])
    wide = df.select(date, cell.alias("cells"), F.explode(owners).alias("owner"))
    return wide.select("owner.ticker", date, *[
        F.get("cells", F.get("owner.at", F.lit(i))).alias(m) for i, m in enumerate(used)])


def statement_rows(
    items: DataFrame, entity: str, item: str, period: str, value: str, names: Mapping[str, str] = LINE_ITEMS
) -> DataFrame:
    """Line items of several statements -> one row per entity and period, periods united."""
    fields = [F.max(F.when(F.col(item) == source, F.col(value))).alias(field) for source, field in names.items()]
    return items.groupBy(entity, period).agg(*fields).select(
        entity, period, F.year(period).alias("Year"), F.quarter(period).alias("Quarter"), *names.values())
