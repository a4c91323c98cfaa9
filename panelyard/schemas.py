"""Table layouts and schema conformance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _D, _F, _L, _I = T.StringType(), T.DateType(), T.DoubleType(), T.LongType(), T.IntegerType()

# Column names and order of the stored tables.
MARKET_SNAPSHOT = _struct(date=_S, ticker=_S, PER=_F, PBR=_F, EPS=_F, BPS=_F, DIV=_F)
MONTH_PRICES = _struct(date=_S, ticker=_S, open=_F, high=_F, low=_F, close=_F, volume=_F)
BARS = _struct(Ticker=_S, Date=_D, Open=_F, High=_F, Low=_F, Close=_F, Volume=_F, Amount=_F, ChangesRatio=_F,
               MarketCap=_F, Dividends=_F, Splits=_F)
KR_BARS = _struct(Code=_S, Name=_S, Close=_F, Dept=_S, ChangeCode=_S, Changes=_F, ChangesRatio=_F, Volume=_L,
                  Amount=_F, Open=_F, High=_F, Low=_F, Marcap=_F, Stocks=_L, Market=_S, MarketId=_S, Rank=_L, Date=_D)
FINANCIALS = _struct(Ticker=_S, PeriodDate=_D, Year=_I, Quarter=_I, Revenue=_F, GrossProfit=_F, OperatingIncome=_F,
                     NetIncome=_F, EBITDA=_F, DilutedEPS=_F, TotalAssets=_F, TotalLiabilities=_F, Equity=_F,
                     OperatingCashFlow=_F, FreeCashFlow=_F, CapEx=_F, SnapDate=_D)
RATIOS = _struct(Ticker=_S, SnapDate=_D, Name=_S, Sector=_S, Industry=_S, MarketCap=_F, SharesOutstanding=_F, PE=_F,
                 ForwardPE=_F, PB=_F, PS=_F, ROE=_F, ROA=_F, DebtToEquity=_F, Beta=_F, HeldPctInstitutions=_F,
                 DividendYield=_F, EPS=_F, ProfitMargin=_F, OperatingMargin=_F, RevenueGrowth=_F, EarningsGrowth=_F,
                 CurrentRatio=_F)
TAGS = _struct(Ticker=_S, Market=_S, Sector=_S, Industry=_S, updated_at=_S, QuoteType=_S)
CURSORS = _struct(market=_S, last_updated=_D, ticker_count=_L, oldest_date=_D, updated_at=T.TimestampType())
PENDING = _struct(market=_S, kind=_S, ticker=_S)
CHECKPOINTS = _struct(dtype=_S, key=_S, status=_S)
BOUNDARY = _struct(year=_I, official_through=_D)
SETTLEMENT_LOG = _struct(year=_I, at=T.TimestampType(), official_through=_D, rows_added=_L, rows_replaced=_L,
                         rows_dropped=_L, first_date=_D, last_date=_D)


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = False) -> DataFrame:
    """Select the schema's columns in its order; absent ones become NULL, unknown ones are dropped or kept last."""
    present = set(df.columns)
    columns: list[Column] = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    if keep_extra:
        known = set(schema.names)
        columns += [F.col(c) for c in df.columns if c not in known]
    return df.select(*columns)


def missing_to_null(df: DataFrame) -> DataFrame:
    """One representation of 'missing': NaN in floating columns becomes NULL."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns])


def value_columns(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in set(keys)]
