"""Date expressions.  Weekdays are numbered 0 (Monday) to 6 (Sunday)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONDAY = "1970-01-05"


def is_weekday(d: Column) -> Column:
    return F.weekday(d) < 5


def last_weekday(d: Column) -> Column:
    """The date itself, or the Friday before a weekend."""
    return F.date_sub(d, F.greatest(F.weekday(d) - 4, F.lit(0)))


def month_end_weekday(d: Column) -> Column:
    return last_weekday(F.last_day(d))


def quarter_end(year: Column, quarter: Column) -> Column:
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def text_day(c: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.to_date(c, pattern)


def weekday_floor(d: Column) -> Column:
    """Running number of the last weekday on or before the date, so differences count weekdays."""
    days = F.datediff(d, F.lit(_MONDAY).cast("date"))
    return (F.floor(days / 7) * 5 + F.least(F.pmod(days, F.lit(7)), F.lit(4))).cast("int")


def from_weekday_ordinal(n: Column) -> Column:
    return F.date_add(F.lit(_MONDAY).cast("date"), (F.floor(n / 5) * 7 + F.pmod(n, F.lit(5))).cast("int"))
