"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelyard.functions.text import strip_blank

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# Quotation step by price band, (upper bound, step); at and above the last bound the step is 1000.
TICK_BANDS = ((2_000, 1.0), (5_000, 5.0), (20_000, 10.0), (50_000, 50.0), (200_000, 100.0), (500_000, 500.0))
TOP_TICK = 1_000.0

# Direction implied by a stored change code, and the plain code of each direction.
CODE_DIRECTION = {"1": 1, "4": 1, "2": -1, "5": -1, "3": 0, "0": 0}
DIRECTION_CODE = {1: "1", -1: "2", 0: "3"}


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """True for a real number; NULL, NaN and infinities give False (never NULL)."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def finite_or_null(c: Column) -> Column:
    return F.when(finite(c), c)


def fraction_to_percent(c: Column) -> Column:
    return nan_to_null(c) * 100.0


def _number(text: Column) -> Column:
    # Java also reads "1d" or "0x1p3" as numbers, hence the explicit pattern before the cast.
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def parse_amount(c: Column) -> Column:
    """'1,234' -> 1234.0, '-56' -> -56.0; blanks, '-' and other text -> NULL."""
    return _number(F.replace(strip_blank(c), F.lit(","), F.lit("")))


def loose_number(c: Column) -> Column:
    """Keep digits, dots and minus signs only, then read a number; NULL when none is left."""
    return _number(F.regexp_replace(c, r"[^0-9.\-]", ""))


def same_value(a: Column, b: Column) -> Column:
    """Both missing, or equal.  For columns of one type."""
    return a.eqNullSafe(b)


def same_text(a: Column, b: Column) -> Column:
    """Both missing; equal as numbers when both read as numbers; otherwise equal as text."""
    x, y = _number(a), _number(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(F.coalesce(x == y, a == b))


def is_close(a: Column, b: Column, rel: float = 1e-7, absolute: float = 1e-8) -> Column:
    return F.abs(a - b) <= F.greatest(F.greatest(F.abs(a), F.abs(b)) * rel, F.lit(absolute))


def symmetric_ratio(a: Column, b: Column) -> Column:
    """max/min of two positive numbers; NULL when either is absent or not positive."""
    return F.when((a > 0) & (b > 0), F.greatest(a, b) / F.least(a, b))


def tick_size(price: Column) -> Column:
    step = F.when(price < TICK_BANDS[0][0], TICK_BANDS[0][1])
    for bound, size in TICK_BANDS[1:]:
        step = step.when(price < bound, size)
    return step.otherwise(TOP_TICK)


def turnover(close: Column, volume: Column) -> Column:
    return close * volume


def per_share(income: Column, shares: Column) -> Column:
    return F.when(nan_to_null(shares) > 0, F.try_divide(nan_to_null(income), shares))


def direction_code(change: Column, stored_code: Column) -> Column:
    """Keep the stored change code while its direction agrees with the sign of the change, else the plain code."""
    sign = F.signum(change).cast("int")
    implied = F.create_map(*[F.lit(x) for kv in CODE_DIRECTION.items() for x in kv])
    plain = F.create_map(*[F.lit(x) for kv in DIRECTION_CODE.items() for x in kv])
    agrees = F.try_element_at(implied, stored_code) == sign
    return F.when(F.coalesce(agrees, F.lit(False)), stored_code).otherwise(F.try_element_at(plain, sign))
