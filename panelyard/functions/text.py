"""Symbol and code expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An exchange suffix is a dot and two or three letters, or one of four single-letter exchanges.
EXCHANGE_SUFFIX = r"(\.(?:[A-Z]{2,3}|[LVFT]))$"
BLANKS = " \t\n\x0b\f\r"
QUOTE_SUFFIX = r"-USDT?$"
COMMON_STOCK = r"^[0-9]{5}0$"
SNAPSHOT_CODE = r"^[0-9A-Z]{6}$"


def strip_blank(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def exchange_suffix(c: Column) -> Column:
    """'.TO' for 'U-UN.TO'; '' when the symbol carries none."""
    return F.regexp_extract(F.upper(strip_blank(c)), EXCHANGE_SUFFIX, 1)


def is_foreign(c: Column) -> Column:
    return exchange_suffix(c) != ""


def cohort_of(c: Column, default: str) -> Column:
    """Instruments sharing an exchange calendar: the suffix, or the market itself."""
    suffix = exchange_suffix(c)
    return F.when(suffix != "", suffix).otherwise(F.lit(default))


def normalise_ticker(c: Column) -> Column:
    """Upper-case, no '$'; dots become hyphens except in a final exchange suffix; other characters go."""
    clean = F.replace(F.upper(strip_blank(c)), F.lit("$"), F.lit(""))
    suffix = F.regexp_extract(clean, EXCHANGE_SUFFIX, 1)
    base = F.regexp_replace(clean, EXCHANGE_SUFFIX, "")
    base = F.regexp_replace(F.replace(base, F.lit("."), F.lit("-")), "[^A-Z0-9-]", "")
    return F.concat(base, suffix)


def zero_fill(c: Column, width: int = 6) -> Column:
    """Left-pad with zeros; longer text is left alone (lpad alone would cut it)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def is_common_stock(code: Column) -> Column:
    return code.rlike(COMMON_STOCK)


def strip_quote(c: Column) -> Column:
    return F.regexp_replace(F.upper(strip_blank(c)), QUOTE_SUFFIX, "")


def id_symbol(base: Column, listing_id: Column) -> Column:
    return F.concat(base, listing_id.cast("string"), F.lit("-USD"))
