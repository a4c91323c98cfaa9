"""Column expressions; all built from Spark's own functions, so they stay inside whole-stage code generation."""

from panelyard.functions.dates import (
    from_weekday_ordinal, is_weekday, last_weekday, month_end_weekday, quarter_end, text_day, weekday_floor,
)
from panelyard.functions.numbers import (
    direction_code, finite, finite_or_null, fraction_to_percent, is_close, loose_number, nan_to_null, parse_amount,
    per_share, same_text, same_value, symmetric_ratio, tick_size, turnover,
)
from panelyard.functions.text import (
    cohort_of, exchange_suffix, id_symbol, is_common_stock, is_foreign, normalise_ticker, strip_blank, strip_quote,
    zero_fill,
)

__all__ = [name for name in dir() if not name.startswith("_")]
