"""Column expressions. All are built-in Spark functions: no Python UDFs."""

from subledger.functions.numbers import money, safe_ratio, signed_amount, to_number
from subledger.functions.text import NULL_TOKENS, clean_text, is_null_like, norm_lower
from subledger.functions.timeparse import parse_date, to_utc_ntz, week_start, weekday_mon0

__all__ = [
    "NULL_TOKENS",
    "clean_text",
    "is_null_like",
    "norm_lower",
    "to_number",
    "money",
    "signed_amount",
    "safe_ratio",
    "to_utc_ntz",
    "parse_date",
    "week_start",
    "weekday_mon0",
]
