"""Numeric coercion and money arithmetic.

Money is summed as ``DECIMAL(38,6)`` and only cast to double at the end, so
results do not depend on the order in which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.functions.text import trimmed

MONEY = "decimal(38,6)"

# A plain decimal literal: optional sign, digits with an optional fraction,
# optional exponent. Excludes NaN/Infinity and Java's 'd'/'f' suffixes, which a
# bare cast would accept.
_NOT_NUMBER = r"^(?![+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$).*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: str | Column) -> Column:
    """String -> double; anything that is not a plain number becomes null."""
    return F.regexp_replace(trimmed(c), _NOT_NUMBER, "").try_cast("double")


def money(c: str | Column) -> Column:
    """Exact money value (decimal) of a numeric column."""
    return _col(c).try_cast(MONEY)


def signed_amount(event_type: str | Column, amount: str | Column) -> Column:
    """Purchase counts +amount, anything else (refund) -|amount|; null -> 0."""
    a = F.coalesce(money(amount), F.lit(0).cast(MONEY))
    return F.when(_col(event_type) == "purchase", a).otherwise(-F.abs(a))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, null when den is null or zero."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
