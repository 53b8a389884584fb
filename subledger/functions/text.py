"""Text normalisation (trim, lower, null-like tokens)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The textual stand-ins for "no value" that upstream systems and
# string casts produce. Compared after trimming and lower-casing.
NULL_TOKENS = ("", "none", "nan", "<na>")

# Characters removed at both ends: space, tab, carriage return, newline.
_TRIM_CHARS = " \t\r\n"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    return F.btrim(_col(c).cast("string"), F.lit(_TRIM_CHARS))


def is_null_like(c: str | Column) -> Column:
    """True when the value is null or one of the null-like tokens."""
    t = F.lower(trimmed(c))
    return t.isNull() | t.isin(*NULL_TOKENS)


def clean_text(c: str | Column) -> Column:
    """Trimmed text, or null when the value is null-like."""
    t = trimmed(c)
    return F.when(~F.lower(t).isin(*NULL_TOKENS), t)


def norm_lower(c: str | Column) -> Column:
    """Trimmed, lower-cased text; null-like values become null."""
    return F.lower(clean_text(c))
