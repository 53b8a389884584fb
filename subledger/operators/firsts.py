"""Arg-min style per-key picks; all plan as partial + final aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_value_by(df: DataFrame, key: str | Sequence[str], value: Column, order: Sequence[Column], alias: str) -> DataFrame:
    """Per key, ``value`` of the row with the smallest ``order`` tuple."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias(alias))


def conditional_min(df: DataFrame, key: str | Sequence[str], cond: Column, value: Column, alias: str) -> DataFrame:
    """Per key, ``MIN(CASE WHEN cond THEN value END)``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.min(F.when(cond, value)).alias(alias))
