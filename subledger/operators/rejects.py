"""Reject reasons from an ordered list of (reason, predicate) rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def tag_rejects(df: DataFrame, rules: Sequence[tuple[str, Column]], reason_col: str = REASON) -> DataFrame:
    """Add ``reject_reason``: the first rule whose predicate is true, else null.

    A predicate that evaluates to null counts as false.
    """
    reason = F.coalesce(*[F.when(F.coalesce(pred, F.lit(False)), F.lit(name)) for name, pred in rules])
    return df.withColumn(reason_col, reason)

