"""Keep-latest deduplication (last write wins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys``: the first row under ``order`` (e.g. newest first).

    ``row_number() = 1`` lets Spark plan a partial ``WindowGroupLimit`` before
    the shuffle, so each map task forwards at most one row per key: a key that
    holds a large share of the rows is cut down before it reaches one task.
    ``order`` should be total (end with a unique tie-breaker) for determinism.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
