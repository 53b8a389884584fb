"""Calendar operators: dense (day x key) grids, date unions.

Grids are built without a join: each distinct key row explodes the list of
days, which comes in as one scalar subquery, and the grid is merged with the
data by ``union`` + ``groupBy``. Days and keys are taken from the table already
aggregated by (day, keys). All three readers of that table use all its columns,
so the planner shuffles it once and reuses the exchange: one scan of the input.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_fill(
    df: DataFrame,
    date_col: str,
    key_cols: Sequence[str],
    value_col: str,
    fill,
    agg: str = "sum",
) -> DataFrame:
    """Dense table over [min(date), max(date)] x distinct keys.

    ``agg="sum"`` aggregates raw rows per (date, keys) and fills empty cells;
    ``agg="max"`` expects at most one row per cell and only fills the gaps.
    """
    vtype = df.schema[value_col].dataType
    aggf = F.sum if agg == "sum" else F.max
    cells = df.groupBy(date_col, *key_cols).agg(aggf(value_col).cast(vtype).alias(value_col))
    whole = F.struct(date_col, *key_cols, value_col)
    dated = F.when(F.col(date_col).isNotNull(), whole)
    # One scalar subquery: the list of days (bounded by the calendar span).
    days = cells.agg(F.sequence(F.min(dated)[date_col], F.max(dated)[date_col]).alias("days"))
    grid = cells.groupBy(*key_cols).agg(F.max(dated).alias("_any")).where(F.col("_any").isNotNull())
    grid = grid.select(*key_cols, F.explode(days.scalar()).alias(date_col), F.lit(None).cast(vtype).alias(value_col))
    both = cells.select(date_col, *key_cols, value_col).unionByName(grid)
    return both.groupBy(date_col, *key_cols).agg(F.coalesce(F.max(value_col), F.lit(fill).cast(vtype)).cast(vtype).alias(value_col))


def union_dates(frames: Sequence[tuple[DataFrame, Column]], out: str = "date") -> DataFrame:
    """Distinct non-null dates drawn from several (frame, expression) pairs.

    One shuffle: the union is de-duplicated by a single aggregation whose
    partial step runs inside every scan task.
    """
    parts = [df.select(c.cast("date").alias(out)) for df, c in frames]
    return reduce(DataFrame.unionByName, parts).where(F.col(out).isNotNull()).distinct()
