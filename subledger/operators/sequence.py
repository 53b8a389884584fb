"""The previous row of a group, without holding a group in one task.

``Window.partitionBy(group)`` sends a whole group to one task, so one user with
a third of all rows would stall the job. Here the group is cut by a bucket, a
monotone function of the first order expression (by default that expression
itself, say the start date). ``lag`` runs inside (group, bucket); one summary
row per (group, bucket), its last row, is put in front of the group's next
bucket and serves that bucket's first row. The summaries are ordered per group,
at most one row per group and bucket. One plan at every size, no job while the
query is built, nothing written.

``prev_in_ranges`` also splits a bucket that piles up, say one user's rows of one
day: all rows are dealt out by ranges of the whole key (group, order), sampled by
Spark, so that every range has its share wherever the rows lie, and the range is the
bucket. The ranges are written once, since a range must be the same rows for both of
its readers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.session import written

_BUCKET, _KEY, _VALUES, _ROW, _PREV, _MORE = "_seq_bucket", "_seq_key", "_seq_values", "_seq_row", "_seq_prev", "_seq_more"
_RANGE_KEY, _RANGE = "_seq_range_key", "_seq_range"


def prev_in_order(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[Column],
    value_cols: Sequence[str],
    prefix: str = "prev_",
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``prefix + v`` for each value column: its value on the immediately
    previous row of the same group under ``order`` (ascending expressions; make
    them total with a unique tie-breaker), null on a group's first row.

    Equal to ``lag(v) OVER (PARTITION BY group ORDER BY order)``. ``bucket`` must
    never decrease along the order.
    """
    cols, groups = df.columns, list(group_cols)
    rows = df.select(
        "*",
        (order[0] if bucket is None else bucket).alias(_BUCKET),
        F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias(_KEY),
        F.struct(*[F.col(v).alias(v) for v in value_cols]).alias(_VALUES),
        F.lit(True).alias(_ROW),
    )
    along = Window.partitionBy(*groups).orderBy(_BUCKET)
    tails = rows.groupBy(*groups, _BUCKET).agg(F.max_by(_VALUES, _KEY).alias(_VALUES))
    seams = (
        tails.select(*groups, _VALUES, F.lead(_BUCKET).over(along).alias(_BUCKET), F.lead(F.lit(True)).over(along).alias(_MORE))
        .where(_MORE)
        .drop(_MORE)
        .withColumn(_ROW, F.lit(False))
    )
    inside = Window.partitionBy(*groups, _BUCKET).orderBy(_ROW, _KEY)
    joined = rows.unionByName(seams, allowMissingColumns=True).withColumn(_PREV, F.lag(_VALUES).over(inside)).where(_ROW)
    return joined.select(*cols, *[F.col(_PREV)[v].alias(prefix + v) for v in value_cols])


def prev_in_ranges(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column], value_cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """``prev_in_order`` with a bucket that is the row's range of (group, order), for
    inputs where neither a group nor a value of the first order expression has a
    bound. Runs one job, which writes the ranges to the scratch folder."""
    key = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    ranged = df.withColumn(_RANGE_KEY, key).repartitionByRange(*group_cols, _RANGE_KEY)
    stored = written(ranged.withColumn(_RANGE, F.spark_partition_id()), "ranges")
    found = prev_in_order(stored, group_cols, [F.col(_RANGE_KEY)], value_cols, prefix, bucket=F.col(_RANGE))
    return found.drop(_RANGE_KEY, _RANGE)
