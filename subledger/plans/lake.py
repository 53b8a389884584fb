"""Files of a lake: good and rejected rows of a step written by one job, tables in
published order, and readers for both.

A step that tells rows apart writes them with one job, partitioned by ``_outcome``:
``<folder>/_outcome=<table>`` is the table. An observation on the write counts the
rows of each table and whatever else is asked for; nothing is read again to count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from subledger.session import written

OUTCOME = "_outcome"
POSITION = "position"

# Folder of every table that a step writes beside another one.
FOLDERS = {
    "events_raw": "bronze/events",
    "events_bad_rows": "bronze/events",
    "subscriptions_raw": "bronze/subscriptions",
    "subscriptions_bad_rows": "bronze/subscriptions",
    "marketing_spend_raw": "bronze/marketing",
    "marketing_bad_rows": "bronze/marketing",
    "events_clean": "silver/events",
    "events_rejected_silver": "silver/events",
    "subscriptions_clean": "silver/subscriptions",
    "subscriptions_rejected_silver": "silver/subscriptions",
    "marketing_spend_clean": "silver/marketing",
    "marketing_spend_rejected_silver": "silver/marketing",
}


def table_path(root: str, table: str) -> str:
    """Folder of a bronze or silver table, quarantined or not, in the lake ``root``."""
    return f"{root.rstrip('/')}/{FOLDERS[table]}/{OUTCOME}={table}"


def read_outcome(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The stored rows of a bronze or silver table, all columns of its step."""
    return spark.read.parquet(table_path(root, table)).withColumn(OUTCOME, F.lit(table))


def observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with named long metrics to be collected by the job that writes it."""
    obs = Observation()
    return df.observe(obs, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in metrics.items()]), obs


def write_outcomes(df: DataFrame, folder: str, tables: Sequence[str], metrics: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Overwrite ``folder`` with the rows of all ``tables``, in one job; their row
    counts and the metrics. A table without rows is written too, as an empty file."""
    counts = {t: F.count_if(F.col(OUTCOME) == t) for t in tables}
    counted, obs = observed(df, {**counts, **(metrics or {})})
    counted.write.mode("overwrite").partitionBy(OUTCOME).parquet(folder)
    found = {k: int(v) for k, v in obs.get.items()}
    for t in tables:
        if not found[t]:
            df.drop(OUTCOME).limit(0).write.mode("overwrite").parquet(f"{folder}/{OUTCOME}={t}")
    return found


def write_counted(df: DataFrame, path: str, metrics: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Overwrite ``path`` with ``df``; the rows written ("rows") and the metrics."""
    counted, obs = observed(df, {"rows": F.count(F.lit(1)), **(metrics or {})})
    counted.write.mode("overwrite").parquet(path)
    return {k: int(v) for k, v in obs.get.items()}


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """A table written in published order with ``position`` (from 1): a row's place
    in its file behind the rows of the files before it. Nothing is sorted: only the
    number of rows of each file is summed up, over one row per file."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    task, part = (F.regexp_extract("_file", p, 1).try_cast("int") for p in (r"part-([0-9]+)", r"-c([0-9]+)"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).withColumns({"_task": task, "_part": F.coalesce(part, F.lit(0))})
    before = Window.orderBy("_task", "_part", "_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "file-bases")
    placed = rows.join(bases, "_file").withColumn(POSITION, F.col("_base") + F.col("_index") + 1)
    return placed.drop("_file", "_index", "_base")
