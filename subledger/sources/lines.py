"""Text files as (file, line number, text) with exact 1-based line numbers.

A text scan gives no line numbers, and a large file is read as several splits
by different tasks. Each row gets ``monotonically_increasing_id()`` straight
off the scan (consecutive inside a split); a first scan counts the lines of each
split, and a running sum over the splits of each file gives every split's first
line number. That table (one row per split) is written once in the scratch folder,
so the planner knows its true size: it is broadcast wherever it is small, and the
second scan, which yields the rows, has no shuffle. Blank lines keep their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.session import written


def scanned(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """(value, _source_file, _block, _mid) for every piece of the text file(s) at
    ``path`` between separators (line ends unless another is named); _block is the
    first byte of the piece's split, _mid orders the pieces inside a split."""
    reader = spark.read.option("recursiveFileLookup", True)
    if separator is not None:
        reader = reader.option("lineSep", separator)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_mid"),
    )


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(_source_file, _source_line_no, value) for every line of the text
    file(s) at ``path``; numbering restarts in every file."""
    lines = scanned(spark, path)
    per_file = Window.partitionBy("_source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("_source_file", "_block")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
        .select(
            "_source_file",
            "_block",
            (F.coalesce(F.sum("_n").over(per_file), F.lit(0)) - F.col("_first") + 1).alias("_offset"),
        )
    )
    return lines.join(written(splits, "line-splits"), ["_source_file", "_block"]).select(
        "_source_file", (F.col("_mid") + F.col("_offset")).alias("_source_line_no"), "value"
    )
