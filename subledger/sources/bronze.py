"""Bronze ingest: raw files -> string tables, nothing interpreted yet.

* events: NDJSON, one object per line, exact line numbers, bad lines
  quarantined (strict JSON: one object, nothing before or after it)
* subscriptions: JSON array files or NDJSON, all values as text; malformed
  files, lines and elements quarantined with their path
* marketing: CSV with header, all values as text; rows with too many fields
  quarantined

Files of every layout are read by many tasks, whatever their size. Each ``*_outcomes``
gives good and bad rows in one DataFrame, told apart by ``_outcome`` (the name of the
table that a row belongs to), so that one job writes both; ``ingest_*`` gives them as
a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.schemas import EVENT_FIELDS, SUBSCRIPTION_FIELDS
from subledger.sources.lines import numbered_lines
from subledger.sources.records import csv_records, json_array_elements

#: Length of the short form of a quarantined line (fixed value).
HEAD_CHARS = 3000


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _last_key_wins(m: Column) -> Column:
    """Map with duplicate keys collapsed to their last occurrence (the keys are
    compared pairwise only where some key occurs twice)."""
    es = F.map_entries(m)
    keep = F.filter(
        es,
        lambda e, i: ~F.exists(F.slice(es, i + 2, F.greatest(F.size(es), F.lit(1))), lambda x: x["key"] == e["key"]),
    )
    repeated = F.size(F.array_distinct(F.map_keys(m))) < F.size(m)
    return F.when(repeated, F.map_from_entries(keep)).otherwise(m)


def _objects(t: Column) -> Column:
    """Text as an array of objects: one if it is exactly one JSON object."""
    options = {"allowSingleQuotes": "false", "allowUnquotedControlChars": "false"}
    return F.from_json(F.concat(F.lit("["), t, F.lit("]")), "array<map<string,string>>", options)


def _one_object(arr: str) -> Column:
    ok = F.col(arr).isNotNull() & (F.size(arr) == 1) & F.col(arr)[0].isNotNull()
    return F.coalesce(ok, F.lit(False))


def _fields(m: str, names) -> list[Column]:
    """The known fields of a map as columns, every other key in ``extras``."""
    known = F.array(*[F.lit(k) for k in names])
    return [F.col(m)[k].alias(k) for k in names] + [F.map_filter(m, lambda k, v: ~F.array_contains(known, k)).alias("extras")]


#: Column that names the table a row belongs to, and the columns of quarantined rows.
OUTCOME = "_outcome"
BAD_COLUMNS = ("_raw_line", "_raw_head", "_error")


def split_outcomes(df: DataFrame, good: str, bad: str, bad_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of the two tables, each with its own columns."""
    kept = [c for c in df.columns if c != OUTCOME and c not in BAD_COLUMNS]
    return df.where(F.col(OUTCOME) == good).select(*kept), df.where(F.col(OUTCOME) == bad).select(*bad_columns, *BAD_COLUMNS)


def _object_outcomes(texts: DataFrame, names, place: list[str], good: str, bad: str) -> DataFrame:
    """Texts (``_line``) that should each be one JSON object: the known fields as
    columns, every other key in ``extras``; others with their text and an error."""
    tagged = texts.select(*place, "_line", _objects(F.col("_line")).alias("_arr")).withColumn("_ok", _one_object("_arr"))
    fields = tagged.withColumn("_m", F.when(F.col("_ok"), _last_key_wins(F.col("_arr")[0])))
    error = F.when(F.col("_arr").isNull(), F.lit("invalid_json")).otherwise(F.lit("not_one_object"))
    wrong = [F.col("_line").alias("_raw_line"), F.substring("_line", 1, HEAD_CHARS).alias("_raw_head"), error.alias("_error")]
    return fields.select(
        *_fields("_m", names),
        *place,
        *[F.when(~F.col("_ok"), c).alias(n) for n, c in zip(BAD_COLUMNS, wrong, strict=True)],
        F.when(F.col("_ok"), good).otherwise(bad).alias(OUTCOME),
    )


# ---------------------------------------------------------------------- events

EVENTS_GOOD, EVENTS_BAD = "events_raw", "events_bad_rows"
_LINE_PLACE = ["_source_file", "_source_line_no"]


def event_line_outcomes(lines: DataFrame) -> DataFrame:
    """Numbered lines as rows of events_raw and events_bad_rows.

    A line is good when it is exactly one JSON object; scalars, arrays,
    ``null``, trailing text, single quotes, trailing commas and raw control
    characters are bad. Blank lines are skipped (their numbers are kept by
    the others). Known fields become columns, every other key goes to
    ``extras``; nested values are kept as JSON text.
    """
    return _object_outcomes(_stripped(lines), EVENT_FIELDS, _LINE_PLACE, EVENTS_GOOD, EVENTS_BAD)


def _stripped(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_line", _strip(F.col("value"))).where("_line <> ''")


def event_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON file(s) -> rows of events_raw and events_bad_rows."""
    return event_line_outcomes(numbered_lines(spark, path))


def parse_event_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events_raw, events_bad_rows) from numbered lines."""
    return split_outcomes(event_line_outcomes(lines), EVENTS_GOOD, EVENTS_BAD, _LINE_PLACE)


def ingest_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """NDJSON file(s) -> (events_raw, events_bad_rows)."""
    return parse_event_lines(numbered_lines(spark, path))


# --------------------------------------------------------------- subscriptions

SUBSCRIPTIONS_GOOD, SUBSCRIPTIONS_BAD = "subscriptions_raw", "subscriptions_bad_rows"


def subscription_outcomes(spark: SparkSession, path: str, layout: str = "array") -> DataFrame:
    """Subscription files -> rows of subscriptions_raw and subscriptions_bad_rows.

    ``layout`` is "array" (every file one JSON array) or "ndjson" (one object per
    line). Known fields become text columns, other keys go to ``extras``;
    ``_source_row_no`` records input order (the dedup tie-breaker). An element or a
    line that is no object goes to the bad rows with its file, its text and its
    place, and nothing else of the file is lost; a file that does not end as an
    array goes there whole, at place 0, in rows of one split at most.
    """
    if layout == "ndjson":
        lines = _stripped(numbered_lines(spark, path)).withColumn("_source_row_no", F.col("_source_line_no"))
        return _object_outcomes(lines, SUBSCRIPTION_FIELDS, [*_LINE_PLACE, "_source_row_no"], SUBSCRIPTIONS_GOOD, SUBSCRIPTIONS_BAD)
    if layout != "array":
        raise ValueError(f"layout must be 'array' or 'ndjson', not {layout!r}")
    elements, lost = json_array_elements(spark, path)
    place = ["_source_file", "_source_row_no"]
    judged = _object_outcomes(elements, SUBSCRIPTION_FIELDS, place, SUBSCRIPTIONS_GOOD, SUBSCRIPTIONS_BAD)
    broken = [F.col("_line").alias("_raw_line"), F.substring("_line", 1, HEAD_CHARS).alias("_raw_head"), F.lit("invalid_json").alias("_error")]
    return judged.unionByName(lost.select(*place, *broken, F.lit(SUBSCRIPTIONS_BAD).alias(OUTCOME)), allowMissingColumns=True)


def ingest_subscriptions(spark: SparkSession, path: str, layout: str = "array") -> tuple[DataFrame, DataFrame]:
    """Subscription files -> (subscriptions_raw, subscriptions_bad_rows)."""
    place = ["_source_file", "_source_row_no"] if layout == "array" else [*_LINE_PLACE, "_source_row_no"]
    return split_outcomes(subscription_outcomes(spark, path, layout), SUBSCRIPTIONS_GOOD, SUBSCRIPTIONS_BAD, place)


# ------------------------------------------------------------------- marketing

MARKETING_GOOD, MARKETING_BAD = "marketing_spend_raw", "marketing_bad_rows"
_QUOTING = {"escape": '"', "multiLine": "true"}


def marketing_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header -> rows of marketing_spend_raw and marketing_bad_rows.

    Read as text (no type inference), quotes doubled inside quotes, line ends
    allowed there. A row with more fields than the header is quarantined with
    its raw text, a record that the file's end leaves inside quotes too; a short row
    is kept, padded with nulls. All files must have the columns of the first one in
    the same order, else the read fails.
    """
    reader = spark.read.option("header", True).option("recursiveFileLookup", True).options(**_QUOTING)
    header = reader.csv(path).columns
    n = len(header)

    def fields(count: int) -> Column:
        return F.from_csv("_record", ", ".join(f"c{i} string" for i in range(count)), _QUOTING)

    records = csv_records(spark, path).withColumn("_row", fields(n))
    names = F.array(*[F.lit(c) for c in header])
    read = F.array(*[F.col("_row")[f"c{i}"] for i in range(n)])
    differs = F.raise_error(F.concat(F.lit("CSV header of "), "_source_file", F.lit(" differs from: "), F.array_join(names, ",")))
    rows = records.where(F.when(~F.col("_first"), F.lit(True)).when((read == names) & fields(n + 1)[f"c{n}"].isNull(), False).otherwise(differs))
    # Only a text with at least n commas can have too many fields.
    commas = F.char_length("_record") - F.char_length(F.replace("_record", F.lit(","), F.lit("")))
    too_long = F.when(commas >= n, fields(n + 1)[f"c{n}"].isNotNull()).otherwise(F.lit(False))
    judged = rows.withColumn("_bad", F.when(F.col("_open"), F.lit("unclosed_quote")).when(too_long, F.lit("too_many_fields")))
    wrong = [F.col("_record"), F.substring("_record", 1, HEAD_CHARS), F.col("_bad")]
    return judged.select(
        *[F.col("_row")[f"c{i}"].alias(c) for i, c in enumerate(header)],
        *[F.when(F.col("_bad").isNotNull(), c).alias(name) for name, c in zip(BAD_COLUMNS, wrong, strict=True)],
        F.when(F.col("_bad").isNull(), MARKETING_GOOD).otherwise(MARKETING_BAD).alias(OUTCOME),
    )


def ingest_marketing(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """CSV with header -> (marketing_spend_raw, marketing_bad_rows)."""
    both = marketing_outcomes(spark, path)
    fields = [c for c in both.columns if c != OUTCOME and c not in BAD_COLUMNS]
    return split_outcomes(both, MARKETING_GOOD, MARKETING_BAD, fields)
