"""Silver layer: typed, validated, de-duplicated tables plus their rejects.

Every ``*_outcomes`` gives the rows of the clean table and of its rejects in one
DataFrame, told apart by ``_outcome`` (the name of the table that a row belongs to),
so that one job writes both; ``clean_*`` gives them as a pair ``(good, rejected)``.
Each input row is accounted for exactly once. Where the two tables hold a column in
different types, the rejects' one is stored as ``rejected_<column>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger import schemas
from subledger.functions import clean_text, norm_lower, parse_date, to_number, to_utc_ntz
from subledger.functions.numbers import money
from subledger.operators import calendar_fill, keep_latest, prev_in_ranges, tag_rejects

REASON = "reject_reason"
OUTCOME = "_outcome"
# Fixed value: effective end of an open-ended subscription.
OPEN_END = "2100-01-01"


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: present columns are cast, missing ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def normalize_events(df: DataFrame) -> DataFrame:
    """Add the normalised event type and user id used by every gold metric.

    Materialising them in silver lets gold filters be pushed to the Parquet
    scan (a filter on ``lower(trim(event_type))`` would not be).
    """
    return df.withColumn("event_type_norm", norm_lower("event_type")).withColumn("user_id_norm", clean_text("user_id"))


def rows_of(outcomes: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """The rows of one table of ``*_outcomes``, with the columns of ``schema``."""
    stored = set(outcomes.columns)
    is_reject = REASON in schema.fieldNames()
    names = [f"rejected_{f.name}" if is_reject and f"rejected_{f.name}" in stored else f.name for f in schema.fields]
    return outcomes.where(F.col(OUTCOME) == table).select(*[F.col(n).alias(f.name) for n, f in zip(names, schema.fields, strict=True)])


def _set_apart() -> Column:
    """Null for good rows; a number of its own for every reject, so that rejects
    pass through grouped steps one by one and spread over all tasks."""
    return F.when(F.col(REASON).isNotNull(), F.monotonically_increasing_id())


# ---------------------------------------------------------------- events

EVENTS_GOOD, EVENTS_REJECTED = "events_clean", "events_rejected_silver"
EVENT_REASONS = ("missing_event_id", "bad_timestamp")


def event_outcomes(bronze: DataFrame) -> DataFrame:
    """Bronze events -> rows of events_clean and events_rejected_silver.

    Rejects: null/blank/null-like event id, unparseable timestamp. Survivors are
    de-duplicated on event id: latest timestamp wins, then the later source
    line.
    """
    base = ensure_columns(bronze, schemas.BRONZE_EVENTS)
    typed = normalize_events(
        base.withColumn("event_ts_utc", to_utc_ntz("timestamp")).withColumn("amount_num", to_number("amount"))
    )
    rules = [clean_text("event_id").isNull(), F.col("event_ts_utc").isNull()]
    tagged = tag_rejects(typed, list(zip(EVENT_REASONS, rules, strict=True)))
    good = F.col(REASON).isNull()
    keyed = tagged.withColumns(
        {
            "_apart": _set_apart(),
            "_id": F.when(good, clean_text("event_id")),
            "_line": F.coalesce("_source_line_no", F.lit(0).cast("bigint")),
        }
    )
    kept = keep_latest(keyed, ["_id", "_apart"], [F.desc("event_ts_utc"), F.desc_nulls_last("_source_file"), F.desc("_line")])
    final = kept.withColumns(
        {"event_id": F.when(good, F.col("_id")).otherwise(F.col("event_id")), "_source_line_no": F.when(good, F.col("_line")).otherwise(F.col("_source_line_no"))}
    )
    cols = [f.name for f in schemas.EVENTS_CLEAN.fields]
    return final.select(*cols, REASON, F.when(good, EVENTS_GOOD).otherwise(EVENTS_REJECTED).alias(OUTCOME))


def clean_events(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze events -> (events_clean, events_rejected)."""
    both = event_outcomes(bronze)
    return rows_of(both, EVENTS_GOOD, schemas.EVENTS_CLEAN), rows_of(both, EVENTS_REJECTED, schemas.EVENTS_REJECTED)


# ------------------------------------------------------------- marketing


MARKETING_GOOD, MARKETING_REJECTED = "marketing_spend_clean", "marketing_spend_rejected_silver"
MARKETING_REASONS = ("bad_date", "bad_spend", "negative_spend")


def marketing_outcomes(bronze: DataFrame) -> DataFrame:
    """Bronze marketing spend -> rows of the dense daily spend per channel and of the
    rejects.

    Rejects: unparseable date, non-numeric spend, negative spend. Good rows are
    summed per (day, channel) and every channel gets a row for every day
    between the first and last good day (0.0 when nothing was spent).
    """
    base = ensure_columns(bronze, schemas.BRONZE_MARKETING)
    typed = base.select(
        parse_date("date").alias("date"),
        F.coalesce(clean_text("channel"), F.lit("Unknown")).alias("channel"),
        F.col("spend"),
        to_number("spend").alias("spend_num"),
    )
    rules = [F.col("date").isNull(), F.col("spend_num").isNull(), F.col("spend_num") < 0]
    tagged = tag_rejects(typed, list(zip(MARKETING_REASONS, rules, strict=True)))
    good = tagged.where(F.col(REASON).isNull()).select("date", "channel", money("spend_num").alias("spend"))
    dense = calendar_fill(good, "date", ["channel"], "spend", 0, agg="sum")
    clean = dense.select("date", "channel", F.col("spend").cast("double").alias("spend"), F.lit(MARKETING_GOOD).alias(OUTCOME))
    rejected = tagged.where(F.col(REASON).isNotNull()).select(
        "date", "channel", F.col("spend").alias("rejected_spend"), "spend_num", REASON, F.lit(MARKETING_REJECTED).alias(OUTCOME)
    )
    return clean.unionByName(rejected, allowMissingColumns=True)


def clean_marketing(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze marketing spend -> (dense daily spend per channel, rejected rows)."""
    both = marketing_outcomes(bronze)
    return rows_of(both, MARKETING_GOOD, schemas.MARKETING_CLEAN), rows_of(both, MARKETING_REJECTED, schemas.MARKETING_REJECTED)


# --------------------------------------------------------- subscriptions


def _ntz_micros(c: str) -> Column:
    """Microseconds since epoch of a timestamp_ntz (zone independent)."""
    return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), F.col(c))


def flag_overlaps(
    df: DataFrame,
    entity: str = "user_id",
    start: str = "start_date",
    end: str = "end_date",
    created: str = "created_at_ts",
    tie: str = "subscription_id",
    apart: str | None = None,
) -> DataFrame:
    """Compare every interval with the entity's immediately previous one.

    Order: start asc, created desc, tie asc. Adds ``prev_end_eff`` (previous
    effective end, open end = 2100-01-01), ``gap_days`` (days strictly between
    previous end and this start), ``is_overlap`` (start <= previous end) and
    ``reactivated`` (gap > 0). Only the immediate predecessor is compared, even
    if it is itself an overlap. Rows that differ in the column ``apart`` are never
    compared.
    """
    withend = df.withColumn("_end_eff", F.coalesce(F.col(end), F.lit(OPEN_END).cast("date")))
    order = [F.col(start), -_ntz_micros(created), F.col(tie)]
    lagged = prev_in_ranges(withend, [entity, *([apart] if apart else [])], order, ["_end_eff"], prefix="_prev")
    return (
        lagged.withColumnRenamed("_prev_end_eff", "prev_end_eff")
        .drop("_end_eff")
        .withColumn("gap_days", (F.datediff(F.col(start), F.col("prev_end_eff")) - 1).cast("int"))
        .withColumn("is_overlap", F.coalesce(F.col(start) <= F.col("prev_end_eff"), F.lit(False)))
        .withColumn("reactivated", F.coalesce(F.col("gap_days") > 0, F.lit(False)))
    )


SUBSCRIPTIONS_GOOD, SUBSCRIPTIONS_REJECTED = "subscriptions_clean", "subscriptions_rejected_silver"
SUBSCRIPTION_REASONS = ("missing_subscription_id", "missing_user_id", "bad_price", "bad_start_date", "bad_created_at")
OVERLAP = "overlap"


def subscription_outcomes(bronze: DataFrame) -> DataFrame:
    """Bronze subscriptions -> rows of subscriptions_clean and of the rejects.

    Rejects: missing subscription/user id, unparseable price, start date or
    created_at. Survivors keep the latest version per subscription id
    (created_at desc, then source order), then rows that overlap the user's
    previous subscription are moved to the rejects.
    """
    schema = T.StructType(list(schemas.BRONZE_SUBSCRIPTIONS.fields) + [T.StructField("_source_row_no", T.LongType())])
    if "_source_row_no" not in bronze.columns:
        bronze = bronze.withColumn("_source_row_no", F.lit(0).cast("bigint"))
    base = ensure_columns(bronze, schema)
    typed = base.select(
        clean_text("subscription_id").alias("subscription_id"),
        clean_text("user_id").alias("user_id"),
        clean_text("plan_id").alias("plan_id"),
        to_number("price").alias("price"),
        clean_text("currency").alias("currency"),
        F.col("start_date").alias("rejected_start_date"),
        F.col("end_date").alias("rejected_end_date"),
        norm_lower("status").alias("status"),
        F.col("created_at"),
        to_utc_ntz("created_at").alias("created_at_ts"),
        parse_date("start_date").alias("start_date"),
        parse_date("end_date").alias("end_date"),
        F.col("_source_row_no"),
    )
    rules = [F.col(c).isNull() for c in ("subscription_id", "user_id", "price", "start_date", "created_at_ts")]
    tagged = tag_rejects(typed, list(zip(SUBSCRIPTION_REASONS, rules, strict=True))).withColumn("_apart", _set_apart())
    latest = keep_latest(tagged, ["subscription_id", "_apart"], [F.desc("created_at_ts"), F.asc("_source_row_no")])
    flagged = flag_overlaps(latest, apart="_apart")
    by_rule = F.col(REASON).isNotNull()
    reason = F.when(by_rule, F.col(REASON)).when(F.col("is_overlap"), OVERLAP)
    # Rejects of a rule keep the dates as they came, overlaps as they were read.
    text = {f"rejected_{c}": F.when(by_rule, F.col(f"rejected_{c}")).when(F.col("is_overlap"), F.col(c).cast("string")) for c in ("start_date", "end_date")}
    compared = {c: F.when(~by_rule, F.col(c)) for c in ("gap_days", "reactivated")}
    final = flagged.withColumns({**text, **compared, REASON: reason})
    cols = [f.name for f in schemas.SUBSCRIPTIONS_CLEAN.fields]
    outcome = F.when(F.col(REASON).isNull(), SUBSCRIPTIONS_GOOD).otherwise(SUBSCRIPTIONS_REJECTED)
    return final.select(*cols, *text, REASON, outcome.alias(OUTCOME))


def clean_subscriptions(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bronze subscriptions -> (subscriptions_clean, subscriptions_rejected)."""
    both = subscription_outcomes(bronze)
    return rows_of(both, SUBSCRIPTIONS_GOOD, schemas.SUBSCRIPTIONS_CLEAN), rows_of(both, SUBSCRIPTIONS_REJECTED, schemas.SUBSCRIPTIONS_REJECTED)


def flag_counts(clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row: overlaps among the rejected, reactivations among the clean."""
    zero = F.lit(0).cast("bigint")
    each = rejected.select((F.col(REASON) == "overlap").cast("bigint").alias("o"), zero.alias("r")).unionByName(
        clean.select(zero.alias("o"), F.col("reactivated").cast("bigint").alias("r"))
    )
    return each.agg(F.coalesce(F.sum("o"), zero).alias("overlaps"), F.coalesce(F.sum("r"), zero).alias("reactivated"))
