"""Pipeline inputs derived from the shared test tables.

The driver tables are a generic star schema (``events``, ``orders`` ...). These
adapters re-shape them into the pipeline's inputs with plain column
expressions, so every product runs over whole tables and its work grows with
them:

* ``silver_events``        typed events (as the silver layer would emit them)
* ``bronze_events_dirty``  string events with bad timestamps, blank ids,
                           older and same-time duplicates, unparseable amounts
* ``bronze_subscriptions`` subscriptions from orders, with superseded versions
                           and rows without a user
* ``bronze_marketing``     spend rows from orders, mixed date layouts, padded
                           channel names and negative spend
* ``every_*``              the same with every reject rule, date layout and null-like
                           token planted
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.plans.silver import normalize_events


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# How the generic event types stand in for the pipeline's ones.
EVENT_TYPE_MAP = {"view": "page_view", "click": "login", "error": "refund"}


def mapped_event_type() -> Column:
    c = F.col("event_type")
    expr = c
    for src, dst in reversed(list(EVENT_TYPE_MAP.items())):
        expr = F.when(c == src, F.lit(dst)).otherwise(expr)
    return expr


def signup_channel() -> Column:
    """'ch0'..'ch4' from the digits in ``props`` on signup events, else null."""
    k = F.regexp_extract("props", "([0-9]+)", 1).try_cast("int")
    return F.when(F.col("event_type") == "signup", F.concat(F.lit("ch"), (k % 5).cast("string")))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed events with the silver columns the gold metrics read."""
    ev = table(spark, sf_dir, "events")
    typed = ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        mapped_event_type().alias("event_type"),
        F.col("ts").cast("string").alias("timestamp"),
        F.col("value").cast("string").alias("amount"),
        signup_channel().alias("acquisition_channel"),
        F.col("ts").alias("event_ts_utc"),
        F.col("value").alias("amount_num"),
    )
    return normalize_events(typed)


def _ts_text(ts: Column) -> Column:
    """Zone-free text of a timestamp_ntz ('yyyy-MM-dd HH:mm:ss[.ffffff]')."""
    return ts.cast("string")


def bronze_events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String events with known defects (see module doc); ``_source_line_no``
    is id*3+1 for the original, +2 / +3 for the copies, id*3+1e6 for blanks."""
    ev = table(spark, sf_dir, "events")
    i, ts = F.col("event_id"), F.col("ts")
    common = [
        F.col("user_id").cast("string").alias("user_id"),
        mapped_event_type().alias("event_type"),
        signup_channel().alias("acquisition_channel"),
    ]
    iso_t = F.concat(F.regexp_replace(_ts_text(ts), " ", "T"), F.lit("Z"))
    base_ts = (
        F.when(i % 17 == 0, F.lit("not-a-date"))
        .when(i % 7 == 0, F.concat(_ts_text(ts + F.expr("INTERVAL 2 HOURS")), F.lit("+02:00")))
        .when(i % 2 == 0, iso_t)
        .otherwise(_ts_text(ts))
    )
    base = ev.select(
        i.cast("string").alias("event_id"),
        *common,
        base_ts.alias("timestamp"),
        F.when(i % 13 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("amount"),
        (i * 3 + 1).alias("_source_line_no"),
    )
    older = ev.where(i % 10 == 0).select(
        i.cast("string").alias("event_id"),
        *common,
        F.concat(F.regexp_replace(_ts_text(ts - F.expr("INTERVAL 1 HOUR")), " ", "T"), F.lit("Z")).alias("timestamp"),
        (F.col("value") + 1000).cast("string").alias("amount"),
        (i * 3 + 2).alias("_source_line_no"),
    )
    same = ev.where(i % 15 == 0).select(
        i.cast("string").alias("event_id"),
        *common,
        iso_t.alias("timestamp"),
        (F.col("value") + 2000).cast("string").alias("amount"),
        (i * 3 + 3).alias("_source_line_no"),
    )
    blank = ev.where(i % 101 == 0).select(
        F.lit("  ").alias("event_id"),
        *common,
        F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
        F.lit("1").alias("amount"),
        (i * 3 + 1000000).alias("_source_line_no"),
    )
    return base.unionByName(older).unionByName(same).unionByName(blank)


def _order_date() -> Column:
    return F.col("o_orderdate").cast("date")


def _subscription_end() -> Column:
    k = F.col("o_orderkey")
    return F.when(k % 50 != 0, F.date_add(_order_date(), (k % 365).cast("int")))


def bronze_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscriptions from orders (one per order, price = total price, start =
    order date, end = start + key mod 365 days, open for every 50th key).

    Extra rows: every 40th key also has an older version (created a day
    earlier, price + 1) that must lose; every 97th key has a copy under id
    'x<key>' without a user that must be rejected. Every 11th start date is
    written as 'yyyy/MM/dd'.
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    start_txt = _order_date().cast("string")
    start_out = F.when(k % 11 == 0, F.regexp_replace(start_txt, "-", "/")).otherwise(start_txt)
    price = F.col("o_totalprice").cast("decimal(12,2)")
    status = F.when(F.col("o_orderstatus") == "O", "active").when(F.col("o_orderstatus") == "F", "cancelled").otherwise("paused")

    def rows(frame: DataFrame, sid: Column, uid: Column, price_txt: Column, created: Column, row_no: Column) -> DataFrame:
        return frame.select(
            sid.alias("subscription_id"),
            uid.alias("user_id"),
            F.col("o_orderpriority").alias("plan_id"),
            price_txt.alias("price"),
            F.lit("USD").alias("currency"),
            start_out.alias("start_date"),
            _subscription_end().cast("string").alias("end_date"),
            status.alias("status"),
            created.alias("created_at"),
            row_no.alias("_source_row_no"),
        )

    created = F.concat(start_txt, F.lit("T00:00:00Z"))
    base = rows(o, k.cast("string"), F.col("o_custkey").cast("string"), price.cast("string"), created, k * 3)
    older = rows(
        o.where(k % 40 == 0),
        k.cast("string"),
        F.col("o_custkey").cast("string"),
        (price + 1).cast("string"),
        F.concat(F.date_sub(_order_date(), 1).cast("string"), F.lit("T12:00:00Z")),
        k * 3 + 1,
    )
    no_user = rows(
        o.where(k % 97 == 0),
        F.concat(F.lit("x"), k.cast("string")),
        F.lit("  "),
        price.cast("string"),
        created,
        k * 3 + 2,
    )
    return base.unionByName(older).unionByName(no_user)


def bronze_marketing(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    """Spend rows from orders: date = order date (every 11th as 'yyyy/MM/dd'),
    channel = 'ch' + key mod 5 (every 7th padded with spaces),
    spend = (total price - 5000) / 1000 (negative ones must be rejected)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    d = _order_date().cast("string")
    ch = F.concat(F.lit("ch"), (k % 5).cast("string"))
    spend = ((F.col("o_totalprice") - 5000) / 1000).cast("decimal(18,5)")
    return o.select(
        F.when(k % 11 == 0, F.regexp_replace(d, "-", "/")).otherwise(d).alias("date"),
        F.when(k % 7 == 0, F.concat(F.lit(" "), ch, F.lit(" "))).otherwise(ch).alias("channel"),
        spend.cast("string").alias("spend"),
        *([k.alias("_k")] if keep_key else []),
    )


# ------------------------------------------------------- every rule, every layout

# The accepted layouts of a date, as date patterns.
DATE_LAYOUTS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "MM-dd-yyyy", "d MMM yyyy", "MMM d, yyyy", "EEE, dd MMM yyyy", "MMMM d yyyy")
# The accepted layouts of a time of day, as date patterns, with the text
# that says how far its zone is ahead of UTC, in minutes.
TIME_LAYOUTS = (
    ("'T'HH:mm:ss", "Z", 0),
    (" HH:mm:ss.SSSSSS", "", 0),
    (" HH:mm:ss", " UTC", 0),
    ("'T'HH:mm:ss", "+05:30", 330),
    (" HH:mm:ss", "-0330", -210),
    (" HH:mm:ss", "+02", 120),
    (" hh:mm:ss a", "", 0),
    (" HH:mm:ss", " PST", -480),
)
NULL_LIKE = ("", "  ", "NaN", "None", "<NA>")


def date_text(day: Column, pick: Column) -> Column:
    """A date in the layout of that number."""
    out = F.date_format(day, DATE_LAYOUTS[0])
    for n, layout in enumerate(DATE_LAYOUTS[1:], 1):
        out = F.when(pick == n, F.date_format(day, layout)).otherwise(out)
    return out


def time_text(ts: Column, day_pick: Column, time_pick: Column) -> Column:
    """A UTC time in the date layout and the time layout of those numbers."""
    out = None
    for n, (layout, zone, ahead) in enumerate(TIME_LAYOUTS):
        local = ts + F.expr(f"INTERVAL {ahead} MINUTES")
        text = F.concat(date_text(local, day_pick), F.date_format(local, layout), F.lit(zone))
        out = text if out is None else F.when(time_pick == n, text).otherwise(out)
    return out


def null_like(pick: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in NULL_LIKE]), pick % len(NULL_LIKE))


def every_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One subscription per order, the start in the date layout of key mod 8; by key
    mod 29: 1 no subscription id, 2 no user, 3 a price that is no number, 4 a start
    without a year, 5 a creation time of text, 6 no creation time and no user."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    r = k % 29
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    return o.select(
        F.when(r == 1, null_like(k)).otherwise(k.cast("string")).alias("subscription_id"),
        F.when(r.isin(2, 6), null_like(k)).otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit("\t"))).alias("user_id"),
        F.col("o_orderpriority").alias("plan_id"),
        F.when(r == 3, F.concat(price, F.lit("d"))).otherwise(price).alias("price"),
        F.when(r == 4, F.date_format(_order_date(), "MM-dd")).otherwise(date_text(_order_date(), k % 8)).alias("start_date"),
        F.when(r == 5, "yesterday").when(r == 6, F.lit(None)).otherwise(F.concat(_order_date().cast("string"), F.lit(" 08:15"))).alias("created_at"),
    )


def every_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One spend row per order, the date in the layout of key mod 8; by key mod 23:
    1 a day that no month has, 2 text for spend, 3 a negative spend, 4 both a bad date
    and bad spend, 5 a channel that is null-like."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    r = k % 23
    return o.select(
        F.when(r.isin(1, 4), F.lit("2024-02-31")).otherwise(date_text(_order_date(), k % 8)).alias("date"),
        F.when(r == 5, null_like(k)).otherwise(F.concat(F.lit("ch"), (k % 5).cast("string"))).alias("channel"),
        F.when(r.isin(2, 4), "1,200").when(r == 3, F.concat(F.lit("-"), k.cast("string"))).otherwise(k.cast("string")).alias("spend"),
    )


def every_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's time to the second as text, once in a date layout (id mod 8) with
    a time layout (id div 8 mod 8), once as a date alone; by id mod 31, 1 and 2 carry
    what is no full date."""
    ev = table(spark, sf_dir, "events")
    i, ts = F.col("event_id"), F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
    bad = F.when(i % 31 == 1, "10:00").when(i % 31 == 2, F.concat(ts.cast("string"), F.lit(" or so")))
    return ev.select(
        "event_id",
        F.coalesce(bad, time_text(ts, i % 8, F.floor(i / 8) % 8)).alias("stamp"),
        F.coalesce(bad, date_text(ts, i % 8)).alias("day"),
    )
