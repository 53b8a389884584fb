"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.functions import is_null_like, week_start, weekday_mon0
from subledger.operators import conditional_min, union_dates


def dim_date(events: DataFrame, marketing: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Every date seen in events, marketing spend and subscription bounds."""
    # Both ends from one reading.
    bounds = subscriptions.select(F.explode(F.array(*[F.col(c).cast("date") for c in ("start_date", "end_date")])).alias("bound"))
    dates = union_dates(
        [
            (events, F.to_date("event_ts_utc")),
            (marketing, F.col("date")),
            (bounds, F.col("bound")),
        ]
    )
    d = F.col("date")
    return dates.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        weekday_mon0(d).alias("weekday"),
        week_start(d).alias("week_start_monday"),
    )


def dim_channel(marketing: DataFrame) -> DataFrame:
    return marketing.select("channel").distinct()


def dim_plan(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select("plan_id", "price", "currency").distinct()


def dim_user(events: DataFrame) -> DataFrame:
    """(user_id, acquisition_channel): lexically smallest channel over the
    user's raw 'signup' events; raw user ids, null-like ones excluded."""
    users = events.where(~is_null_like("user_id"))
    return conditional_min(users, "user_id", F.col("event_type") == "signup", F.col("acquisition_channel"), "acquisition_channel")
