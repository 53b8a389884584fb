"""Gold facts computed from silver tables.

Input contract: ``events`` has the silver columns ``event_type_norm``,
``user_id_norm``, ``event_ts_utc``, ``amount_num``, ``acquisition_channel`` and
``event_id``; ``marketing`` is (date, channel, spend); ``subscriptions`` is the
clean subscription table. Every aggregation plans as partial + final, so a hot
key is collapsed inside the map tasks before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions import clean_text, safe_ratio, signed_amount, week_start
from subledger.functions.numbers import MONEY, money
from subledger.operators import first_value_by, interval_sum_daily

# Event types that make a user "active".
DAU_ACTIVE_TYPES = ("login", "page_view", "purchase")
RETENTION_ACTIVE_TYPES = ("login", "page_view", "purchase", "trial_start", "trial_convert")
UNKNOWN_CHANNEL = "Unknown"



def _valid_users(events: DataFrame) -> DataFrame:
    return events.where(F.col("user_id_norm").isNotNull())


def daily_active_users(events: DataFrame, active_types: Sequence[str] = DAU_ACTIVE_TYPES) -> DataFrame:
    """(event_date, daily_active_users): exact distinct valid users per day."""
    return (
        _valid_users(events)
        .where(F.col("event_type_norm").isin(*active_types))
        .groupBy(F.to_date(F.col("event_ts_utc")).alias("event_date"))
        .agg(F.count_distinct(F.col("user_id_norm")).alias("daily_active_users"))
    )


def daily_revenue_gross(events: DataFrame) -> DataFrame:
    """(event_date, revenue_gross): purchase amounts per day, any user."""
    return (
        events.where(F.col("event_type_norm") == "purchase")
        .groupBy(F.to_date(F.col("event_ts_utc")).alias("event_date"))
        .agg(F.sum(F.coalesce(money("amount_num"), F.lit(0).cast(MONEY))).cast("double").alias("revenue_gross"))
    )


def daily_revenue_net(events: DataFrame) -> DataFrame:
    """(event_date, revenue_net): purchases minus |refunds| per day, any user."""
    return (
        events.where(F.col("event_type_norm").isin("purchase", "refund"))
        .groupBy(F.to_date(F.col("event_ts_utc")).alias("event_date"))
        .agg(F.sum(signed_amount(F.col("event_type_norm"), "amount_num")).cast("double").alias("revenue_net"))
    )


def ltv_per_user(events: DataFrame) -> DataFrame:
    """(user_id, ltv): purchases minus |refunds| per valid user."""
    return (
        _valid_users(events)
        .where(F.col("event_type_norm").isin("purchase", "refund"))
        .groupBy(F.col("user_id_norm").alias("user_id"))
        .agg(F.sum(signed_amount(F.col("event_type_norm"), "amount_num")).cast("double").alias("ltv"))
    )


# The facts that one scan of the events yields, with their columns.
EVENT_FACTS = {
    "fact_daily_active_users": ("event_date", "daily_active_users"),
    "fact_daily_revenue_gross": ("event_date", "revenue_gross"),
    "fact_daily_revenue_net": ("event_date", "revenue_net"),
    "fact_ltv_per_user": ("user_id", "ltv"),
}
EVENT_FACT_TYPES = {"event_date": "date", "daily_active_users": "bigint", "revenue_gross": "double", "revenue_net": "double", "user_id": "string", "ltv": "double"}


def event_facts(events: DataFrame, active_types: Sequence[str] = DAU_ACTIVE_TYPES) -> DataFrame:
    """The rows of daily active users, gross and net revenue and value per user from
    one scan: ``_outcome`` names the fact, which uses two of the other columns.

    Events are summed up per (day, user) first, inside the scan tasks; the facts are
    grouping sets of those sums, by day and by user. A user is counted once a day,
    since the sums have one row for it.
    """
    day, user, kind = F.to_date(F.col("event_ts_utc")), F.col("user_id_norm"), F.col("event_type_norm")
    bought, moved = kind == "purchase", kind.isin("purchase", "refund")
    active = kind.isin(*active_types) & user.isNotNull()
    amount = F.coalesce(money("amount_num"), F.lit(0).cast(MONEY))
    per_user = (
        events.where(kind.isin(*{*active_types, "purchase", "refund"}))
        .groupBy(day.alias("event_date"), user.alias("user_id"))
        .agg(
            F.max(active.cast("int")).alias("active"),
            F.count_if(bought).alias("n_bought"),
            F.count_if(moved).alias("n_moved"),
            F.sum(F.when(bought, amount)).alias("gross"),
            F.sum(F.when(moved, signed_amount(kind, "amount_num"))).alias("net"),
        )
    )
    sums = [F.sum(c).alias(c) for c in ("active", "n_bought", "n_moved", "gross", "net")]
    sets = per_user.groupingSets([["event_date"], ["user_id"]], "event_date", "user_id").agg(F.grouping("user_id").alias("by_day"), *sums)
    by_day = F.col("by_day") == 1

    def fact(name: str, applies: Column, value: Column) -> Column:
        key, shown = EVENT_FACTS[name]
        filled = {key: F.col(key), shown: value}
        fields = [filled.get(c, F.lit(None)).cast(t).alias(c) for c, t in EVENT_FACT_TYPES.items()]
        return F.when(applies, F.struct(F.lit(name).alias("_outcome"), *fields))

    facts = [
        fact("fact_daily_active_users", by_day & (F.col("active") > 0), F.col("active")),
        fact("fact_daily_revenue_gross", by_day & (F.col("n_bought") > 0), F.col("gross")),
        fact("fact_daily_revenue_net", by_day & (F.col("n_moved") > 0), F.col("net")),
        fact("fact_ltv_per_user", ~by_day & (F.col("n_moved") > 0) & F.col("user_id").isNotNull(), F.col("net")),
    ]
    return sets.select(F.explode(F.array_compact(F.array(*facts))).alias("f")).select("f.*")


def mrr_daily(subscriptions: DataFrame) -> DataFrame:
    """(date, mrr): sum of prices of subscriptions active on each day.

    Status and billing period are ignored, as in the source definition.
    """
    return interval_sum_daily(subscriptions, "start_date", "end_date", "price", "date", "mrr")


def signup_cohorts(events: DataFrame) -> DataFrame:
    """(user_id_norm, cohort_week): Monday of each valid user's first signup."""
    return (
        _valid_users(events)
        .where((F.col("event_type_norm") == "signup") & F.col("event_ts_utc").isNotNull())
        .groupBy(F.col("user_id_norm").alias("user_id_norm"))
        .agg(F.min(F.col("event_ts_utc")).alias("signup_ts"))
        .select("user_id_norm", week_start("signup_ts").alias("cohort_week"))
    )


def weekly_cohort_retention(events: DataFrame, active_types: Sequence[str] = RETENTION_ACTIVE_TYPES) -> DataFrame:
    """(cohort_week, week_index, active_users, cohort_size, retention_rate).

    Activity is reduced to distinct (user, week) pairs before it meets the
    one-row-per-user cohort table, so a very active user costs at most one row
    per week in the join. Weeks before the signup week are dropped; activity
    in the signup week but before the signup counts as week 0.
    """
    cohorts = signup_cohorts(events)
    sizes = cohorts.groupBy("cohort_week").agg(F.count(F.lit(1)).alias("cohort_size"))
    activity = (
        _valid_users(events)
        .where(F.col("event_type_norm").isin(*active_types) & F.col("event_ts_utc").isNotNull())
        .select("user_id_norm", week_start(F.col("event_ts_utc")).alias("activity_week"))
        .distinct()
    )
    week_index = F.floor(F.datediff("activity_week", "cohort_week") / 7).cast("int")
    active = (
        activity.join(cohorts, "user_id_norm")
        .select("cohort_week", week_index.alias("week_index"))
        .where(F.col("week_index") >= 0)
        .groupBy("cohort_week", "week_index")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    return active.join(sizes, "cohort_week", "left").select(
        "cohort_week",
        "week_index",
        "active_users",
        "cohort_size",
        (F.col("active_users") / F.col("cohort_size")).alias("retention_rate"),
    )


def first_signup_channel(events: DataFrame) -> DataFrame:
    """(user_id_norm, channel): channel of each valid user's earliest signup
    (ties broken by event id); a null-like channel becomes 'Unknown'."""
    signups = _valid_users(events).where((F.col("event_type_norm") == "signup") & F.col("event_ts_utc").isNotNull())
    channel = F.coalesce(clean_text("acquisition_channel"), F.lit(UNKNOWN_CHANNEL))
    return first_value_by(signups, "user_id_norm", channel, [F.col("event_ts_utc"), F.col("event_id")], "channel")


def cac_by_channel(events: DataFrame, marketing: DataFrame) -> DataFrame:
    """(channel, total_spend, paid_conversions, cac) for every channel with spend.

    A paid conversion is a valid user with at least one purchase, credited to
    the channel of their earliest signup ('Unknown' without one). Channels that
    convert but have no spend rows are not reported. cac is null at 0
    conversions.
    """
    converters = _valid_users(events).where(F.col("event_type_norm") == "purchase").select("user_id_norm").distinct()
    credited = converters.join(first_signup_channel(events), "user_id_norm", "left").select(
        F.coalesce("channel", F.lit(UNKNOWN_CHANNEL)).alias("channel")
    )
    conversions = credited.groupBy("channel").agg(F.count(F.lit(1)).alias("paid_conversions"))
    spend = marketing.groupBy(F.coalesce(clean_text("channel"), F.lit(UNKNOWN_CHANNEL)).alias("channel")).agg(
        F.sum(F.coalesce(money("spend"), F.lit(0).cast(MONEY))).cast("double").alias("total_spend")
    )
    paid = F.coalesce("paid_conversions", F.lit(0)).cast("bigint")
    return spend.join(conversions, "channel", "left").select(
        "channel",
        "total_spend",
        paid.alias("paid_conversions"),
        F.when(paid > 0, F.col("total_spend") / paid).alias("cac"),
    )


def ltv_cac_ratio(ltv: DataFrame, marketing: DataFrame, events: DataFrame) -> DataFrame:
    """One row: total_ltv, total_spend, paid_conversions, cac_overall,
    ltv_cac_ratio = total LTV / overall CAC (null when undefined).

    The three global figures come from one aggregation over a union of the
    three inputs (no join, no driver round trip).
    """
    dec_null = F.lit(None).cast(MONEY)
    str_null = F.lit(None).cast("string")
    parts = (
        ltv.select(money("ltv").alias("l"), dec_null.alias("s"), str_null.alias("u"))
        .unionByName(marketing.select(dec_null.alias("l"), money("spend").alias("s"), str_null.alias("u")))
        .unionByName(
            _valid_users(events).where(F.col("event_type_norm") == "purchase").select(dec_null.alias("l"), dec_null.alias("s"), F.col("user_id_norm").alias("u"))
        )
    )
    totals = parts.agg(
        F.coalesce(F.sum("l"), F.lit(0).cast(MONEY)).cast("double").alias("total_ltv"),
        F.coalesce(F.sum("s"), F.lit(0).cast(MONEY)).cast("double").alias("total_spend"),
        F.count_distinct("u").alias("paid_conversions"),
    )
    cac = F.when(F.col("paid_conversions") > 0, F.col("total_spend") / F.col("paid_conversions"))
    return totals.select("total_ltv", "total_spend", "paid_conversions", cac.alias("cac_overall")).withColumn(
        "ltv_cac_ratio", safe_ratio("total_ltv", "cac_overall")
    )


# The order of published tables; keys behind the first make it total.
PRESENTATION_ORDER = {
    "fact_daily_active_users": [("event_date", "asc")],
    "fact_daily_revenue_gross": [("event_date", "asc")],
    "fact_daily_revenue_net": [("event_date", "asc")],
    "fact_mrr_daily": [("date", "asc")],
    "fact_weekly_cohort_retention": [("cohort_week", "asc"), ("week_index", "asc")],
    "fact_cac_by_channel": [("total_spend", "desc"), ("channel", "asc")],
    "fact_ltv_per_user": [("ltv", "desc"), ("user_id", "asc")],
    "dim_date": [("date", "asc")],
    "dim_channel": [("channel", "asc")],
    "dim_plan": [("plan_id", "asc"), ("price", "asc"), ("currency", "asc")],
    "dim_user": [("user_id", "asc")],
}


def presentation_order(name: str, df: DataFrame) -> DataFrame:
    """``df`` dealt out by ranges of the published order of table ``name``, each
    sorted on its own: written, its files in name order are the table in order (see
    ``lake.read_in_order``), however many rows it has. Nulls come first going up,
    last going down."""
    order = PRESENTATION_ORDER.get(name)
    if not order:
        return df
    columns = [F.asc(c) if how == "asc" else F.desc(c) for c, how in order]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def event_facts_order(facts: DataFrame) -> DataFrame:
    """``event_facts`` in the published order of each of its facts."""
    columns = [F.asc("_outcome"), F.asc("event_date"), F.desc("ltv"), F.asc("user_id")]
    return facts.repartitionByRange(*columns).sortWithinPartitions(*columns)
