"""Registered queries: one Spark callable per product, each over the whole
shared test tables, and its DuckDB oracle (see ``subledger.oracle``).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.functions import clean_text, parse_date, safe_ratio, signed_amount, to_number, to_utc_ntz, week_start, weekday_mon0
from subledger.functions.numbers import money
from subledger.oracle import CTES, with_ctes
from subledger.operators import (
    calendar_fill,
    conditional_min,
    interval_sum_daily,
    keep_latest,
    tag_rejects,
    union_dates,
)
from subledger.plans import catalog, dims, gold, silver, views
from subledger.plans.lake import POSITION, read_in_order, table_path
from subledger.plans.pipeline import Pipeline, run_all
from subledger.plans.silver import flag_overlaps
from subledger.schemas import SUBSCRIPTION_FIELDS
from subledger.session import scratch_path, written
from subledger.sources import adapters, bronze, raw_files

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------ shared inputs


def _events(spark: SparkSession, d: str) -> DataFrame:
    return adapters.silver_events(spark, d)


def _marketing(spark: SparkSession, d: str) -> DataFrame:
    return silver.clean_marketing(adapters.bronze_marketing(spark, d))[0]


def _subscriptions(spark: SparkSession, d: str) -> DataFrame:
    return silver.clean_subscriptions(adapters.bronze_subscriptions(spark, d))[0]


def _typed_subscriptions(spark: SparkSession, d: str) -> DataFrame:
    """Orders as typed subscriptions (no cleaning), for the primitives."""
    o = adapters.table(spark, d, "orders")
    k = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("date")
    return o.select(
        k.cast("string").alias("subscription_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("double").alias("price"),
        start.alias("start_date"),
        F.when(k % 50 != 0, F.date_add(start, (k % 365).cast("int"))).alias("end_date"),
        start.cast("timestamp_ntz").alias("created_at_ts"),
    )


# ------------------------------------------------------------------ bronze


def _raw_events(spark, d):
    return raw_files.write_events_ndjson(spark, d, scratch_path(spark, "raw-events"))


def q_bronze_events(spark, d):
    good, _ = bronze.ingest_events(spark, _raw_events(spark, d))
    return good.select(
        "event_id",
        "user_id",
        "event_type",
        to_utc_ntz("timestamp").alias("event_ts_utc"),
        to_number("amount").alias("amount_num"),
        F.regexp_extract(F.col("extras")["props"], "([0-9]+)", 1).try_cast("int").alias("props_k"),
        "_source_line_no",
    )


def q_bronze_events_bad_rows(spark, d):
    _, bad = bronze.ingest_events(spark, _raw_events(spark, d))
    return bad.select("_source_line_no", "_raw_line", "_raw_head", "_error")


def q_bronze_subscriptions(spark, d):
    path = raw_files.write_subscriptions_json(spark, d, scratch_path(spark, "raw-subscriptions"))
    return bronze.ingest_subscriptions(spark, path)[0].select(*SUBSCRIPTION_FIELDS)


def _raw_subscription_lines(spark, d):
    return raw_files.write_subscriptions_ndjson(spark, d, scratch_path(spark, "raw-subscription-lines"))


def q_bronze_subscriptions_ndjson(spark, d):
    return bronze.ingest_subscriptions(spark, _raw_subscription_lines(spark, d), "ndjson")[0].select(*SUBSCRIPTION_FIELDS)


def q_bronze_subscriptions_bad_rows(spark, d):
    bad = bronze.ingest_subscriptions(spark, _raw_subscription_lines(spark, d), "ndjson")[1]
    return bad.select("_raw_line", "_error")


def q_bronze_subscriptions_array_bad_rows(spark, d):
    """Elements of JSON arrays that are no object, with their places; and in the same
    files an object whose text holds brackets and quotes."""
    path = raw_files.write_subscriptions_json(spark, d, scratch_path(spark, "raw-subscriptions"), defects=True)
    good, bad = bronze.ingest_subscriptions(spark, path)
    odd = good.where(F.col("plan_id") == raw_files.ODD_PLAN).select(
        F.col("subscription_id").alias("_raw_line"), F.col("plan_id").alias("_error"), "_source_row_no"
    )
    return bad.select("_raw_line", "_error", "_source_row_no").unionByName(odd)


def q_bronze_marketing(spark, d):
    path = raw_files.write_marketing_csv(spark, d, scratch_path(spark, "raw-marketing"))
    return bronze.ingest_marketing(spark, path)[0]


def q_bronze_marketing_bad_rows(spark, d):
    path = raw_files.write_marketing_csv(spark, d, scratch_path(spark, "raw-marketing"))
    return bronze.ingest_marketing(spark, path)[1].select("date", "channel", "spend", "_raw_line", "_error")


# ------------------------------------------------------------------ silver


def q_silver_events(spark, d):
    good, _ = silver.clean_events(adapters.bronze_events_dirty(spark, d))
    shown = ("event_id", "user_id", "event_type", "acquisition_channel", "_source_line_no", "event_ts_utc", "amount_num", "event_type_norm", "user_id_norm")
    return good.select(*shown)


def q_silver_events_rejected(spark, d):
    _, bad = silver.clean_events(adapters.bronze_events_dirty(spark, d))
    return bad.select("event_id", "_source_line_no", "reject_reason")


def q_silver_marketing(spark, d):
    return _marketing(spark, d)


def q_silver_marketing_rejected(spark, d):
    return silver.clean_marketing(adapters.bronze_marketing(spark, d))[1]


_SUB_COLS = ("subscription_id", "user_id", "plan_id", "price", "currency", "status", "created_at_ts",
             "start_date", "end_date", "gap_days", "reactivated")


def q_silver_subscriptions(spark, d):
    return _subscriptions(spark, d).select(*_SUB_COLS)


def q_silver_subscriptions_rejected(spark, d):
    _, bad = silver.clean_subscriptions(adapters.bronze_subscriptions(spark, d))
    return bad.select("subscription_id", "user_id", "price", "start_date", "end_date", "gap_days", "reactivated", "reject_reason")


def q_subscription_flag_counts(spark, d):
    """How many subscriptions overlap their predecessor, and how many of the
    clean ones are reactivations."""
    return silver.flag_counts(*silver.clean_subscriptions(adapters.bronze_subscriptions(spark, d)))


def q_every_subscription_rule(spark, d):
    """Every reject rule of subscriptions and every date layout."""
    good, bad = silver.clean_subscriptions(adapters.every_subscription(spark, d))
    columns = ["subscription_id", "user_id", "price", "created_at_ts"]
    kept = good.select(*columns, F.col("start_date").cast("string").alias("start_date"), F.lit(None).cast("string").alias("reject_reason"))
    return kept.unionByName(bad.select(*columns, "start_date", "reject_reason"))


def q_every_marketing_rule(spark, d):
    """Every reject rule of marketing spend, null-like channels and every date layout:
    the rejects row by row, the kept spend by channel."""
    good, bad = silver.clean_marketing(adapters.every_spend(spark, d))
    by_channel = good.groupBy("channel").agg(F.sum(money("spend")).cast("double").alias("spend_num"), F.min("date").alias("date"))
    kept = by_channel.select("date", "channel", F.lit(None).cast("string").alias("spend"), "spend_num", F.lit(None).cast("string").alias("reject_reason"))
    return kept.unionByName(bad.select("date", "channel", "spend", "spend_num", "reject_reason"))


def q_every_time_layout(spark, d):
    """Every layout of times and dates, and text that is no full date."""
    rows = adapters.every_layout(spark, d)
    return rows.select("event_id", to_utc_ntz("stamp").alias("ts_utc"), parse_date("day").alias("day"))


def q_quarantine_rows(spark, d):
    """What a run puts aside: every quarantined row of the six tables, with its
    reason, as they lie on disk."""
    raw = raw_files.write_raw_inputs(spark, d, scratch_path(spark, "raw"), defects=True)
    run = Pipeline(spark, raw, scratch_path(spark, "lake"), "subledger_quarantine")
    for step in (run.bronze_events, run.bronze_subscriptions, run.bronze_marketing, run.silver_events, run.silver_marketing, run.silver_subscriptions):
        step()

    def rows(table: str, reason: str, *shown: str) -> DataFrame:
        what = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in shown])
        stored = spark.read.parquet(table_path(run.root, table))
        return stored.select(F.lit(table).alias("table_name"), F.col(reason).alias("reason"), what.alias("row_text"))

    parts = [
        rows("events_bad_rows", "_error", "_source_line_no", "_raw_line"),
        rows("subscriptions_bad_rows", "_error", "_source_row_no", "_raw_line"),
        rows("marketing_bad_rows", "_error", "_raw_line"),
        rows("events_rejected_silver", "reject_reason", "event_id", "user_id", "timestamp", "_source_line_no"),
        rows("marketing_spend_rejected_silver", "reject_reason", "date", "channel", "rejected_spend"),
        rows("subscriptions_rejected_silver", "reject_reason", "subscription_id", "user_id", "rejected_start_date", "rejected_end_date", "gap_days"),
    ]
    return reduce(DataFrame.unionByName, parts)


# -------------------------------------------------------------------- gold


def q_daily_active_users(spark, d):
    return gold.daily_active_users(_events(spark, d))


def q_daily_revenue_gross(spark, d):
    return gold.daily_revenue_gross(_events(spark, d))


def q_daily_revenue_net(spark, d):
    return gold.daily_revenue_net(_events(spark, d))


def q_mrr_daily(spark, d):
    return gold.mrr_daily(_subscriptions(spark, d))


def q_weekly_cohort_retention(spark, d):
    return gold.weekly_cohort_retention(_events(spark, d))


def q_cac_by_channel(spark, d):
    return gold.cac_by_channel(_events(spark, d), _marketing(spark, d))


def q_ltv_per_user(spark, d):
    return gold.ltv_per_user(_events(spark, d))


def q_event_facts(spark, d):
    """The four facts that one scan of the events yields."""
    facts = gold.event_facts(_events(spark, d))
    value = F.coalesce(F.col("daily_active_users").cast("double"), "revenue_gross", "revenue_net", "ltv")
    return facts.select(F.col("_outcome").alias("fact"), "event_date", "user_id", value.alias("value"))


def q_ltv_cac_ratio(spark, d):
    ev = _events(spark, d)
    return gold.ltv_cac_ratio(gold.ltv_per_user(ev), _marketing(spark, d), ev)


# -------------------------------------------------------------- dimensions


def q_dim_date(spark, d):
    return dims.dim_date(_events(spark, d), _marketing(spark, d), _subscriptions(spark, d))


def q_dim_channel(spark, d):
    return dims.dim_channel(_marketing(spark, d))


def q_dim_plan(spark, d):
    return dims.dim_plan(_subscriptions(spark, d))


def q_dim_user(spark, d):
    return dims.dim_user(_events(spark, d))


# ------------------------------------------------------------------- views


def _view(name: str) -> Query:
    """The view as a DataFrame over the facts and dimensions that it names."""

    def q(spark, d):
        return views.VIEWS[name].frame(_tables(spark, d, views.VIEWS[name].tables()))

    return q


def _catalog_view(name: str) -> Query:
    """The published view, read with SQL from a database of its own."""

    def q(spark, d):
        db, view = f"subledger_{name}", views.VIEWS[name]
        catalog.publish(spark, _tables(spark, d, view.tables()), scratch_path(spark, name), db)
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {view.statement(db)}")
        return spark.sql(f"SELECT * FROM {db}.{name}")

    return q


# ----------------------------------------------------------------- catalog


#: Published table -> its query: a plan is built only for the tables asked for.
_PUBLISHED: dict[str, Query] = {
    "fact_daily_active_users": q_daily_active_users,
    "fact_daily_revenue_gross": q_daily_revenue_gross,
    "fact_daily_revenue_net": q_daily_revenue_net,
    "fact_mrr_daily": q_mrr_daily,
    "fact_weekly_cohort_retention": q_weekly_cohort_retention,
    "fact_cac_by_channel": q_cac_by_channel,
    "fact_ltv_per_user": q_ltv_per_user,
    "fact_ltv_cac_ratio": q_ltv_cac_ratio,
    "dim_date": q_dim_date,
    "dim_channel": q_dim_channel,
    "dim_plan": q_dim_plan,
    "dim_user": q_dim_user,
}


#: The silver tables, those aside that are a projection of the input, and the
#: published tables that read them.
_SILVER: dict[str, tuple[Query, set[str]]] = {
    "marketing": (_marketing, {"fact_cac_by_channel", "fact_ltv_cac_ratio", "dim_date", "dim_channel"}),
    "subscriptions": (_subscriptions, {"fact_mrr_daily", "dim_date", "dim_plan"}),
}


def _tables(spark, d, names) -> dict[str, DataFrame]:
    """Published tables by name. A silver table that several of them read is made once,
    written and read back."""
    held = {k: written(q(spark, d), f"silver-{k}") for k, (q, users) in _SILVER.items() if len(users & set(names)) > 1}
    inputs = {"marketing": lambda: held.get("marketing") or _marketing(spark, d), "subscriptions": lambda: held.get("subscriptions") or _subscriptions(spark, d)}
    own: dict[str, Callable[[], DataFrame]] = {
        "fact_mrr_daily": lambda: gold.mrr_daily(inputs["subscriptions"]()),
        "fact_cac_by_channel": lambda: gold.cac_by_channel(_events(spark, d), inputs["marketing"]()),
        "fact_ltv_cac_ratio": lambda: gold.ltv_cac_ratio(gold.ltv_per_user(_events(spark, d)), inputs["marketing"](), _events(spark, d)),
        "dim_date": lambda: dims.dim_date(_events(spark, d), inputs["marketing"](), inputs["subscriptions"]()),
        "dim_channel": lambda: dims.dim_channel(inputs["marketing"]()),
        "dim_plan": lambda: dims.dim_plan(inputs["subscriptions"]()),
    }
    return {n: own[n]() if n in own else _PUBLISHED[n](spark, d) for n in names}


def q_fact_row_counts(spark, d):
    """Publish the 8 facts as catalog tables; their row counts."""
    return catalog.load_facts(spark, _tables(spark, d, catalog.FACT_TABLES), scratch_path(spark, "facts"), "subledger_fact_counts")


def q_dim_row_counts(spark, d):
    """Publish the 4 dimensions as catalog tables; one row of counts."""
    catalog.publish(spark, _tables(spark, d, catalog.DIM_TABLES), scratch_path(spark, "dims"), "subledger_dim_counts")
    return catalog.dim_row_counts(spark, "subledger_dim_counts")


#: Published tables whose order ``published_order`` compares, with the text of a row.
_ORDERED = {
    "fact_cac_by_channel": ("channel",),
    "fact_ltv_per_user": ("user_id",),
    "fact_weekly_cohort_retention": ("cohort_week", "week_index"),
    "dim_channel": ("channel",),
    "dim_plan": ("plan_id", "price", "currency"),
    "dim_user": ("user_id",),
}


def q_published_order(spark, d):
    """Place of every row in published tables, as their files give it."""
    root, parts = scratch_path(spark, "ordered"), []
    for name, shown in _ORDERED.items():
        path = f"{root}/{name}"
        gold.presentation_order(name, _PUBLISHED[name](spark, d)).write.parquet(path)
        text = F.concat_ws("|", *[F.col(c).cast("decimal(18,2)" if c == "price" else "string").cast("string") for c in shown])
        parts.append(read_in_order(spark, path).select(F.lit(name).alias("table_name"), POSITION, text.alias("row_text")))
    return reduce(DataFrame.unionByName, parts)


def q_pipeline_runs(spark, d):
    """Whole run from raw files derived from the tables; the audit rows."""
    raw = raw_files.write_raw_inputs(spark, d, scratch_path(spark, "raw"))
    return run_all(spark, raw, scratch_path(spark, "lake"))


def q_pipeline_step_audit(spark, d):
    """What of the audit is the same in every run: each step with its status, the
    rows written and rejected, and its metrics as "name=value" by name."""
    raw = raw_files.write_raw_inputs(spark, d, scratch_path(spark, "raw"))
    audit = run_all(spark, raw, scratch_path(spark, "lake"), "subledger_step_audit")
    pairs = F.transform(F.map_entries("metrics"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return audit.select("step", "status", "rows_out", "rows_rejected", F.array_join(F.sort_array(pairs), ",").alias("metrics"))


# -------------------------------------------------------------- primitives


def q_reject_split(spark, d):
    """Orders tagged by ordered rules: first matching reason, null = good."""
    o = adapters.table(spark, d, "orders")
    tagged = tag_rejects(
        o,
        [
            ("low_priority", F.col("o_orderpriority") == "5-LOW"),
            ("large_order", F.col("o_totalprice") > 300000),
            ("pending", F.col("o_orderstatus") == "P"),
        ],
    )
    return tagged.select("o_orderkey", "reject_reason")


def q_keep_latest(spark, d):
    """Latest event per user (timestamp desc, event id desc)."""
    ev = adapters.table(spark, d, "events")
    return keep_latest(ev, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "ts")


def q_overlap_flags(spark, d):
    flagged = flag_overlaps(_typed_subscriptions(spark, d))
    return flagged.select("subscription_id", "prev_end_eff", "gap_days", "is_overlap", "reactivated")


def q_interval_sum_daily(spark, d):
    return interval_sum_daily(_typed_subscriptions(spark, d), "start_date", "end_date", "price", "date", "total")


def q_calendar_fill(spark, d):
    """Dense (day x order priority) grid of order value, 0 on empty cells."""
    o = adapters.table(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"), "o_orderpriority", money("o_totalprice").alias("value")
    )
    dense = calendar_fill(o, "date", ["o_orderpriority"], "value", 0, agg="sum")
    return dense.select("date", "o_orderpriority", F.col("value").cast("double").alias("value"))


def q_first_channel_by_user(spark, d):
    return gold.first_signup_channel(_events(spark, d)).withColumnRenamed("user_id_norm", "user_id")


def q_union_dates(spark, d):
    ev = adapters.table(spark, d, "events")
    o = adapters.table(spark, d, "orders")
    return union_dates([(ev, F.to_date("ts")), (o, F.to_date("o_orderdate"))])


def q_conditional_min(spark, d):
    """Per customer, the first date of a finished order."""
    o = adapters.table(spark, d, "orders")
    return conditional_min(o, "o_custkey", F.col("o_orderstatus") == "F", F.to_date("o_orderdate"), "first_finished")


def q_scalar_functions(spark, d):
    """The column functions over every event row."""
    ev = adapters.table(spark, d, "events")
    i, ts = F.col("event_id"), F.col("ts")
    ts_txt = ts.cast("string")
    variant = (
        F.when(i % 3 == 0, F.concat(F.regexp_replace(ts_txt, " ", "T"), F.lit("Z")))
        .when(i % 3 == 1, F.concat((ts + F.expr("INTERVAL 330 MINUTES")).cast("string"), F.lit("+05:30")))
        .otherwise(ts_txt)
    )
    padded_user = F.when(i % 4 == 0, F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit("\t"))).when(
        i % 4 == 1, F.lit(" NaN ")
    ).otherwise(F.col("user_id").cast("string"))
    amount_txt = F.when(i % 5 == 0, F.lit("1d")).when(i % 5 == 1, F.lit("nan")).otherwise(F.col("value").cast("string"))
    etype = F.when(F.col("event_type") == "purchase", "purchase").otherwise("refund")
    return ev.select(
        "event_id",
        clean_text(padded_user).alias("user_clean"),
        to_number(amount_txt).alias("amount_num"),
        to_utc_ntz(variant).alias("ts_utc"),
        week_start(ts).alias("week_start"),
        weekday_mon0(ts.cast("date")).alias("weekday"),
        signed_amount(etype, "value").cast("double").alias("signed"),
        safe_ratio("value", F.col("user_id") % 3).alias("ratio"),
    )


QUERIES: dict[str, Query] = {
    "bronze_events": q_bronze_events,
    "bronze_events_bad_rows": q_bronze_events_bad_rows,
    "bronze_subscriptions": q_bronze_subscriptions,
    "bronze_subscriptions_ndjson": q_bronze_subscriptions_ndjson,
    "bronze_subscriptions_bad_rows": q_bronze_subscriptions_bad_rows,
    "bronze_subscriptions_array_bad_rows": q_bronze_subscriptions_array_bad_rows,
    "bronze_marketing": q_bronze_marketing,
    "bronze_marketing_bad_rows": q_bronze_marketing_bad_rows,
    "silver_events": q_silver_events,
    "silver_events_rejected": q_silver_events_rejected,
    "silver_marketing": q_silver_marketing,
    "silver_marketing_rejected": q_silver_marketing_rejected,
    "silver_subscriptions": q_silver_subscriptions,
    "silver_subscriptions_rejected": q_silver_subscriptions_rejected,
    "subscription_flag_counts": q_subscription_flag_counts,
    "every_subscription_rule": q_every_subscription_rule,
    "every_marketing_rule": q_every_marketing_rule,
    "every_time_layout": q_every_time_layout,
    "quarantine_rows": q_quarantine_rows,
    "daily_active_users": q_daily_active_users,
    "daily_revenue_gross": q_daily_revenue_gross,
    "daily_revenue_net": q_daily_revenue_net,
    "mrr_daily": q_mrr_daily,
    "weekly_cohort_retention": q_weekly_cohort_retention,
    "cac_by_channel": q_cac_by_channel,
    "ltv_per_user": q_ltv_per_user,
    "event_facts": q_event_facts,
    "ltv_cac_ratio": q_ltv_cac_ratio,
    "dim_date": q_dim_date,
    "dim_channel": q_dim_channel,
    "dim_plan": q_dim_plan,
    "dim_user": q_dim_user,
    **{name: _view(name) for name in views.VIEWS},
    **{f"catalog_{name}": _catalog_view(name) for name in views.VIEWS},
    "fact_row_counts": q_fact_row_counts,
    "dim_row_counts": q_dim_row_counts,
    "published_order": q_published_order,
    "pipeline_runs": q_pipeline_runs,
    "pipeline_step_audit": q_pipeline_step_audit,
    "reject_split": q_reject_split,
    "keep_latest": q_keep_latest,
    "overlap_flags": q_overlap_flags,
    "interval_sum_daily": q_interval_sum_daily,
    "calendar_fill": q_calendar_fill,
    "first_channel_by_user": q_first_channel_by_user,
    "union_dates": q_union_dates,
    "conditional_min": q_conditional_min,
    "scalar_functions": q_scalar_functions,
}


# ------------------------------------------------------------------ oracle

_TYPED_SUBS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS subscription_id, CAST(o_custkey AS VARCHAR) AS user_id,
      CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(o_orderdate AS DATE) AS start_date,
      CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 365 AS INTEGER) END AS end_date,
      CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS created_at_ts
    FROM orders"""

_EV_TYPE = """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'login'
                          WHEN 'error' THEN 'refund' ELSE event_type END"""

# Raw NDJSON layout (see raw_files.write_events_ndjson): file = id div n,
# lines ordered by (id, kind); kinds 0 blank, 1 event, 2 broken, 3 duplicate-key.
_EVENT_LINES = f"""
    l AS (SELECT event_id, 0 AS kind FROM events WHERE event_id % 50 = 0
          UNION ALL SELECT event_id, 1 FROM events
          UNION ALL SELECT event_id, 2 FROM events WHERE event_id % 83 = 0
          UNION ALL SELECT event_id, 3 FROM events WHERE event_id % 97 = 0),
    ln AS (SELECT l.event_id, kind,
             ROW_NUMBER() OVER (PARTITION BY l.event_id // {raw_files.KEYS_PER_FILE} ORDER BY l.event_id, kind) AS line_no FROM l)"""

_BROKEN = """'{"event_id": ' || CAST(event_id AS VARCHAR) || ', "broken"' ||
      CASE WHEN event_id % 581 = 0 THEN repeat(' x', 2000) ELSE '' END"""

_SUB_STRINGS = """
    SELECT CAST(k AS VARCHAR) AS subscription_id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderpriority AS plan_id,
      CAST(p AS VARCHAR) AS price, 'USD' AS currency,
      CASE WHEN k % 11 = 0 THEN replace(CAST(sd AS VARCHAR), '-', '/') ELSE CAST(sd AS VARCHAR) END AS start_date,
      CASE WHEN k % 50 <> 0 THEN CAST(sd + CAST(k % 365 AS INTEGER) AS VARCHAR) END AS end_date,
      CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'cancelled' ELSE 'paused' END AS status,
      CAST(sd AS VARCHAR) || 'T00:00:00Z' AS created_at, k, p, sd
    FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS sd, CAST(o_totalprice AS DECIMAL(12,2)) AS p,
                 o_custkey, o_orderpriority, o_orderstatus FROM orders) o"""

_MK_STRINGS = """
    SELECT CASE WHEN o_orderkey % 11 = 0 THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '/')
                ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date,
      CASE WHEN o_orderkey % 7 = 0 THEN ' ch' || CAST(o_orderkey % 5 AS VARCHAR) || ' '
           ELSE 'ch' || CAST(o_orderkey % 5 AS VARCHAR) END AS channel,
      CAST(CAST((o_totalprice - 5000) / 1000 AS DECIMAL(18,5)) AS VARCHAR) AS spend, o_orderkey
    FROM orders"""

_FACT_CTES = {
    "fact_daily_active_users": "dau",
    "fact_daily_revenue_gross": "gross",
    "fact_daily_revenue_net": "net",
    "fact_mrr_daily": "mrr",
    "fact_weekly_cohort_retention": "ret",
    "fact_cac_by_channel": "cac",
    "fact_ltv_per_user": "ltv",
    "fact_ltv_cac_ratio": "ratio",
}

ORACLE: dict[str, str] = {
    "bronze_events": f"""
        WITH {_EVENT_LINES}
        SELECT CAST(e.event_id AS VARCHAR) AS event_id, CAST(e.user_id AS VARCHAR) AS user_id,
          {_EV_TYPE} AS event_type, e.ts AS event_ts_utc, e.value AS amount_num,
          TRY_CAST(regexp_extract(e.props, '([0-9]+)', 1) AS INTEGER) AS props_k, ln.line_no AS _source_line_no
        FROM events e JOIN ln ON ln.event_id = e.event_id AND ln.kind = 1
        UNION ALL
        SELECT 'dup' || CAST(e.event_id AS VARCHAR), CAST(e.user_id AS VARCHAR), 'signup', e.ts, NULL, NULL, ln.line_no
        FROM events e JOIN ln ON ln.event_id = e.event_id AND ln.kind = 3""",
    "bronze_events_bad_rows": f"""
        WITH {_EVENT_LINES}
        SELECT line_no AS _source_line_no, {_BROKEN} AS _raw_line, left({_BROKEN}, {bronze.HEAD_CHARS}) AS _raw_head, 'invalid_json' AS _error
        FROM ln WHERE kind = 2""",
    "bronze_subscriptions": f"""
        WITH s AS ({_SUB_STRINGS})
        SELECT subscription_id, user_id, plan_id, price, currency, start_date, end_date, status, created_at FROM s
        UNION ALL
        SELECT subscription_id, user_id, plan_id, CAST(p + 1 AS VARCHAR), currency, start_date, end_date, status,
          CAST(sd - 1 AS VARCHAR) || 'T12:00:00Z' FROM s WHERE k % 40 = 0
        UNION ALL
        SELECT 'x' || subscription_id, '  ', plan_id, price, currency, start_date, end_date, status, created_at
        FROM s WHERE k % 97 = 0""",
    "bronze_subscriptions_bad_rows": f"""
        WITH s AS ({_SUB_STRINGS})
        SELECT '{{"subscription_id": "' || subscription_id || '"' AS _raw_line, 'invalid_json' AS _error FROM s WHERE k % 83 = 0
        UNION ALL SELECT subscription_id, 'invalid_json' FROM s WHERE k % 89 = 0
        UNION ALL SELECT 'null', 'not_one_object' FROM s WHERE k % 79 = 0""",
    "bronze_subscriptions_array_bad_rows": f"""
        WITH o AS (SELECT o_orderkey AS k FROM orders),
        l AS (SELECT k, 0 AS kind FROM o UNION ALL SELECT k, 5 FROM o WHERE k % 40 = 0 UNION ALL SELECT k, 6 FROM o WHERE k % 97 = 0
              UNION ALL SELECT k, 1 FROM o WHERE k % 83 = 0 UNION ALL SELECT k, 2 FROM o WHERE k % 89 = 0
              UNION ALL SELECT k, 3 FROM o WHERE k % 79 = 0 UNION ALL SELECT k, 4 FROM o WHERE k % 73 = 0),
        n AS (SELECT *, row_number() OVER (PARTITION BY 3 * k // {3 * raw_files.KEYS_PER_FILE} ORDER BY k, kind) AS _source_row_no FROM l)
        SELECT CASE kind WHEN 1 THEN k::VARCHAR WHEN 2 THEN 'null' WHEN 3 THEN '[1,"}}"]' ELSE 's' || k::VARCHAR END AS _raw_line,
          CASE kind WHEN 2 THEN 'not_one_object' WHEN 4 THEN '{raw_files.ODD_PLAN}' ELSE 'invalid_json' END AS _error, _source_row_no
        FROM n WHERE kind IN (1, 2, 3, 4)""",
    "bronze_marketing": f"""
        WITH m AS ({_MK_STRINGS})
        SELECT date, channel, spend FROM m
        UNION ALL SELECT date, channel, NULL FROM m WHERE o_orderkey % 331 = 0
        UNION ALL SELECT date, 'a "b", c' || chr(10) || 'd', spend FROM m WHERE o_orderkey % 307 = 0""",
    "bronze_marketing_bad_rows": f"""
        WITH m AS ({_MK_STRINGS})
        SELECT date, channel, spend, date || ',' || channel || ',' || spend || ',extra' AS _raw_line, 'too_many_fields' AS _error
        FROM m WHERE o_orderkey % 499 = 0""",
    "fact_row_counts": with_ctes(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {c}" for t, c in _FACT_CTES.items())
    ),
    "dim_row_counts": with_ctes(
        "SELECT " + ", ".join(f"(SELECT COUNT(*) FROM {t}) AS {t}_rows" for t in catalog.DIM_TABLES)
    ),
    "silver_events": """
        WITH e AS (
          SELECT event_id AS i, CAST(user_id AS VARCHAR) AS user_id, ts, value,
            CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'login' WHEN 'error' THEN 'refund' ELSE event_type END AS kind,
            CASE WHEN event_type = 'signup' THEN 'ch' ||
              CAST(TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % 5 AS VARCHAR) END AS acquisition_channel,
            -- which of an event's rows is the latest: the copy of the same time, the original, or the older one
            CASE WHEN event_id % 15 = 0 THEN 3 WHEN event_id % 17 <> 0 THEN 1 WHEN event_id % 10 = 0 THEN 2 END AS latest
          FROM events)
        SELECT CAST(i AS VARCHAR) AS event_id, user_id, kind AS event_type, acquisition_channel, i * 3 + latest AS _source_line_no,
          CASE latest WHEN 2 THEN ts - INTERVAL 1 HOUR ELSE ts END AS event_ts_utc,
          CASE latest WHEN 3 THEN value + 2000 WHEN 2 THEN value + 1000 ELSE CASE WHEN i % 13 <> 0 THEN value END END AS amount_num,
          lower(trim(kind)) AS event_type_norm, trim(user_id) AS user_id_norm
        FROM e WHERE latest IS NOT NULL""",
    "silver_events_rejected": """
        SELECT '  ' AS event_id, event_id * 3 + 1000000 AS _source_line_no, 'missing_event_id' AS reject_reason
        FROM events WHERE event_id % 101 = 0
        UNION ALL
        SELECT CAST(event_id AS VARCHAR), event_id * 3 + 1, 'bad_timestamp' FROM events WHERE event_id % 17 = 0""",
    "silver_marketing": with_ctes("SELECT date, channel, spend FROM mk"),
    "silver_marketing_rejected": with_ctes("""
        SELECT date, channel, CAST(spend5 AS VARCHAR) AS spend, CAST(spend5 AS DOUBLE) AS spend_num,
          'negative_spend' AS reject_reason
        FROM mraw WHERE spend5 < 0"""),
    "silver_subscriptions": with_ctes(f"SELECT {', '.join(_SUB_COLS)} FROM sub"),
    "silver_subscriptions_rejected": with_ctes("""
        SELECT subscription_id, user_id, price, CAST(start_date AS VARCHAR) AS start_date,
          CAST(end_date AS VARCHAR) AS end_date, gap_days, reactivated, 'overlap' AS reject_reason
        FROM sflag WHERE is_overlap
        UNION ALL
        SELECT 'x' || subscription_id, NULL, price,
          CASE WHEN o_orderkey % 11 = 0 THEN replace(CAST(start_date AS VARCHAR), '-', '/')
               ELSE CAST(start_date AS VARCHAR) END,
          CAST(end_date AS VARCHAR), NULL, NULL, 'missing_user_id'
        FROM sraw WHERE o_orderkey % 97 = 0"""),
    "subscription_flag_counts": with_ctes("""
        SELECT COUNT(*) FILTER (WHERE is_overlap) AS overlaps, COUNT(*) FILTER (WHERE reactivated AND NOT is_overlap) AS reactivated
        FROM sflag"""),
    "every_subscription_rule": """
        WITH o AS (SELECT *, o_orderkey % 29 AS r, o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
        t AS (
          SELECT CASE WHEN r = 1 THEN NULL ELSE CAST(k AS VARCHAR) END AS subscription_id,
            CASE WHEN r IN (2, 6) THEN NULL ELSE CAST(k AS VARCHAR) END AS user_id,
            CASE WHEN r <> 3 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) END AS price,
            CASE WHEN r NOT IN (5, 6) THEN CAST(d AS TIMESTAMP) + INTERVAL 495 MINUTE END AS created_at_ts, r, k, d,
            CASE r WHEN 1 THEN 'missing_subscription_id' WHEN 2 THEN 'missing_user_id' WHEN 6 THEN 'missing_user_id'
                   WHEN 3 THEN 'bad_price' WHEN 4 THEN 'bad_start_date' WHEN 5 THEN 'bad_created_at' END AS reject_reason
          FROM o)
        SELECT subscription_id, user_id, price, created_at_ts, reject_reason,
          CASE WHEN r = 4 THEN strftime(d, '%m-%d') WHEN reject_reason IS NULL THEN CAST(d AS VARCHAR)
               WHEN k % 8 = 0 THEN strftime(d, '%Y-%m-%d') WHEN k % 8 = 1 THEN strftime(d, '%Y/%m/%d')
               WHEN k % 8 = 2 THEN strftime(d, '%m/%d/%Y') WHEN k % 8 = 3 THEN strftime(d, '%m-%d-%Y')
               WHEN k % 8 = 4 THEN strftime(d, '%-d %b %Y') WHEN k % 8 = 5 THEN strftime(d, '%b %-d, %Y')
               WHEN k % 8 = 6 THEN strftime(d, '%a, %d %b %Y') ELSE strftime(d, '%B %-d %Y') END AS start_date
        FROM t""",
    "every_marketing_rule": """
        WITH o AS (SELECT o_orderkey % 23 AS r, o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders),
        t AS (
          SELECT r, k, CASE WHEN r IN (1, 4) THEN NULL ELSE d END AS date,
            CASE WHEN r = 5 THEN 'Unknown' ELSE 'ch' || CAST(k % 5 AS VARCHAR) END AS channel,
            CASE WHEN r IN (2, 4) THEN '1,200' WHEN r = 3 THEN '-' || CAST(k AS VARCHAR) ELSE CAST(k AS VARCHAR) END AS spend,
            CASE WHEN r IN (1, 4) THEN 'bad_date' WHEN r = 2 THEN 'bad_spend' WHEN r = 3 THEN 'negative_spend' END AS reject_reason
          FROM o)
        SELECT date, channel, spend, TRY_CAST(spend AS DOUBLE) AS spend_num, reject_reason FROM t WHERE reject_reason IS NOT NULL
        UNION ALL
        SELECT (SELECT MIN(date) FROM t WHERE reject_reason IS NULL), channel, NULL, CAST(SUM(k) AS DOUBLE), NULL
        FROM t WHERE reject_reason IS NULL GROUP BY channel""",
    "every_time_layout": """
        SELECT event_id, CASE WHEN event_id % 31 IN (1, 2) THEN NULL ELSE date_trunc('second', ts)::TIMESTAMP END AS ts_utc,
          CASE WHEN event_id % 31 IN (1, 2) THEN NULL ELSE CAST(ts AS DATE) END AS day
        FROM events""",
    "event_facts": with_ctes("""
        SELECT 'fact_daily_active_users' AS fact, event_date, NULL AS user_id, CAST(daily_active_users AS DOUBLE) AS value FROM dau
        UNION ALL SELECT 'fact_daily_revenue_gross', event_date, NULL, revenue_gross FROM gross
        UNION ALL SELECT 'fact_daily_revenue_net', event_date, NULL, revenue_net FROM net
        UNION ALL SELECT 'fact_ltv_per_user', NULL, user_id, ltv FROM ltv"""),
    "published_order": with_ctes("""
        SELECT 'fact_cac_by_channel' AS table_name, row_number() OVER (ORDER BY total_spend DESC NULLS LAST, channel NULLS FIRST) AS position, channel AS row_text FROM cac
        UNION ALL SELECT 'fact_ltv_per_user', row_number() OVER (ORDER BY ltv DESC NULLS LAST, user_id), user_id FROM ltv
        UNION ALL SELECT 'fact_weekly_cohort_retention', row_number() OVER (ORDER BY cohort_week, week_index), concat_ws('|', cohort_week::VARCHAR, week_index::VARCHAR) FROM ret
        UNION ALL SELECT 'dim_channel', row_number() OVER (ORDER BY channel), channel FROM dim_channel
        UNION ALL SELECT 'dim_plan', row_number() OVER (ORDER BY plan_id NULLS FIRST, price, currency),
          concat_ws('|', plan_id, CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR), currency) FROM dim_plan
        UNION ALL SELECT 'dim_user', row_number() OVER (ORDER BY user_id), user_id FROM dim_user"""),
    "daily_active_users": with_ctes("SELECT * FROM dau"),
    "daily_revenue_gross": with_ctes("SELECT * FROM gross"),
    "daily_revenue_net": with_ctes("SELECT * FROM net"),
    "mrr_daily": with_ctes("SELECT * FROM mrr"),
    "weekly_cohort_retention": with_ctes("SELECT * FROM ret"),
    "cac_by_channel": with_ctes("SELECT * FROM cac"),
    "ltv_per_user": with_ctes("SELECT * FROM ltv"),
    "ltv_cac_ratio": with_ctes("SELECT * FROM ratio"),
    "dim_date": with_ctes("SELECT * FROM dim_date"),
    "dim_channel": with_ctes("SELECT * FROM dim_channel"),
    "dim_plan": with_ctes("SELECT * FROM dim_plan"),
    "dim_user": with_ctes("SELECT * FROM dim_user"),
    "vw_daily_kpis": with_ctes("""
        SELECT d.date, d.year, d.month, d.week_start_monday, u.daily_active_users, g.revenue_gross, n.revenue_net
        FROM dau u JOIN dim_date d ON d.date = u.event_date
        LEFT JOIN gross g ON g.event_date = u.event_date LEFT JOIN net n ON n.event_date = u.event_date"""),
    "vw_cac_by_channel": with_ctes("""
        SELECT c.channel, f.paid_conversions, f.total_spend, f.cac
        FROM cac f JOIN dim_channel c ON c.channel = f.channel"""),
    "vw_mrr_daily": with_ctes("""
        SELECT d.date, d.year, d.month, m.mrr FROM mrr m JOIN dim_date d ON d.date = m.date"""),
    "vw_user_ltv": with_ctes("""
        SELECT u.user_id, u.acquisition_channel, l.ltv FROM ltv l JOIN dim_user u ON u.user_id = l.user_id"""),
    "vw_weekly_retention": with_ctes(
        "SELECT cohort_week, week_index, cohort_size, active_users, retention_rate FROM ret"),
    "vw_ltv_cac_ratio": with_ctes(
        "SELECT total_ltv, total_spend, paid_conversions, cac_overall, ltv_cac_ratio FROM ratio"),
    "reject_split": """
        SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'low_priority'
                                WHEN o_totalprice > 300000 THEN 'large_order'
                                WHEN o_orderstatus = 'P' THEN 'pending' END AS reject_reason
        FROM orders""",
    "keep_latest": """
        SELECT user_id, event_id, ts FROM (
          SELECT user_id, event_id, ts,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
        WHERE rn = 1""",
    "overlap_flags": f"""
        WITH s AS ({_TYPED_SUBS}),
        l AS (SELECT *, LAG(COALESCE(end_date, DATE '2100-01-01')) OVER (
                PARTITION BY user_id ORDER BY start_date, created_at_ts DESC, subscription_id) AS prev_end_eff FROM s)
        SELECT subscription_id, prev_end_eff, CAST(datediff('day', prev_end_eff, start_date) - 1 AS INTEGER) AS gap_days,
          COALESCE(start_date <= prev_end_eff, false) AS is_overlap,
          COALESCE(datediff('day', prev_end_eff, start_date) - 1 > 0, false) AS reactivated
        FROM l""",
    "interval_sum_daily": f"""
        WITH s AS ({_TYPED_SUBS}),
        b AS (SELECT MIN(start_date) AS lo, GREATEST(COALESCE(MAX(end_date), MAX(start_date)), MAX(start_date)) AS hi FROM s),
        d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
        SELECT d.date, CAST(COALESCE(SUM(CAST(s.price AS DECIMAL(38,6))), 0) AS DOUBLE) AS total
        FROM d LEFT JOIN s ON s.start_date <= d.date AND (s.end_date IS NULL OR s.end_date >= d.date)
        GROUP BY d.date""",
    "calendar_fill": """
        WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority,
                          CAST(o_totalprice AS DECIMAL(38,6)) AS value FROM orders),
        b AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM o),
        d AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b),
        k AS (SELECT DISTINCT o_orderpriority FROM o),
        a AS (SELECT date, o_orderpriority, SUM(value) AS v FROM o GROUP BY 1, 2)
        SELECT d.date, k.o_orderpriority, CAST(COALESCE(a.v, 0) AS DOUBLE) AS value
        FROM d CROSS JOIN k LEFT JOIN a ON a.date = d.date AND a.o_orderpriority = k.o_orderpriority""",
    "first_channel_by_user": with_ctes("SELECT user_id_norm AS user_id, channel FROM sfirst"),
    "union_dates": """
        SELECT CAST(ts AS DATE) AS date FROM events WHERE ts IS NOT NULL
        UNION SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL""",
    "conditional_min": """
        SELECT o_custkey, MIN(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END) AS first_finished
        FROM orders GROUP BY o_custkey""",
    "scalar_functions": f"""
        SELECT event_id,
          CASE WHEN event_id % 4 = 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_clean,
          CASE WHEN event_id % 5 IN (0, 1) THEN NULL ELSE value END AS amount_num,
          ts AS ts_utc,
          CAST(date_trunc('week', ts) AS DATE) AS week_start,
          CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
          CAST(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(38,6))
                    ELSE -abs(CAST(value AS DECIMAL(38,6))) END AS DOUBLE) AS signed,
          CASE WHEN user_id % 3 = 0 THEN NULL ELSE value / CAST(user_id % 3 AS DOUBLE) END AS ratio
        FROM events""",
}
ORACLE.update({f"catalog_{name}": ORACLE[name] for name in views.VIEWS})
ORACLE["bronze_subscriptions_ndjson"] = ORACLE["bronze_subscriptions"]

# What a run reads: the adapters' rows and those that only the raw files hold (see
# raw_files): objects 'dup<id>', CSV rows without spend or with an odd channel.
_RUN_CTES = {
    "ev": CTES["ev"] + """
        UNION ALL SELECT 'dup' || CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), 'signup', ts, NULL, NULL FROM events WHERE event_id % 97 = 0""",
    "mraw": """
        WITH m AS (SELECT CAST(o_orderdate AS DATE) AS date, 'ch' || CAST(o_orderkey % 5 AS VARCHAR) AS channel,
                          CAST((o_totalprice - 5000) / 1000 AS DECIMAL(18,5)) AS spend5, o_orderkey FROM orders)
        SELECT * FROM m
        UNION ALL SELECT date, channel, NULL, o_orderkey FROM m WHERE o_orderkey % 331 = 0
        UNION ALL SELECT date, 'a "b", c' || chr(10) || 'd', spend5, o_orderkey FROM m WHERE o_orderkey % 307 = 0""",
}
_ZERO_REASONS = ("bad_created_at", "bad_price", "bad_start_date", "missing_subscription_id")


def _count(of: str) -> str:
    return f"(SELECT COUNT(*) FROM {of})"


def _metrics(**counts: str) -> str:
    """SQL of the audit's "name=value" text."""
    return " || ',' || ".join(f"'{n}=' || CAST({c} AS VARCHAR)" for n, c in sorted(counts.items())) or "''"


def _step(name: str, out: str, rejected: str = "0", metrics: str = "''") -> str:
    return f"SELECT '{name}' AS step, 'ok' AS status, {out} AS rows_out, {rejected} AS rows_rejected, {metrics} AS metrics"


_REJECTED_SUBS = "CAST((SELECT COUNT(*) FROM sflag WHERE is_overlap) + (SELECT COUNT(*) FROM sraw WHERE o_orderkey % 97 = 0) AS BIGINT)"
_FACT_COUNTS = {t: _count(c) for t, c in _FACT_CTES.items()}
_DIM_COUNTS = {t: _count(t) for t in catalog.DIM_TABLES}
ORACLE["pipeline_step_audit"] = with_ctes(
    " UNION ALL ".join(
        [
            _step(
                "bronze_events",
                _count("ev"),
                _count("events WHERE event_id % 83 = 0"),
                _metrics(invalid_json=_count("events WHERE event_id % 83 = 0"), not_one_object="0"),
            ),
            # The array file of subscriptions holds no malformed element.
            _step("bronze_subscriptions", _count(f"({ORACLE['bronze_subscriptions']})"), "0", _metrics(invalid_json="0", not_one_object="0")),
            _step(
                "bronze_marketing",
                _count("mraw"),
                _count("orders WHERE o_orderkey % 499 = 0"),
                _metrics(too_many_fields=_count("orders WHERE o_orderkey % 499 = 0"), unclosed_quote="0"),
            ),
            _step("silver_events", _count("ev"), "0", _metrics(bad_timestamp="0", missing_event_id="0")),
            _step(
                "silver_marketing",
                _count("mk"),
                _count("mraw WHERE spend5 IS NULL OR spend5 < 0"),
                _metrics(bad_date="0", bad_spend=_count("mraw WHERE spend5 IS NULL"), negative_spend=_count("mraw WHERE spend5 < 0")),
            ),
            _step(
                "silver_subscriptions",
                _count("sub"),
                _REJECTED_SUBS,
                _metrics(
                    **dict.fromkeys(_ZERO_REASONS, "0"),
                    missing_user_id=_count("sraw WHERE o_orderkey % 97 = 0"),
                    overlap=_count("sflag WHERE is_overlap"),
                    reactivated=_count("sub WHERE reactivated"),
                ),
            ),
            *[_step(f"gold_{t}", c) for t, c in _FACT_COUNTS.items()],
            _step("gold_load_facts", " + ".join(_FACT_COUNTS.values()), "0", _metrics(**_FACT_COUNTS)),
            _step("gold_build_dims", " + ".join(_DIM_COUNTS.values()), "0", _metrics(**_DIM_COUNTS)),
            _step("gold_build_views", str(len(views.VIEWS))),
        ]
    ),
    _RUN_CTES,
)

# The quarantine of a run over raw files with all defects. Lines of the events files
# are ordered by (id, kind); elements of the subscriptions' ones by (key, kind).
ORACLE["quarantine_rows"] = with_ctes(
    f"""
    SELECT 'events_bad_rows' AS table_name, 'invalid_json' AS reason,
      CAST(line_no AS VARCHAR) || '|' || {_BROKEN} AS row_text FROM qlines WHERE kind = 2
    UNION ALL
    SELECT 'events_rejected_silver', CASE kind WHEN 4 THEN 'bad_timestamp' ELSE 'missing_event_id' END,
      CASE kind WHEN 4 THEN 'late' || CAST(event_id AS VARCHAR) || '|-|10:00|'
                ELSE 'None|n' || CAST(event_id AS VARCHAR) || '|2024-01-01T00:00:00Z|' END || CAST(line_no AS VARCHAR)
    FROM qlines WHERE kind IN (4, 5)
    UNION ALL
    SELECT 'subscriptions_bad_rows', _error, CAST(_source_row_no AS VARCHAR) || '|' || _raw_line
    FROM ({ORACLE["bronze_subscriptions_array_bad_rows"]}) WHERE _error <> '{raw_files.ODD_PLAN}'
    UNION ALL SELECT 'marketing_bad_rows', _error, _raw_line FROM ({ORACLE["bronze_marketing_bad_rows"]})
    UNION ALL
    SELECT 'marketing_spend_rejected_silver', CASE WHEN spend5 IS NULL THEN 'bad_spend' ELSE 'negative_spend' END,
      CAST(date AS VARCHAR) || '|' || channel || '|' || coalesce(CAST(spend5 AS VARCHAR), '-')
    FROM mraw WHERE spend5 IS NULL OR spend5 < 0
    UNION ALL
    SELECT 'subscriptions_rejected_silver', 'overlap', concat_ws('|', subscription_id, user_id, CAST(start_date AS VARCHAR),
      coalesce(CAST(end_date AS VARCHAR), '-'), CAST(gap_days AS VARCHAR)) FROM sflag WHERE is_overlap
    UNION ALL
    SELECT 'subscriptions_rejected_silver', 'missing_user_id', concat_ws('|', 'x' || subscription_id, '-',
      CASE WHEN o_orderkey % 11 = 0 THEN replace(CAST(start_date AS VARCHAR), '-', '/') ELSE CAST(start_date AS VARCHAR) END,
      coalesce(CAST(end_date AS VARCHAR), '-'), '-') FROM sraw WHERE o_orderkey % 97 = 0
    UNION ALL
    SELECT 'subscriptions_rejected_silver', 'missing_user_id', 's' || subscription_id || '|-|-|-|-' FROM sraw WHERE o_orderkey % 73 = 0""",
    {
        **_RUN_CTES,
        "qlines": f"""
        SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id // {raw_files.KEYS_PER_FILE} ORDER BY event_id, kind) AS line_no
        FROM (SELECT event_id, unnest([0, 1, 2, 3, 4, 5]) AS kind FROM events) WHERE
          CASE kind WHEN 0 THEN event_id % 50 = 0 WHEN 1 THEN true WHEN 2 THEN event_id % 83 = 0 WHEN 3 THEN event_id % 97 = 0
                    WHEN 4 THEN event_id % 89 = 0 ELSE event_id % 71 = 0 END""",
    },
)
