"""End-to-end run from raw files; idempotence; session-zone independence."""

import os

import pytest
from pyspark.sql import functions as F

from subledger.plans import catalog, gold
from subledger.plans.lake import read_in_order, read_outcome, table_path
from subledger.plans.pipeline import Pipeline, run_all
from subledger.sources.raw_files import write_raw_inputs

from conftest import SF_SMALL


def _tables(spark, out, db="analytics"):
    stored = {n: sorted(spark.read.parquet(table_path(out, n)).collect()) for n in ("events_clean", "subscriptions_clean", "marketing_spend_clean")}
    facts = ("fact_daily_active_users", "fact_mrr_daily", "fact_cac_by_channel", "fact_ltv_cac_ratio", "dim_user")
    return stored | {n: sorted(spark.table(f"{db}.{n}").collect()) for n in facts}


def test_pipeline_runs_idempotent_and_zone_free(spark, tmp_dir):
    raw = write_raw_inputs(spark, SF_SMALL, f"{tmp_dir}/raw", keys_per_file=400)
    audit = run_all(spark, raw, f"{tmp_dir}/lake").collect()
    assert all(r.status == "ok" for r in audit) and len(audit) == 17
    first = _tables(spark, f"{tmp_dir}/lake")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        run_all(spark, raw, f"{tmp_dir}/lake")
        second = _tables(spark, f"{tmp_dir}/lake")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert first == second
    views = {r.viewName for r in spark.sql("SHOW VIEWS IN analytics").collect()}
    assert {"vw_daily_kpis", "vw_mrr_daily", "vw_user_ltv"} <= views
    assert spark.sql("SELECT COUNT(*) FROM analytics.vw_daily_kpis").first()[0] > 0


def test_a_failed_step_is_on_disk(spark, tmp_dir):
    raw = write_raw_inputs(spark, SF_SMALL, f"{tmp_dir}/raw")
    raw["subscriptions"] = f"{tmp_dir}/nowhere"
    with pytest.raises(Exception):
        run_all(spark, raw, f"{tmp_dir}/lake", "failing")
    rows = spark.read.parquet(f"{tmp_dir}/lake/pipeline_runs").collect()
    assert [(r.step, r.status) for r in sorted(rows, key=lambda r: r.started_at)] == [("bronze_events", "ok"), ("bronze_subscriptions", "failed")]


def test_a_failing_run_leaves_the_former_tables(spark, tmp_dir, monkeypatch):
    raw = write_raw_inputs(spark, SF_SMALL, f"{tmp_dir}/raw")
    run_all(spark, raw, f"{tmp_dir}/lake", "refreshed")
    names = (*catalog.FACT_TABLES, *catalog.DIM_TABLES)
    before = {n: (catalog.location(spark, n, "refreshed"), sorted(spark.table(f"refreshed.{n}").collect())) for n in names}

    def fail(*_):
        raise RuntimeError("no dimensions today")

    with monkeypatch.context() as m:
        m.setattr(Pipeline, "_dims", fail)
        with pytest.raises(RuntimeError):
            Pipeline(spark, raw, f"{tmp_dir}/lake", "refreshed").refresh_published()
    assert {n: (catalog.location(spark, n, "refreshed"), sorted(spark.table(f"refreshed.{n}").collect())) for n in names} == before
    Pipeline(spark, raw, f"{tmp_dir}/lake", "refreshed").refresh_published()
    after = {n: (catalog.location(spark, n, "refreshed"), sorted(spark.table(f"refreshed.{n}").collect())) for n in names}
    assert all(after[n][0] != before[n][0] and after[n][1] == before[n][1] for n in names)


def test_publish_follows_changed_columns(spark, tmp_dir):
    catalog.publish(spark, {"t": spark.range(3).toDF("a")}, tmp_dir, "changing")
    catalog.publish(spark, {"t": spark.range(5).toDF("a")}, tmp_dir, "changing")
    assert spark.table("changing.t").count() == 5
    catalog.publish(spark, {"t": spark.range(2).selectExpr("id AS a", "'x' AS b")}, tmp_dir, "changing")
    assert sorted(map(tuple, spark.table("changing.t").collect())) == [(0, "x"), (1, "x")]


def test_an_empty_outcome_is_on_disk(spark, tmp_dir):
    raw = write_raw_inputs(spark, SF_SMALL, f"{tmp_dir}/raw")
    run = Pipeline(spark, raw, f"{tmp_dir}/lake")
    assert run.bronze_events().rows_rejected > 0 and run.silver_events().rows_rejected == 0
    rejected = read_outcome(spark, run.root, "events_rejected_silver")
    assert rejected.count() == 0 and "reject_reason" in rejected.columns


def _files_read(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan")


def test_event_facts_are_the_single_facts_from_one_scan(spark, tmp_dir):
    rows = [("a", "login", 1), ("a", "login", 1), (None, "purchase", 1), ("b", "purchase", 2), ("b", "refund", 2), ("c", "signup", 3), (None, "login", 4), ("d", "refund", None)]
    events = spark.createDataFrame(rows, "user_id_norm string, event_type_norm string, d int").select(
        "*", F.expr("timestamp_ntz'2024-01-01 10:00:00' + make_dt_interval(d)").alias("event_ts_utc"), F.lit(2.5).alias("amount_num")
    )
    events.write.parquet(f"{tmp_dir}/events")
    events = spark.read.parquet(f"{tmp_dir}/events")
    facts = gold.event_facts(events)
    assert _files_read(facts) == 1
    single = {
        "fact_daily_active_users": gold.daily_active_users(events),
        "fact_daily_revenue_gross": gold.daily_revenue_gross(events),
        "fact_daily_revenue_net": gold.daily_revenue_net(events),
        "fact_ltv_per_user": gold.ltv_per_user(events),
    }
    key = lambda r: str(tuple(r))
    for name, df in single.items():
        got = facts.where(F.col("_outcome") == name).select(*gold.EVENT_FACTS[name])
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, df.select(*gold.EVENT_FACTS[name]).collect()), key=key)


def test_files_in_name_order_are_the_published_order(spark, tmp_dir):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    try:
        for k in old:
            spark.conf.set(k, "false")
        users = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("user_id"), (F.col("id") * 7919 % 400).cast("double").alias("ltv"))
        gold.presentation_order("fact_ltv_per_user", users).write.option("maxRecordsPerFile", 300).parquet(f"{tmp_dir}/ltv")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    read = read_in_order(spark, f"{tmp_dir}/ltv")
    want = sorted(users.collect(), key=lambda r: (-r.ltv, r.user_id))
    assert [r.user_id for r in sorted(read.collect(), key=lambda r: r.position)] == [r.user_id for r in want]
    assert sum(f.endswith(".parquet") for f in os.listdir(f"{tmp_dir}/ltv")) > 10
