import datetime as dt

import pytest
from pyspark.sql import functions as F

from subledger import registry
from subledger.plans import dims, gold, silver

from conftest import SF_SMALL

D = dt.date


def test_clean_events_rules_and_dedup(spark):
    rows = [
        ("1", "u", "login", "2024-01-05 10:00:00", "5", 1),
        ("1", "u", "login", "2024-01-05 11:00:00", "6", 2),  # later wins
        ("2", "u", "login", "2024-01-05 10:00:00Z", "1", 3),
        ("2", "u", "login", "2024-01-05 10:00:00", "2", 4),  # same time, higher line wins
        (None, "u", "login", "2024-01-05", "1", 5),
        ("  ", "u", "login", "2024-01-05", "1", 6),
        ("nan", "u", "login", "2024-01-05", "1", 7),
        ("3", "u", "login", "not-a-date", "1", 8),
        ("4", "u", "purchase", "2024-01-05 10:00:00+02:00", "n/a", 9),
    ]
    df = spark.createDataFrame(rows, "event_id string, user_id string, event_type string, timestamp string, amount string, _source_line_no long")
    good, bad = silver.clean_events(df)
    g = {r.event_id: r for r in good.collect()}
    assert g["1"].amount == "6" and g["2"]._source_line_no == 4
    assert g["4"].event_ts_utc == dt.datetime(2024, 1, 5, 8, 0) and g["4"].amount_num is None
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_timestamp"] + ["missing_event_id"] * 3


def test_clean_marketing_rules_and_grid(spark):
    rows = [("2024-01-01", "a", "1"), ("2024-01-03", " a ", "2"), ("2024-01-03", "b", "-1"), ("bad", "a", "1"),
            ("2024-01-02", "b", "x"), ("2024-01-02", None, "4")]
    good, bad = silver.clean_marketing(spark.createDataFrame(rows, "date string, channel string, spend string"))
    g = {(r.date.day, r.channel): r.spend for r in good.collect()}
    assert g == {(1, "a"): 1.0, (2, "a"): 0.0, (3, "a"): 2.0, (1, "Unknown"): 0.0, (2, "Unknown"): 4.0, (3, "Unknown"): 0.0}
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_date", "bad_spend", "negative_spend"]


def _subs(spark, rows):
    return spark.createDataFrame(
        rows, "subscription_id string, user_id string, price string, start_date string, end_date string, created_at string"
    )


def test_clean_subscriptions_overlaps_and_gaps(spark):
    rows = [
        ("A", "u1", "10", "2024-01-01", "2024-01-31", "2024-01-01"),
        ("B", "u1", "10", "2024-01-10", "2024-01-12", "2024-01-01"),  # overlaps A
        ("C", "u1", "10", "2024-01-20", "2024-01-25", "2024-01-01"),  # compared with B only: gap 7
        ("D", "u2", "10", "2024-01-01", "2024-01-10", "2024-01-01"),
        ("E", "u2", "10", "2024-01-10", "2024-01-15", "2024-01-01"),  # start = prev end: overlap
        ("F", "u3", "10", "2024-01-01", "2024-01-10", "2024-01-01"),
        ("G", "u3", "10", "2024-01-11", None, "2024-01-01"),  # gap 0
        ("H", "u3", "10", "2024-03-01", None, "2024-01-01"),  # prev open: overlap
        ("I", "u4", "10", "2024-01-01", "2024-01-10", "2024-01-01"),
        ("I", "u4", "20", "2024-01-01", "2024-01-10", "2024-01-02"),  # later version wins
        ("J", "u4", "10", "2024-01-13", None, "2024-01-01"),  # gap 2, reactivated
        ("K", "  ", "10", "2024-01-01", None, "2024-01-01"),
    ]
    good, bad = silver.clean_subscriptions(_subs(spark, rows))
    g = {r.subscription_id: r for r in good.collect()}
    assert set(g) == {"A", "C", "D", "F", "G", "I", "J"}
    assert g["C"].gap_days == 7 and g["C"].reactivated
    assert g["G"].gap_days == 0 and not g["G"].reactivated
    assert g["I"].price == 20.0 and g["J"].gap_days == 2 and g["J"].reactivated
    b = {r.subscription_id: r.reject_reason for r in bad.collect()}
    assert b == {"B": "overlap", "E": "overlap", "H": "overlap", "K": "missing_user_id"}


def _events(spark, rows):
    df = spark.createDataFrame(
        rows, "event_id string, user_id string, event_type string, event_ts_utc timestamp_ntz, amount_num double, acquisition_channel string"
    )
    return silver.normalize_events(df)


T = dt.datetime


def test_gold_metrics_on_dirty_rows(spark):
    ev = _events(
        spark,
        [
            ("1", "u1", "signup", T(2024, 1, 7, 23), None, "ads"),  # Sunday: cohort 2024-01-01
            ("2", "u2", "signup", T(2024, 1, 8, 0), None, None),  # Monday: cohort 2024-01-08, Unknown
            ("3", "u1", " Purchase ", T(2024, 1, 8, 1), 10.0, None),
            ("4", "u1", "refund", T(2024, 1, 8, 2), 5.0, None),
            ("5", "u1", "refund", T(2024, 1, 8, 3), -5.0, None),
            ("6", " NaN ", "purchase", T(2024, 1, 8, 4), 7.0, None),  # revenue only
            ("7", "u2", "login", T(2024, 1, 1, 4), None, None),  # before cohort week: dropped
            ("8", "u3", "purchase", T(2024, 1, 9, 4), None, None),  # no signup: Unknown, amount 0
        ],
    )
    dau = {r.event_date: r.daily_active_users for r in gold.daily_active_users(ev).collect()}
    assert dau == {D(2024, 1, 8): 1, D(2024, 1, 1): 1, D(2024, 1, 9): 1}
    net = {r.event_date: r.revenue_net for r in gold.daily_revenue_net(ev).collect()}
    assert net[D(2024, 1, 8)] == 7.0
    gross = {r.event_date: r.revenue_gross for r in gold.daily_revenue_gross(ev).collect()}
    assert gross[D(2024, 1, 8)] == 17.0
    ltv = {r.user_id: r.ltv for r in gold.ltv_per_user(ev).collect()}
    assert ltv == {"u1": 0.0, "u3": 0.0}
    ret = {(r.cohort_week, r.week_index): (r.active_users, r.cohort_size) for r in gold.weekly_cohort_retention(ev).collect()}
    assert ret == {(D(2024, 1, 1), 1): (1, 1)}
    mk = spark.createDataFrame([(D(2024, 1, 1), "ads", 30.0), (D(2024, 1, 1), "tv", 10.0), (D(2024, 1, 1), "Unknown", 4.0)],
                               "date date, channel string, spend double")
    cac = {r.channel: (r.total_spend, r.paid_conversions, r.cac) for r in gold.cac_by_channel(ev, mk).collect()}
    assert cac == {"ads": (30.0, 1, 30.0), "tv": (10.0, 0, None), "Unknown": (4.0, 1, 4.0)}
    ratio = gold.ltv_cac_ratio(gold.ltv_per_user(ev), mk, ev).first()
    assert (ratio.total_ltv, ratio.total_spend, ratio.paid_conversions, ratio.cac_overall) == (0.0, 44.0, 2, 22.0)


def test_ratio_without_buyers_is_null(spark):
    ev = _events(spark, [("1", "u1", "login", T(2024, 1, 1), None, None)])
    mk = spark.createDataFrame([(D(2024, 1, 1), "ads", 30.0)], "date date, channel string, spend double")
    r = gold.ltv_cac_ratio(gold.ltv_per_user(ev), mk, ev).first()
    assert r.paid_conversions == 0 and r.cac_overall is None and r.ltv_cac_ratio is None


def test_mrr_inclusive_ends_and_calendar(spark):
    subs = spark.createDataFrame(
        [(D(2024, 1, 1), D(2024, 1, 2), 10.0), (D(2024, 1, 2), None, 5.0), (D(2024, 1, 5), D(2024, 1, 3), 99.0)],
        "start_date date, end_date date, price double",
    )
    got = {r.date.day: r.mrr for r in gold.mrr_daily(subs).collect()}
    assert got == {1: 10.0, 2: 15.0, 3: 5.0, 4: 5.0, 5: 5.0}


def test_empty_inputs_give_empty_tables(spark):
    empty_subs = spark.createDataFrame([], "start_date date, end_date date, price double")
    assert gold.mrr_daily(empty_subs).count() == 0
    good, _ = silver.clean_marketing(spark.createDataFrame([("bad", "a", "1")], "date string, channel string, spend string"))
    assert good.count() == 0


def test_dim_user_raw_signup_min(spark):
    ev = spark.createDataFrame(
        [("u1", "signup", "b"), ("u1", "signup", "a"), ("u2", "login", "x"), ("None", "signup", "z"), (" ", "signup", "q")],
        "user_id string, event_type string, acquisition_channel string",
    )
    assert {r.user_id: r.acquisition_channel for r in dims.dim_user(ev).collect()} == {"u1": "a", "u2": None}


def test_dim_date_columns(spark):
    ev = spark.createDataFrame([(T(2024, 1, 7, 5),)], "event_ts_utc timestamp_ntz")
    mk = spark.createDataFrame([(D(2024, 1, 8),)], "date date")
    subs = spark.createDataFrame([(D(2024, 1, 8), None)], "start_date date, end_date date")
    rows = sorted(dims.dim_date(ev, mk, subs).collect())
    assert [(r.date, r.weekday, r.week_start_monday) for r in rows] == [
        (D(2024, 1, 7), 6, D(2024, 1, 1)),
        (D(2024, 1, 8), 0, D(2024, 1, 8)),
    ]


@pytest.mark.parametrize("names", [("fact_mrr_daily", "dim_date"), ("dim_date", "dim_channel", "dim_plan", "dim_user")])
def test_tables_of_one_query_share_the_silver_tables(spark, monkeypatch, names):
    made = []
    for name in ("clean_subscriptions", "clean_marketing"):
        clean = getattr(silver, name)
        monkeypatch.setattr(silver, name, lambda df, clean=clean, name=name: made.append(name) or clean(df))
    tables = registry._tables(spark, SF_SMALL, names)
    assert list(tables) == list(names) and sorted(made) == ["clean_marketing", "clean_subscriptions"]


def test_dim_date_reads_the_subscriptions_once(spark, tmp_dir):
    rows = [("2024-01-01", "2024-01-03"), ("2024-01-03", None), (None, "2024-02-01"), (None, None), ("2024-01-01", "2024-01-03")]
    spark.createDataFrame(rows, "s string, e string").select(F.col("s").cast("date").alias("start_date"), F.col("e").cast("date").alias("end_date")).write.parquet(f"{tmp_dir}/subs")
    events = spark.createDataFrame([], "event_ts_utc timestamp_ntz")
    found = dims.dim_date(events, spark.createDataFrame([], "date date"), spark.read.parquet(f"{tmp_dir}/subs"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    assert sorted(str(r.date) for r in found.collect()) == ["2024-01-01", "2024-01-03", "2024-02-01"]
