import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from subledger.operators import (
    calendar_fill,
    interval_sum_daily,
    keep_latest,
    prev_in_order,
    prev_in_ranges,
    tag_rejects,
)


@pytest.mark.parametrize("bucket", [None, "tens"])
def test_prev_in_order_matches_window_under_skew(spark, bucket):
    random.seed(7)
    rows = [("hot" if random.random() < 0.4 else random.choice([None, *map(str, range(30))]), random.choice([None, *range(500)]), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "u string, s int, id int")
    tens = F.floor(F.col("s") / 10) if bucket else None
    got = prev_in_order(df, ["u"], [F.col("s"), F.col("id")], ["id"], bucket=tens)
    want = df.withColumn("prev_id", F.lag("id").over(Window.partitionBy("u").orderBy("s", "id")))
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_prev_in_order_one_group_and_one_bucket(spark):
    df = spark.createDataFrame([("hot", i) for i in range(4000)], "u string, i int")
    for bucket in (F.col("i"), F.lit(1), F.floor(F.col("i") / 100)):
        rows = {r.i: r.prev_i for r in prev_in_order(df, ["u"], [F.col("i")], ["i"], bucket=bucket).collect()}
        assert rows[0] is None and all(rows[i] == i - 1 for i in range(1, 4000))


def test_building_the_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "none expected")
    try:
        prev_in_order(spark.range(10).withColumn("u", F.lit(1)), ["u"], [F.col("id")], ["id"])
        assert len(tracker.getJobIdsForGroup("building")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_prev_in_ranges_splits_a_hot_user_and_day(spark):
    random.seed(11)
    hot = [("hot", 7, None if i % 3 else 5, i) for i in range(4000)]
    rest = [(random.choice([None, "hot", *map(str, range(20))]), random.choice([None, *range(40)]), random.choice([None, 1, 2]), 10000 + i) for i in range(4000)]
    df = spark.createDataFrame(hot + rest, "u string, s int, c int, id int").withColumn("seq", F.lit(1))
    order = [F.col("s"), -F.col("c"), F.col("id")]
    got = prev_in_ranges(df, ["u"], order, ["id", "c"])
    over = Window.partitionBy("u").orderBy(*order)
    want = df.withColumn("prev_id", F.lag("id").over(over)).withColumn("prev_c", F.lag("c").over(over))
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # Each range has its share of the rows: the hot day is dealt out over several.
    ranged = df.withColumn("k", F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).repartitionByRange(8, "u", "k")
    sizes = ranged.where("u = 'hot' AND s = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 2500
    assert prev_in_ranges(df.limit(0), ["u"], order, ["id"]).count() == 0


def _scans(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.find("== Initial Plan ==")].count("FileScan") or plan.count("FileScan")


def test_keep_latest(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 5, 4)], "k string, ts int, line int")
    got = keep_latest(df, ["k"], [F.desc("ts"), F.desc("line")]).orderBy("k").collect()
    assert [(r.k, r.line) for r in got] == [("a", 3), ("b", 4)]


def test_tag_rejects_first_rule_wins(spark):
    df = spark.createDataFrame([(None, -1), (1, -1), (1, 1)], "a int, b int")
    tagged = tag_rejects(df, [("no_a", F.col("a").isNull()), ("neg_b", F.col("b") < 0)])
    assert sorted(r.reject_reason or "" for r in tagged.collect()) == ["", "neg_b", "no_a"]


def test_calendar_fill(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "a", 1.0), (dt.date(2024, 1, 1), "a", 2.0), (dt.date(2024, 1, 3), "b", 5.0)],
        "date date, ch string, v double",
    )
    got = {(r.date.day, r.ch): r.v for r in calendar_fill(df, "date", ["ch"], "v", 0.0).collect()}
    assert got == {(1, "a"): 3.0, (2, "a"): 0.0, (3, "a"): 0.0, (1, "b"): 0.0, (2, "b"): 0.0, (3, "b"): 5.0}


def test_interval_sum_daily_brute_force(spark):
    random.seed(3)
    base = dt.date(2024, 1, 1)
    subs = []
    for _ in range(300):
        s = base + dt.timedelta(days=random.randint(0, 120))
        e = None if random.random() < 0.1 else s + dt.timedelta(days=random.randint(-5, 60))
        subs.append((s, e, round(random.uniform(1, 100), 2)))
    df = spark.createDataFrame(subs, "s date, e date, p double")
    got = {r.date: r.total for r in interval_sum_daily(df, "s", "e", "p").collect()}
    lo = min(s for s, _, _ in subs)
    hi = max([e for _, e, _ in subs if e] + [s for s, _, _ in subs])
    assert set(got) == {lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)}
    for d, v in got.items():
        want = sum(round(p * 100) for s, e, p in subs if s <= d and (e is None or e >= d)) / 100
        assert abs(v - want) < 1e-6


def test_one_scan_of_the_input(spark, tmp_dir):
    path = f"{tmp_dir}/subs"
    spark.range(1000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("s"),
        F.date_add(F.lit("2024-02-01").cast("date"), (F.col("id") % 60).cast("int")).alias("e"),
        (F.col("id") % 5).cast("string").alias("k"),
        F.col("id").cast("double").alias("p"),
    ).write.parquet(path)
    df = spark.read.parquet(path)
    assert _scans(interval_sum_daily(df, "s", "e", "p")) == 1
    assert _scans(calendar_fill(df, "s", ["k"], "p", 0.0)) == 1


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "s date, e date, k string, p double")
    assert interval_sum_daily(empty, "s", "e", "p").count() == 0
    assert calendar_fill(empty, "s", ["k"], "p", 0.0).count() == 0
    assert prev_in_order(empty, ["k"], [F.col("s")], ["p"]).count() == 0
