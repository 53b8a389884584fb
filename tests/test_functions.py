import datetime as dt

from pyspark.sql import functions as F

from subledger.functions import timeparse
from subledger.functions import clean_text, parse_date, safe_ratio, to_number, to_utc_ntz, week_start, weekday_mon0


def _one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_to_utc_ntz_offsets_and_naive(spark):
    got = _one(
        spark,
        ["2024-01-05 10:00:00+02:00", "2024-01-05 10:00:00", "2024-01-05T10:00:00Z", "2024-01-05T10:00", "2024-01-05",
         "2024/01/05 10:00:00", "01/05/2024", " 2024-01-05 10:00:00.5-0500 "],
        to_utc_ntz,
    )
    assert got == [
        dt.datetime(2024, 1, 5, 8, 0),
        dt.datetime(2024, 1, 5, 10, 0),
        dt.datetime(2024, 1, 5, 10, 0),
        dt.datetime(2024, 1, 5, 10, 0),
        dt.datetime(2024, 1, 5, 0, 0),
        dt.datetime(2024, 1, 5, 10, 0),
        dt.datetime(2024, 1, 5, 0, 0),
        dt.datetime(2024, 1, 5, 15, 0, 0, 500000),
    ]


def test_to_utc_ntz_rejects_partial_and_invalid(spark):
    got = _one(spark, ["not-a-date", "2024-02-30", "5", "2024", "10:00", "", None, "nan"], to_utc_ntz)
    assert got == [None] * 8


def test_to_utc_ntz_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = _one(spark, ["2024-03-10 02:30:00", "2024-01-05 10:00:00+02:00"], to_utc_ntz)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 1, 5, 8, 0)]


def test_to_number(spark):
    got = _one(spark, ["12.50", " -3 ", "1e3", "n/a", "nan", "NaN", "1,200", "1d", "1f", "Infinity", "", None], to_number)
    assert got == [12.5, -3.0, 1000.0] + [None] * 9


def test_clean_text_null_tokens(spark):
    got = _one(spark, ["None", "nan", " NaN ", "", "<NA>", " 42\t", "x"], clean_text)
    assert got == [None, None, None, None, None, "42", "x"]


def test_parse_date_layouts(spark):
    got = _one(spark, ["2024-01-05", "2024/1/5", "01/05/2024", "2024-01-05T23:00:00Z", "bad", "2024-13-01"], parse_date)
    d = dt.date(2024, 1, 5)
    assert got == [d, d, d, d, None, None]


def test_week_start_and_weekday(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 7, 23, 0),), (dt.datetime(2024, 1, 8, 0, 0),)], "ts timestamp_ntz"
    )
    rows = df.select(week_start("ts").alias("w"), weekday_mon0(F.col("ts").cast("date")).alias("d")).collect()
    assert [(r.w, r.d) for r in rows] == [(dt.date(2024, 1, 1), 6), (dt.date(2024, 1, 8), 0)]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0), (3.0, 2), (1.0, None)], "a double, b int")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, 1.5, None]


def test_more_timestamp_layouts(spark):
    from datetime import datetime

    at = {
        "2024-01-05 10:00:00 UTC": (10, 0), "2024-01-05T10:00:00+05": (5, 0), "2024-01-05T10:00:00z": (10, 0),
        "2024-01-05 10:00:00 EST": (15, 0), "2024-01-05T10Z": (10, 0), "20240105T100000Z": (10, 0),
        "2024-01-05 10:00 PM": (22, 0), "Jan 5, 2024 10:00 AM": (10, 0), "Fri, 05 Jan 2024 10:00:00 GMT": (10, 0),
        "01-05-2024": (0, 0), "05 Jan 2024 12:30 am": (0, 30), "2024/01/05 7:05": (7, 5), "01/05/2024 10:00:00+02:00": (8, 0),
        "2024-01-05T10:00:00.5-03:30": (13, 30),
    }
    bad = ["10:00", "2024", "2024-01-05 junk", "Jan 2024", "13:00 PM", "2024-01-05 13:00 PM", "May flowers", ""]
    df = spark.createDataFrame([(x,) for x in [*at, *bad, "13/01/2024"]], "t string").select("t", timeparse.to_utc_ntz("t").alias("u"))
    got = {r.t: r.u for r in df.collect()}
    for text, (h, m) in at.items():
        assert got[text].replace(microsecond=0) == datetime(2024, 1, 5, h, m), text
    assert got["13/01/2024"] == datetime(2024, 1, 13) and all(got[x] is None for x in bad)


def test_dates_take_no_junk(spark):
    from datetime import date

    good = ["2024-01-05", "2024-1-5", "2024/01/05", "01/05/2024", "2024-01-05T10:00:00Z", "2024-01-05 10:00", "Jan 5, 2024"]
    bad = ["2024-01-05 junk", "2024-01-05Tjunk", "2024/01/05 xx", "2024-13-01", "5", None]
    df = spark.createDataFrame([(x,) for x in [*good, *bad]], "t string").select("t", timeparse.parse_date("t").alias("d"))
    got = {r.t: r.d for r in df.collect()}
    assert all(got[x] == date(2024, 1, 5) for x in good), got
    assert all(got[x] is None for x in bad), got
