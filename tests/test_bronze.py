import csv
import io
import json
import os
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from subledger.sources import bronze, records
from subledger.sources.lines import numbered_lines


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_ndjson_good_bad_blank_and_line_numbers(spark, tmp_dir):
    lines = [
        '{"event_id":"1","user_id":"u1","event_type":"login","timestamp":"2024-01-01T00:00:00Z"}',
        "",
        "123",
        "null",
        "[1]",
        '"s"',
        '{"a":1} x',
        '{"a":1}{"b":2}',
        '{"a":1},{"b":2}',
        "{'a':1}",
        '{"a":1,}',
        '{"a":"x\ty"}',
        '{"event_id":"2","event_id":"3","custom":{"k":1}}',
        "   ",
        '{"event_id":"4"',
        "x" * 5000,
    ]
    p = _write(tmp_dir, "events.ndjson", "\n".join(lines) + "\n")
    good, bad = bronze.ingest_events(spark, p)
    g = {r.event_id: r for r in good.collect()}
    assert set(g) == {"1", "3"}
    assert g["1"]._source_line_no == 1 and g["3"]._source_line_no == 13
    assert g["3"].extras == {"custom": '{"k":1}'}
    b = {r._source_line_no: r for r in bad.collect()}
    assert sorted(b) == [3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 15, 16]
    assert len(b[16]._raw_line) == 5000 and len(b[16]._raw_head) == 3000


def test_line_numbers_across_splits_and_files(spark, tmp_dir):
    n = 20000
    _write(tmp_dir, "a.txt", "".join(f"{i}\n" for i in range(1, n + 1)))
    _write(tmp_dir, "b.txt", "".join(f"{i}\n" for i in range(1, 101)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = numbered_lines(spark, tmp_dir).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == n + 100
    assert all(int(r.value) == r._source_line_no for r in rows)


def test_csv_too_long_quarantined_short_kept(spark, tmp_dir):
    p = _write(tmp_dir, "m.csv", "date,channel,spend\n2024-01-01,a,1\n2024-01-02,b,2,extra\n2024-01-03,c\n")
    good, bad = bronze.ingest_marketing(spark, p)
    assert sorted((r.date, r.channel, r.spend) for r in good.collect()) == [
        ("2024-01-01", "a", "1"),
        ("2024-01-03", "c", None),
    ]
    assert [r._error for r in bad.collect()] == ["too_many_fields"]


def test_csv_quotes_and_line_ends(spark, tmp_dir):
    p = _write(tmp_dir, "m.csv", 'date,channel,spend\n2024-01-01,"a ""b"", c",5\n2024-01-02,"x\ny",6\n2024-01-03,"q, ""r""",7,extra\n')
    good, bad = bronze.ingest_marketing(spark, p)
    assert sorted((r.date, r.channel, r.spend) for r in good.collect()) == [("2024-01-01", 'a "b", c', "5"), ("2024-01-02", "x\ny", "6")]
    assert [(r.date, r.channel) for r in bad.collect()] == [("2024-01-03", 'q, "r"')]


def test_csv_with_another_header_fails_loudly(spark, tmp_dir):
    _write(tmp_dir, "a.csv", "date,channel,spend\n2024-01-01,a,1\n")
    p = _write(tmp_dir, "b.csv", "channel,date,spend\nb,2024-01-02,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        bronze.ingest_marketing(spark, p)[0].collect()


def test_json_array_all_text_and_order(spark, tmp_dir):
    p = _write(
        tmp_dir,
        "s.json",
        '[{"subscription_id": 1, "price": 9.5, "meta": {"a": 1}},\n {"subscription_id": "2", "user_id": null}]',
    )
    good, bad = bronze.ingest_subscriptions(spark, p)
    rows = good.orderBy("_source_row_no").collect()
    assert [r.subscription_id for r in rows] == ["1", "2"] and bad.count() == 0
    assert rows[0].price == "9.5" and rows[0].extras == {"meta": '{"a":1}'} and rows[1].user_id is None


def test_json_array_folder_loses_nothing(spark, tmp_dir):
    objects = ",".join(f'{{"subscription_id": "{i}"}}' for i in range(5))
    _write(tmp_dir, "good.json", f"[{objects}]")
    _write(tmp_dir, "mixed.json", f"[{objects.replace(chr(34) + '0' + chr(34), chr(34) + 'm' + chr(34))}, 7, null, [1]]")
    _write(tmp_dir, "empty.json", "[]")
    p = _write(tmp_dir, "cut.json", f"[{objects},")
    good, bad = bronze.ingest_subscriptions(spark, p)
    assert sorted(r.subscription_id for r in good.collect()) == sorted([*"01234", *"1234", "m"])
    rows = bad.collect()
    lost = [r for r in rows if r._source_file.endswith("cut.json")]
    assert len(lost) == 1 and lost[0]._error == "invalid_json" and lost[0]._raw_line.startswith('[{"subscription_id": "0"}')
    assert len([r for r in rows if r._source_file.endswith("mixed.json")]) == 3


def test_subscriptions_as_lines(spark, tmp_dir):
    p = _write(tmp_dir, "s.ndjson", '{"subscription_id": 1, "price": 2}\n\n{"subscription_id": "2"}\n{"cut"\n3\n')
    good, bad = bronze.ingest_subscriptions(spark, p, "ndjson")
    assert sorted((r.subscription_id, r._source_row_no) for r in good.collect()) == [("1", 1), ("2", 3)]
    assert sorted((r._source_row_no, r._raw_line) for r in bad.collect()) == [(4, '{"cut"'), (5, "3")]
    with pytest.raises(ValueError):
        bronze.ingest_subscriptions(spark, p, "xml")


# ------------------------------------------------------------------ large files


@contextmanager
def splits_of(spark, size):
    """Files are read in splits of so many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in old:
            spark.conf.set(k, str(size))
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


ODD = ['plain', 'a}"],[{\\b"', "}", '"', "\\", '\\"', "},{", "line\nend", "[", "é}ü", "", "x" * 300]


def _element(rng, i):
    kind = rng.random()
    if kind < 0.1:
        return rng.choice(["7", "null", "true", '"s}"', "[1, {\"a\": \"}\"}]", "-1.5e3"])
    fields = {"subscription_id": str(i), "plan_id": rng.choice(ODD)}
    if kind < 0.3:
        fields["meta"] = {"deep": [{"a": rng.choice(ODD)}, {"b": {}}], "n": i}
    return json.dumps(fields, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)


@pytest.mark.parametrize("size", [37, 200, 1000, 1 << 20])
def test_json_array_elements_over_any_splits(spark, tmp_dir, size):
    rng = random.Random(size)
    want, bad = {}, {}
    for name, n in (("a.json", 60), ("b.json", 1), ("empty.json", 0), ("c.json", 25)):
        texts = [_element(rng, f"{name}{i}") for i in range(n)]
        gap = lambda: rng.choice(["", " ", "\n", "\n  "])
        _write(tmp_dir, name, gap() + "[" + ",".join(gap() + t + gap() for t in texts) + "]" + gap())
        for i, t in enumerate(texts, 1):
            v = json.loads(t)
            (want if isinstance(v, dict) else bad)[name, i] = v
    _write(tmp_dir, "blank.json", " \n ")
    with splits_of(spark, size):
        good, quarantined = bronze.ingest_subscriptions(spark, tmp_dir)
        got = {(os.path.basename(r._source_file), r._source_row_no): r for r in good.collect()}
        lost = {(os.path.basename(r._source_file), r._source_row_no): r._raw_line for r in quarantined.collect()}
    assert set(got) == set(want) and set(lost) == set(bad)
    for k, v in want.items():
        assert (got[k].subscription_id, got[k].plan_id) == (v["subscription_id"], v["plan_id"])
        assert json.loads(got[k].extras.get("meta", "null")) == v.get("meta")


@pytest.mark.parametrize("size", [64, 1 << 20])
def test_json_array_files_that_are_none(spark, tmp_dir, size):
    objects = [json.dumps({"subscription_id": str(i), "plan_id": "p" * 40}) for i in range(6)]
    _write(tmp_dir, "cut.json", "[" + ",".join(objects) + ",")
    _write(tmp_dir, "in_string.json", "[" + ",".join(objects) + ', {"subscription_id": "9')
    _write(tmp_dir, "ends_early.json", "[" + ",".join(objects) + ", {}")
    _write(tmp_dir, "good.json", "[" + ",".join(objects) + "]")
    _write(tmp_dir, "gap.json", "[" + objects[0] + " " + objects[1] + "," + objects[2] + "]")
    _write(tmp_dir, "behind.json", "[" + objects[0] + "] x")
    with splits_of(spark, size):
        good, bad = bronze.ingest_subscriptions(spark, tmp_dir)
        got = sorted((os.path.basename(r._source_file), r.subscription_id) for r in good.collect())
        lost = {}
        for r in bad.collect():
            lost.setdefault(os.path.basename(r._source_file), []).append((r._source_row_no, r._raw_line))
    assert got == sorted([("good.json", str(i)) for i in range(6)] + [("gap.json", "0"), ("gap.json", "2"), ("behind.json", "0")])
    for name in ("cut.json", "in_string.json", "ends_early.json"):
        assert all(no == 0 for no, _ in lost[name])
        whole = open(f"{tmp_dir}/{name}", encoding="utf-8").read()
        assert sorted("".join(t for _, t in lost[name])) == sorted(whole)
    assert len(lost["gap.json"]) == 1 and lost["behind.json"] == [(2, "] x")]


def test_one_long_line_is_many_tasks(spark, tmp_dir):
    n = 20000
    _write(tmp_dir, "one.json", "[" + ",".join(json.dumps({"subscription_id": str(i), "plan_id": "}" * (i % 7)}) for i in range(n)) + "]")
    with splits_of(spark, 1 << 15):
        elements, lost = records.json_array_elements(spark, tmp_dir)
        assert lost.count() == 0
        places = elements.select("_source_row_no", F.get_json_object("_line", "$.subscription_id").cast("long").alias("i"))
        assert places.where("i + 1 <> _source_row_no").count() == 0 and places.count() == n
        pieces = records.scanned(spark, tmp_dir, "}").groupBy(F.spark_partition_id()).count()
        assert pieces.count() > 20 and pieces.agg(F.max("count") < F.sum("count") / 10).first()[0]


def _csv_text(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("size", [23, 100, 1 << 20])
def test_csv_records_over_any_splits(spark, tmp_dir, size):
    rng = random.Random(size)
    cells = ["a", 'say "hi"', "two\nlines", "x,y", '"', 'end"', "\n", 'a""b\n"c', "é\nü,", "plain text"]
    rows = [[f"2024-01-{i % 28 + 1:02d}", rng.choice(cells), str(i)] + (["more"] if i % 11 == 0 else []) for i in range(120)]
    _write(tmp_dir, "m.csv", _csv_text([["date", "channel", "spend"], *rows]))
    with splits_of(spark, size):
        good, bad = bronze.ingest_marketing(spark, tmp_dir)
        got = sorted((r.date, r.channel, r.spend) for r in good.collect())
        lost = sorted((r.date, r.channel, r.spend) for r in bad.collect())
    assert got == sorted(tuple(r) for r in rows if len(r) == 3)
    assert lost == sorted(tuple(r[:3]) for r in rows if len(r) == 4)


@pytest.mark.parametrize("size", [30, 1 << 20])
def test_csv_stray_quotes_and_unclosed_ends(spark, tmp_dir, size):
    body = 'date,channel,spend\r\n2024-01-01,5" pipe,1\r\n\r\n2024-01-02,"in ""quotes""\r\nhere",2\r\n2024-01-03,b,3\r\n2024-01-04,"never closed,4\r\n2024-01-05,c,5\r\n'
    _write(tmp_dir, "m.csv", body)
    with splits_of(spark, size):
        good, bad = bronze.ingest_marketing(spark, tmp_dir)
        got = sorted((r.date, r.channel, r.spend) for r in good.collect())
        lost = [(r._error, r._raw_line) for r in bad.collect()]
    assert got == [("2024-01-01", '5" pipe', "1"), ("2024-01-02", 'in "quotes"\nhere', "2"), ("2024-01-03", "b", "3")]
    assert {e for e, _ in lost} == {"unclosed_quote"} and "".join(sorted("".join(t for _, t in lost))).count("never") <= 1
    assert any("never closed" in t for _, t in lost)


def test_numbered_lines_have_no_shuffle(spark, tmp_dir):
    p = _write(tmp_dir, "e.ndjson", '{"event_id":"1"}\n' * 5000)
    with splits_of(spark, 1 << 14):
        df = bronze.event_outcomes(spark, p)
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
