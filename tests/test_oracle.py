"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from subledger import registry  # noqa: E402
from check_oracle import TABLES, key, norm  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    missing = set(registry.QUERIES) - set(registry.ORACLE)
    assert missing == {"pipeline_runs"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) & set(registry.ORACLE)))
def test_query_matches_oracle(spark, con, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
    rel = con.execute(registry.ORACLE[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=key)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "year", "month", "week_start_monday", "daily_active_users", "revenue_gross", "revenue_net"]
