"""Reporting views, each described once.

A description names the base table, the tables joined to it and the columns
shown; the DataFrame form and the catalog view are both built from it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """A table joined to the base: on ``base_key = key``; optional ones keep
    base rows that find nothing."""

    table: str
    base_key: str
    key: str
    optional: bool = False


@dataclass(frozen=True)
class View:
    base: str
    columns: tuple[tuple[str, str], ...]  # (table, column) in output order
    lookups: tuple[Lookup, ...] = ()

    def tables(self) -> tuple[str, ...]:
        """Names of the tables that the view reads."""
        return (self.base, *(x.table for x in self.lookups))

    def frame(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The view over the given tables."""
        out = tables[self.base].alias(self.base)
        for x in self.lookups:
            on = f"{self.base}.{x.base_key} = {x.table}.{x.key}"
            out = out.join(tables[x.table].alias(x.table), F.expr(on), "left" if x.optional else "inner")
        return out.select(*[f"{t}.{c}" for t, c in self.columns])

    def statement(self, db: str) -> str:
        """The same as a SELECT over the tables of a database."""
        shown = ", ".join(f"{t}.{c}" for t, c in self.columns)
        joins = "".join(
            f" {'LEFT' if x.optional else 'INNER'} JOIN {db}.{x.table} ON {self.base}.{x.base_key} = {x.table}.{x.key}"
            for x in self.lookups
        )
        return f"SELECT {shown} FROM {db}.{self.base}{joins}"


def _of(table: str, *columns: str) -> tuple[tuple[str, str], ...]:
    return tuple((table, c) for c in columns)


# View, table and column names.
VIEWS: dict[str, View] = {
    "vw_daily_kpis": View(
        "fact_daily_active_users",
        _of("dim_date", "date", "year", "month", "week_start_monday")
        + _of("fact_daily_active_users", "daily_active_users")
        + _of("fact_daily_revenue_gross", "revenue_gross")
        + _of("fact_daily_revenue_net", "revenue_net"),
        (
            Lookup("dim_date", "event_date", "date"),
            Lookup("fact_daily_revenue_gross", "event_date", "event_date", optional=True),
            Lookup("fact_daily_revenue_net", "event_date", "event_date", optional=True),
        ),
    ),
    "vw_cac_by_channel": View(
        "fact_cac_by_channel",
        _of("dim_channel", "channel") + _of("fact_cac_by_channel", "paid_conversions", "total_spend", "cac"),
        (Lookup("dim_channel", "channel", "channel"),),
    ),
    "vw_mrr_daily": View(
        "fact_mrr_daily",
        _of("dim_date", "date", "year", "month") + _of("fact_mrr_daily", "mrr"),
        (Lookup("dim_date", "date", "date"),),
    ),
    "vw_user_ltv": View(
        "fact_ltv_per_user",
        _of("dim_user", "user_id", "acquisition_channel") + _of("fact_ltv_per_user", "ltv"),
        (Lookup("dim_user", "user_id", "user_id"),),
    ),
    "vw_weekly_retention": View(
        "fact_weekly_cohort_retention",
        _of("fact_weekly_cohort_retention", "cohort_week", "week_index", "cohort_size", "active_users", "retention_rate"),
    ),
    "vw_ltv_cac_ratio": View(
        "fact_ltv_cac_ratio",
        _of("fact_ltv_cac_ratio", "total_ltv", "total_spend", "paid_conversions", "cac_overall", "ltv_cac_ratio"),
    ),
}


def create_views(spark: SparkSession, db: str = "analytics") -> list[str]:
    """CREATE OR REPLACE VIEW for every reporting view; returns the names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, view in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {view.statement(db)}")
    return list(VIEWS)
