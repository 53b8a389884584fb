"""End-to-end full-refresh run: raw files -> bronze -> silver -> gold ->
catalog tables, dimensions and views, with a per-step audit.

Every step reads its inputs from the previous layer's Parquet and records what it
wrote through observations on the writes themselves (no second scan): rows written,
rows rejected, and its metrics, such as rejects by reason. A step that tells good rows
from rejected ones writes both with one job. Bronze and silver are overwritten
(idempotent); facts and dimensions go to a folder of the run, and the catalog's tables
are pointed to it when all are written, so a run that fails leaves the former ones
readable. The run stops at the first failing step after recording it.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger import schemas
from subledger.plans import catalog, dims, gold, silver, views
from subledger.plans.lake import FOLDERS, OUTCOME, read_outcome, write_counted, write_outcomes
from subledger.sources import bronze

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("step", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
    ]
)


class Result:
    """What a step has to report."""

    def __init__(self, rows_out: int = 0, rows_rejected: int = 0, metrics: Mapping[str, int] | None = None):
        self.rows_out, self.rows_rejected, self.metrics = rows_out, rows_rejected, dict(metrics or {})


def _reasons(column: str, names) -> dict[str, Column]:
    return {n: F.count_if(F.col(column) == n) for n in names}


class Pipeline:
    """One run over ``raw`` inputs (paths of the events NDJSON, subscriptions
    JSON and marketing CSV) into ``out_dir``/{bronze,silver,gold}."""

    def __init__(self, spark: SparkSession, raw: dict[str, str], out_dir: str, db: str = "analytics", subscriptions_layout: str = "array"):
        self.spark, self.raw, self.db, self.layout = spark, raw, db, subscriptions_layout
        self.root = out_dir.rstrip("/")
        self.run_id = uuid.uuid4().hex
        self.gold = f"{self.root}/gold/run={self.run_id}"
        self.audit: list[tuple] = []
        self.rows: dict[str, int] = {}  # rows of the facts and dimensions written so far

    # -- helpers
    def _step(self, names: str | list[str], fn: Callable[[], Result | dict[str, Result]]) -> None:
        """Run a step, or several that share one job, and record each."""
        names = [names] if isinstance(names, str) else names
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        t0 = time.perf_counter()
        try:
            found = fn()
        except Exception:
            self.audit += [(self.run_id, n, "failed", started, time.perf_counter() - t0, None, None, None) for n in names]
            raise
        took = round(time.perf_counter() - t0, 3)
        for n in names:
            r = found if isinstance(found, Result) else found[n]
            self.audit.append((self.run_id, n, "ok", started, took, r.rows_out, r.rows_rejected, r.metrics))

    def _write(self, df: DataFrame, good: str, bad: str, metrics: Mapping[str, Column]) -> Result:
        found = write_outcomes(df, f"{self.root}/{FOLDERS[good]}", (good, bad), metrics)
        return Result(found.pop(good), found.pop(bad), found)

    # -- bronze
    def bronze_events(self) -> Result:
        df = bronze.event_outcomes(self.spark, self.raw["events"])
        return self._write(df, bronze.EVENTS_GOOD, bronze.EVENTS_BAD, _reasons("_error", ("invalid_json", "not_one_object")))

    def bronze_subscriptions(self) -> Result:
        df = bronze.subscription_outcomes(self.spark, self.raw["subscriptions"], self.layout)
        return self._write(df, bronze.SUBSCRIPTIONS_GOOD, bronze.SUBSCRIPTIONS_BAD, _reasons("_error", ("invalid_json", "not_one_object")))

    def bronze_marketing(self) -> Result:
        df = bronze.marketing_outcomes(self.spark, self.raw["marketing"])
        return self._write(df, bronze.MARKETING_GOOD, bronze.MARKETING_BAD, _reasons("_error", ("too_many_fields", "unclosed_quote")))

    # -- silver
    def silver_events(self) -> Result:
        df = silver.event_outcomes(read_outcome(self.spark, self.root, bronze.EVENTS_GOOD))
        return self._write(df, silver.EVENTS_GOOD, silver.EVENTS_REJECTED, _reasons(silver.REASON, silver.EVENT_REASONS))

    def silver_marketing(self) -> Result:
        df = silver.marketing_outcomes(read_outcome(self.spark, self.root, bronze.MARKETING_GOOD))
        return self._write(df, silver.MARKETING_GOOD, silver.MARKETING_REJECTED, _reasons(silver.REASON, silver.MARKETING_REASONS))

    def silver_subscriptions(self) -> Result:
        df = silver.subscription_outcomes(read_outcome(self.spark, self.root, bronze.SUBSCRIPTIONS_GOOD))
        reactivated = {"reactivated": F.count_if((F.col(OUTCOME) == silver.SUBSCRIPTIONS_GOOD) & F.col("reactivated"))}
        reasons = _reasons(silver.REASON, (*silver.SUBSCRIPTION_REASONS, silver.OVERLAP))
        return self._write(df, silver.SUBSCRIPTIONS_GOOD, silver.SUBSCRIPTIONS_REJECTED, {**reasons, **reactivated})

    # -- gold
    def _events(self) -> DataFrame:
        return silver.rows_of(read_outcome(self.spark, self.root, silver.EVENTS_GOOD), silver.EVENTS_GOOD, schemas.EVENTS_CLEAN)

    def _marketing(self) -> DataFrame:
        return silver.rows_of(read_outcome(self.spark, self.root, silver.MARKETING_GOOD), silver.MARKETING_GOOD, schemas.MARKETING_CLEAN)

    def _subscriptions(self) -> DataFrame:
        return silver.rows_of(read_outcome(self.spark, self.root, silver.SUBSCRIPTIONS_GOOD), silver.SUBSCRIPTIONS_GOOD, schemas.SUBSCRIPTIONS_CLEAN)

    def _table_path(self, name: str) -> str:
        return f"{self.gold}/event_facts/{OUTCOME}={name}" if name in gold.EVENT_FACTS else f"{self.gold}/{name}"

    def _table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self._table_path(name))
        return df.select(*gold.EVENT_FACTS[name]) if name in gold.EVENT_FACTS else df

    def _publishable(self, name: str, df: DataFrame, metrics: Mapping[str, Column] | None = None) -> Result:
        found = write_counted(gold.presentation_order(name, df), self._table_path(name), metrics)
        self.rows[name] = found.pop("rows")
        return Result(self.rows[name], 0, found)

    def event_facts(self) -> dict[str, Result]:
        """Four facts from one scan of the events."""
        ordered = gold.event_facts_order(gold.event_facts(self._events()))
        found = write_outcomes(ordered, f"{self.gold}/event_facts", list(gold.EVENT_FACTS))
        self.rows |= found
        return {f"gold_{n}": Result(found[n]) for n in gold.EVENT_FACTS}

    def _dims(self) -> Result:
        ev, mk, subs = self._events(), self._marketing(), self._subscriptions()
        made = {"dim_date": dims.dim_date(ev, mk, subs), "dim_channel": dims.dim_channel(mk), "dim_plan": dims.dim_plan(subs), "dim_user": dims.dim_user(ev)}
        counts = {name: self._publishable(name, df).rows_out for name, df in made.items()}
        return Result(sum(counts.values()), 0, counts)

    def _load(self) -> Result:
        """Everything is written: point the catalog to this run."""
        names = (*catalog.FACT_TABLES, *catalog.DIM_TABLES)
        catalog.switch(self.spark, {n: (self._table_path(n), catalog.columns(self._table(n))) for n in names}, self.db)
        facts = {n: self.rows[n] for n in catalog.FACT_TABLES}
        return Result(sum(facts.values()), 0, facts)

    # -- run
    def run_all(self) -> DataFrame:
        """All steps in order; the audit is written whether or not one fails."""
        try:
            self._steps()
        finally:
            audit = self.spark.createDataFrame(self.audit, AUDIT_SCHEMA)
            audit.write.mode("append").parquet(f"{self.root}/pipeline_runs")
        return audit

    def _steps(self) -> None:
        self.refresh_inputs()
        self.refresh_published()

    def refresh_inputs(self) -> None:
        """Bronze and silver from the raw files."""
        for layer in (self.bronze_events, self.bronze_subscriptions, self.bronze_marketing, self.silver_events, self.silver_marketing, self.silver_subscriptions):
            self._step(layer.__name__, layer)

    def refresh_published(self) -> None:
        """Facts, dimensions and views from the silver tables as they are."""
        self._step([f"gold_{n}" for n in gold.EVENT_FACTS], self.event_facts)
        facts: dict[str, Callable[[], DataFrame]] = {
            "fact_mrr_daily": lambda: gold.mrr_daily(self._subscriptions()),
            "fact_weekly_cohort_retention": lambda: gold.weekly_cohort_retention(self._events()),
            "fact_cac_by_channel": lambda: gold.cac_by_channel(self._events(), self._marketing()),
            "fact_ltv_cac_ratio": lambda: gold.ltv_cac_ratio(self._table("fact_ltv_per_user"), self._marketing(), self._events()),
        }
        for name, make in facts.items():
            self._step(f"gold_{name}", lambda name=name, make=make: self._publishable(name, make()))
        self._step("gold_build_dims", self._dims)
        self._step("gold_load_facts", self._load)
        self._step("gold_build_views", lambda: Result(len(views.create_views(self.spark, self.db))))


def run_all(spark: SparkSession, raw: dict[str, str], out_dir: str, db: str = "analytics", subscriptions_layout: str = "array") -> DataFrame:
    """Run the whole pipeline; returns this run's audit rows (also appended to
    ``pipeline_runs``, with the failed step when one fails). ``subscriptions_layout``
    is "array" or "ndjson"."""
    return Pipeline(spark, raw, out_dir, db, subscriptions_layout).run_all()
