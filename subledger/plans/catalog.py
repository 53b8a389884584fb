"""Catalog publication: external Parquet tables in a database, row counts.

A refresh writes its tables into a folder of its own, beside those of earlier
refreshes, and then points the catalog's tables to it, one ALTER TABLE each: a table
is never dropped, emptied or half written under its readers, and a refresh that fails
before the switch leaves all tables as they were. Folders that no table points to any
more are left to the lake's retention.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Published table names.
FACT_TABLES = (
    "fact_daily_active_users",
    "fact_daily_revenue_gross",
    "fact_daily_revenue_net",
    "fact_mrr_daily",
    "fact_weekly_cohort_retention",
    "fact_cac_by_channel",
    "fact_ltv_per_user",
    "fact_ltv_cac_ratio",
)
DIM_TABLES = ("dim_date", "dim_channel", "dim_plan", "dim_user")


def switch(spark: SparkSession, tables: Mapping[str, tuple[str, str]], db: str = "analytics") -> None:
    """Point the tables of ``db``, name -> (folder, columns as DDL), to written
    folders. A table that is new, or whose columns have changed, is created."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for name, (path, ddl) in tables.items():
        known = spark.catalog.tableExists(f"{db}.{name}")
        if known and columns(spark.table(f"{db}.{name}")) == ddl:
            spark.sql(f"ALTER TABLE {db}.{name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(f"{db}.{name}")
            continue
        if known:
            spark.sql(f"DROP TABLE {db}.{name}")
        spark.sql(f"CREATE TABLE {db}.{name} ({ddl}) USING parquet LOCATION '{path}'")


def columns(df: DataFrame) -> str:
    """The columns of a DataFrame as DDL."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def location(spark: SparkSession, table: str, db: str = "analytics") -> str:
    """The folder that a table points to."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, db: str = "analytics") -> None:
    """Write all tables into a new folder under ``root``, then point ``db`` to them."""
    folder = f"{root.rstrip('/')}/refresh={uuid.uuid4().hex}"
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
    switch(spark, {name: (f"{folder}/{name}", columns(df)) for name, df in tables.items()}, db)


def row_counts(spark: SparkSession, names, db: str = "analytics") -> DataFrame:
    """(table_name, row_count) for catalog tables, one SQL statement."""
    parts = [f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {db}.{n}" for n in names]
    return spark.sql(" UNION ALL ".join(parts))


def load_facts(spark: SparkSession, facts: Mapping[str, DataFrame], root: str, db: str = "analytics") -> DataFrame:
    """Publish the fact tables and return their row counts."""
    publish(spark, facts, root, db)
    return row_counts(spark, list(facts), db)


def dim_row_counts(spark: SparkSession, db: str = "analytics") -> DataFrame:
    """One row with the row count of every dimension (scalar subqueries)."""
    cols = ", ".join(f"(SELECT COUNT(*) FROM {db}.{d}) AS {d}_rows" for d in DIM_TABLES)
    return spark.sql(f"SELECT {cols}")
