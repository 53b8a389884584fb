"""Session helpers: the shared scratch folder and test sessions.

Intermediate files (derived raw inputs, lineage cuts) go under the folder the
cluster names in ``spark.checkpoint.dir``. Only when the session has none (as in
local tests) do we set one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder. Where the session names none, a local session
    (one process, one disk) gets a folder of its own; a cluster is an error."""
    root = spark.conf.get(_CKPT_KEY, None)
    sc = None
    try:
        sc = spark.sparkContext
        if not root:
            current = sc._jsc.sc().getCheckpointDir()
            root = current.get() if current.isDefined() else None
    except Exception:  # noqa: BLE001  (no JVM context, e.g. a remote session)
        sc = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local[") and master != "local":
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="subledger-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    if sc is not None and sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/subledger/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the scratch folder: its lineage ends there, a lost
    executor re-reads the files, and the planner knows its true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark (no UI, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("subledger")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
