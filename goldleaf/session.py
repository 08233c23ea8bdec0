"""Session helpers: building a session for tests/bench and locating shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "goldleaf", cpus: int | str = "*", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs. On a cluster the deployment supplies its own session."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GOLDLEAF_DRIVER_MEMORY", "8g"))
        # No per-call Python call-site capture: it costs JVM round trips for every column function.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """All instants are interpreted in UTC (file stamps and kickoff times are UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def compiled_methods(spark: SparkSession):
    """Stages run inside whose generated method exceeds the 8000 bytes that the JVM compiles go operator by operator; such a
    method, as of a wide projection, would be interpreted."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Where nothing is configured, a session in one process (local tests) gets a temporary folder; on a
    cluster that folder would exist on one machine only, so there it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="goldleaf-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root for one job's files."""
    return f"{checkpoint_root(spark)}/goldleaf/{name}-{uuid.uuid4().hex[:12]}"
