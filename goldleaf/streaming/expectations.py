"""Append streams that check their rows and log, per micro-batch and rule, how many failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.quality import Expectation, apply_expectations
from goldleaf.streaming.sinks import BATCH_COL

METRICS = "rule string, action string, failed long, total long, kept long"


def write_checked(batch: DataFrame, batch_id: int, rules: Sequence[Expectation], path: str, metrics: str) -> None:
    """Write the rows of a batch that pass every drop rule, and the counts of all rules, each into the batch's own folder.

    The counts are taken from the rows as they are written, without another pass. Both folders are overwritten, so a replayed batch
    leaves the rows and counts of one run; rows come first, so counts never stand without their rows.
    """
    seen, kept = Observation(), Observation()
    passed = apply_expectations(batch, rules, seen)
    passed.observe(kept, F.count(F.lit(1)).alias("kept")).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH_COL}={batch_id}")
    counts, n_kept = seen.get, kept.get["kept"]
    rows = [(r.name, r.action, counts[r.name], counts["__rows"], n_kept) for r in rules]
    batch.sparkSession.createDataFrame(rows, METRICS).coalesce(1).write.mode("overwrite").parquet(f"{metrics.rstrip('/')}/{BATCH_COL}={batch_id}")


def append_checked(df: DataFrame, rules: Sequence[Expectation], path: str, metrics: str, checkpoint: str) -> int:
    """Append what a stream has brought since the last run, checked by ``rules``; the number of micro-batches run.

    Rules are stateless row predicates (a NULL outcome fails). Read the rows with ``spark.read.parquet(path)`` and the counts with ``expectation_log``.
    """
    ran = []

    def write(batch: DataFrame, batch_id: int) -> None:
        ran.append(batch_id)
        write_checked(batch, batch_id, rules, path, metrics)

    df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return len(ran)


def expectation_log(spark: SparkSession, metrics: str) -> DataFrame:
    """One row per micro-batch and rule: _batch_id, rule, action, failed, total, kept."""
    log = spark.read.schema(f"{METRICS}, {BATCH_COL} long").option("basePath", metrics).parquet(metrics)
    return log.select(BATCH_COL, "rule", "action", "failed", "total", "kept")
