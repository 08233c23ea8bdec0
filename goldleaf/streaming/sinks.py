"""Structured Streaming sinks: append-only bronze tables, the one-time backfill, and the
incremental SCD-1 upsert.

All of them are triggered (``availableNow``), not continuous: each call processes what
has arrived since the last run and stops, which is how the layered tables are refreshed.
Progress and operator state live in the checkpoint, so a restart after a lost executor
(or a lost driver) resumes without re-adding rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from goldleaf.operators import cdc
from goldleaf.sources import shared_files

BATCH_COL = "_batch_id"


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Id of the last micro-batch that the checkpoint has committed; -1 before the first."""
    return max((int(n) for n in shared_files.names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def _drained(start: Callable[[], StreamingQuery], spark: SparkSession, checkpoint: str) -> int:
    """Run an availableNow query to its end; the number of micro-batches it ran, however many (none without new input)."""
    before = _last_batch(spark, checkpoint)
    start().awaitTermination()
    return _last_batch(spark, checkpoint) - before


def append_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                  partition_by: Sequence[str] | None = None) -> int:
    """Append every new input row to ``path`` and stop when the input is drained.

    Returns the number of micro-batches run (none without new input).
    """
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _drained(lambda: w.trigger(availableNow=True).start(path), df.sparkSession, checkpoint)


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Materialized-view sink: recompute ``df`` in full, replace the stored table, read it back.

    Downstream views then read the stored columns (with pruning and pushdown) instead of
    recomputing the defining plan; it also cuts the lineage for long pipelines.
    """
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).limit(1).collect()
        return True
    except AnalysisException:
        return False


def backfill_once(spark: SparkSession, name: str, df: DataFrame, target: str, marker: str) -> bool:
    """One-time append flow: run ``df`` into ``target`` once, never again.

    Rows go to ``target/flow=<name>`` with overwrite, so a run interrupted before the
    completion marker is written simply repeats without duplicating anything. Returns
    True when the flow ran, False when the marker shows it already completed.
    """
    if _exists(spark, marker):
        return False
    df.write.mode("overwrite").parquet(f"{target.rstrip('/')}/flow={name}")
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.mode("overwrite").text(marker)
    return True


def scd1_stream(changes: DataFrame, keys: Sequence[str], sequence_by, path: str, checkpoint: str,
                ignore_null_updates: bool = False) -> int:
    """Incremental SCD-1 over a change stream.

    A streaming aggregation keyed by ``keys`` keeps, per key, the winning value(s) and their
    sequences in the state store (per column when NULLs are ignored, which is what keeps
    out-of-order input exact). Each micro-batch emits the keys it changed (update mode);
    ``foreachBatch`` writes them to ``path/log/_batch_id=<n>`` with overwrite, so a replayed
    batch rewrites the same folder (idempotent). Read the table with ``scd1_target``; bound
    the read cost with ``scd1_compact``.
    """
    state = cdc.reduce_state(cdc.to_state(changes, keys, sequence_by, ignore_null_updates), keys,
                             ignore_null_updates)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/log/{BATCH_COL}={batch_id}")

    w = (state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True))
    return _drained(w.start, changes.sparkSession, checkpoint)


def _partition_values(spark: SparkSession, path: str, name: str) -> list[int]:
    """Values of an integer partition column, from the file listing only (no data is read)."""
    try:
        files = spark.read.parquet(path).inputFiles()
    except AnalysisException:
        return []
    found = set()
    for f in files:
        for part in f.split("/"):
            if part.startswith(f"{name}="):
                found.add(int(part.split("=", 1)[1]))
    return sorted(found)


def _latest_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest compacted snapshot plus the log batches written after it, tagged by batch id."""
    base = path.rstrip("/")
    snaps = _partition_values(spark, f"{base}/snapshots", "through")
    batches = _partition_values(spark, f"{base}/log", BATCH_COL)
    through = snaps[-1] if snaps else None
    parts = []
    if through is not None:
        snap = spark.read.parquet(f"{base}/snapshots").where(F.col("through") == through)
        parts.append(snap.drop("through").withColumn(BATCH_COL, F.lit(through)))
    if any(through is None or b > through for b in batches):
        log = cdc.current(spark.read.parquet(f"{base}/log"))  # values only, sequences dropped
        parts.append(log if through is None else log.where(F.col(BATCH_COL) > through))
    if not parts:
        return None
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def scd1_target(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current SCD-1 table: for each key, its row from the newest batch that touched it.

    Reads the newest snapshot and only the log batches after it (partition pruning), so the
    cost follows the size of the table plus the recent changes, not the whole history.
    """
    rows = _latest_rows(spark, path)
    if rows is None:
        raise FileNotFoundError(f"no SCD-1 data under {path}")
    values = [c for c in rows.columns if c not in keys and c != BATCH_COL]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in values]), F.col(BATCH_COL)).alias("__r"))
    return cdc.current(latest.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in values]))


def scd1_compact(spark: SparkSession, path: str, keys: Sequence[str]) -> int | None:
    """Write the current table as snapshot ``through=<last batch>``; returns that batch id, or
    None when there is nothing new. Reads afterwards skip every folder the snapshot covers.

    A batch that lands while compacting is either in the snapshot or read again from the log:
    the newest batch id wins in ``scd1_target``, so both cases give the same table. Older
    folders are left in place for a retention job.
    """
    base = path.rstrip("/")
    batches = _partition_values(spark, f"{base}/log", BATCH_COL)
    snaps = _partition_values(spark, f"{base}/snapshots", "through")
    if not batches or (snaps and snaps[-1] >= batches[-1]):
        return None
    through = batches[-1]
    current = scd1_target(spark, path, keys)
    current.write.mode("overwrite").parquet(f"{base}/snapshots/through={through}")
    return through
