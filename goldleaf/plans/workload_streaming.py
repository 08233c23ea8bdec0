"""Registered queries for the streaming paths and the hot-key window path."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldleaf.operators import gold
from goldleaf.plans import tpch_mapping as m
from goldleaf.plans.workload import ORACLE, ROLLING, MappedLayers, _round_rolling, register
from goldleaf.plans.workload_silver import EVENT_COLS, event_changes
from goldleaf.operators.quality import Expectation, apply_expectations
from goldleaf.session import scratch_path
from goldleaf.sources import files
from goldleaf.sources.landing import write_json
from goldleaf.streaming.sinks import append_stream, scd1_compact, scd1_stream, scd1_target

# Arrival order of the landing batches: newest days first, so later runs carry older sequences.
ARRIVALS = [("day >= 20", 0), ("day >= 10 AND day < 20", 1), ("day < 10 OR day IS NULL", 2)]


def _land_arrival(df, root: str, where: str, n: int) -> None:
    write_json(df.where(F.expr(where)).drop("day"), f"{root}/arrival={n:02d}")


@register("stream_bronze_append", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_bronze_append(spark, d):
    """JSON files landing in three runs, each run appends only the new files
    (availableNow, progress in the checkpoint); a fourth run with nothing new adds nothing."""
    root = scratch_path(spark, "bronze-stream")
    ev = m.load(spark, d, "events")
    src = ev.withColumn("day", F.dayofmonth("ts"))
    out, ckpt = f"{root}/bronze/events", f"{root}/_checkpoints/events"
    batches = 0
    for where, n in ARRIVALS:
        _land_arrival(src, f"{root}/landing/events", where, n)
        stream = files.with_lineage(files.stream_snapshots(spark, f"{root}/landing/events", ev.schema))
        batches += append_stream(stream, out, ckpt)
    stream = files.with_lineage(files.stream_snapshots(spark, f"{root}/landing/events", ev.schema))
    if append_stream(stream, out, ckpt) != 0 or batches != len(ARRIVALS):
        raise RuntimeError("append stream re-read old files or skipped a run")
    return spark.read.parquet(out).select(*ev.columns)


@register("stream_schema_evolution", (
    "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS segment FROM customer"))
def q_stream_schema_evolution(spark, d):
    """Three files in two runs, a new field from the second file on; the schema is widened before each run,
    older rows are NULL in the new column, a restart adds nothing."""
    root = scratch_path(spark, "evolving-stream")
    c = m.load(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    landed, out = f"{root}/landing", f"{root}/bronze"

    def run() -> int:
        schema = files.evolve_schema(spark, landed, f"{root}/_schemas")
        return append_stream(files.stream_snapshots(spark, landed, schema), out, f"{root}/_checkpoint")

    write_json(c.where("id % 3 = 0").select("id", "name"), f"{landed}/pull=1")
    first = run()
    write_json(c.where("id % 3 = 1"), f"{landed}/pull=2")
    write_json(c.where("id % 3 = 2"), f"{landed}/pull=3")
    if not first or not run() or run():
        raise RuntimeError("a run missed new files or read old ones again")
    return spark.read.schema(files.evolve_schema(spark, landed, f"{root}/_schemas")).parquet(out).select("id", "name", "segment")


@register("scd1_stream_upsert", ORACLE["scd1_ignore_nulls"])
def q_scd1_stream_upsert(spark, d):
    """Landing -> bronze append stream -> stream read of the bronze table
    -> drop rule -> per-column SCD-1 upsert as a stateful stream. Batches arrive newest first
    over three incremental runs, with a compaction after the second; the target still equals
    the order-free result."""
    root = scratch_path(spark, "cdc-stream")
    ch = event_changes(spark, d)
    src = ch.withColumn("day", F.dayofmonth("ts"))
    bronze, bronze_ckpt = f"{root}/bronze/changes", f"{root}/_checkpoints/bronze"
    path, ckpt = f"{root}/silver/users", f"{root}/_checkpoints/users"
    for where, n in ARRIVALS:
        # landing JSON -> bronze table (append stream with lineage)
        _land_arrival(src, f"{root}/landing/changes", where, n)
        landed = files.with_lineage(files.stream_snapshots(spark, f"{root}/landing/changes", ch.schema))
        append_stream(landed, bronze, bronze_ckpt)
        # bronze table -> rule -> keyed upsert (stream read of a table, stateless filter, state)
        changes = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
        kept = apply_expectations(changes, [Expectation("has_user", "user_id IS NOT NULL", "drop")])
        scd1_stream(kept.select("user_id", *EVENT_COLS), ["user_id"], "ts", path, ckpt, ignore_null_updates=True)
        if n == 1:  # compact after the second run: the last read is snapshot + newer batches
            scd1_compact(spark, path, ["user_id"])
    return scd1_target(spark, path, ["user_id"]).select("user_id", *EVENT_COLS)


@register("rolling_form_skew_split", ORACLE["rolling_form"])
def q_rolling_form_skew_split(spark, d):
    """W1 through the hot-key path: every player above 8 rows is range-split and evaluated in
    buckets of 4 rows with halos (same result as the plain window)."""
    f = gold.add_form_and_value(MappedLayers(spark, d).combined_table(), window=5, hot_rows=8, bucket_rows=4)
    return _round_rolling(f.select("player_name", "match_id", "kickoff_time", *ROLLING))
