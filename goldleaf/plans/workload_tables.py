"""Registered queries for nested schema evolution, published tables, refreshed views and logged expectations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators import gold
from goldleaf.operators.quality import Expectation, apply_expectations
from goldleaf.plans import tpch_mapping as m
from goldleaf.plans.workload import ORACLE, ROLLING, MappedLayers, _round_rolling, register, with_ctes
from goldleaf.plans.workload_silver import EVENT_CHANGES, EVENT_COLS, event_changes
from goldleaf.plans.workload_sources import bootstrap_documents
from goldleaf.plans.workload_streaming import ARRIVALS, _land_arrival
from goldleaf.session import scratch_path
from goldleaf.sources import files
from goldleaf.sources.landing import nest, write_json
from goldleaf.streaming import expectations, tables
from goldleaf.streaming.sinks import append_stream

# Rules of the element-summary feed.
ELEMENT_RULES = [Expectation("has_history", "history IS NOT NULL OR history_past IS NOT NULL", "warn"),
                 Expectation("has_element_id", "element_id IS NOT NULL", "drop")]


@register("nested_schema_evolution", (
    "SELECT c_custkey AS player_id, c_name AS web_name, CASE WHEN c_nationkey % 2 = 1 THEN c_mktsegment END AS news, "
    "CASE WHEN c_nationkey % 2 = 1 AND c_custkey % 3 > 0 THEN c_acctbal END AS form_now FROM customer"))
def q_nested_schema_evolution(spark, d):
    """Bootstrap documents in two pulls; in the second, players carry a new field and a new struct inside ``elements``. The schema is
    widened at that depth before the second run; rows of the first have NULL there."""
    root = scratch_path(spark, "nested-evolution")
    docs, landed, bronze = bootstrap_documents(spark, d), f"{root}/landing", f"{root}/bronze"
    extra = m.load(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("news"),
                                                F.when(F.col("c_custkey") % 3 > 0, F.struct(F.col("c_acctbal").alias("now"))).alias("form"))

    def run() -> T.StructType:
        schema = files.evolve_schema(spark, landed, f"{root}/_schemas")
        append_stream(files.stream_snapshots(spark, landed, schema), bronze, f"{root}/_checkpoint")
        return schema

    of_team = docs.withColumn("team", F.col("elements")[0]["team"] % 100)  # unknown teams are 100 above their nation
    write_json(of_team.where("team % 2 = 0").drop("team"), f"{landed}/pull=1")
    first = run()
    players = of_team.where("team % 2 = 1").withColumn("doc", F.monotonically_increasing_id())
    wide = players.select("doc", F.explode("elements").alias("e")).join(extra, F.col("e.id") == F.col("id"))
    wide = wide.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("e.*", "news", "form"))).alias("elements"))
    write_json(players.select("doc", "teams").join(wide, "doc").drop("doc"), f"{landed}/pull=2")
    second = run()
    if first["elements"].dataType == second["elements"].dataType:
        raise RuntimeError("the nested fields were not found")
    e = spark.read.schema(second).parquet(bronze).select(F.explode("elements").alias("e"))
    return e.select(F.col("e.id").alias("player_id"), "e.web_name", "e.news", F.col("e.form.now").alias("form_now"))


@register("scd1_bucket_merge", ORACLE["scd1_ignore_nulls"])
def q_scd1_bucket_merge(spark, d):
    """Changes land newest first in three runs -> stream -> drop rule -> per-column upsert that rewrites touched buckets of a published
    table; a batch that is delivered again changes nothing."""
    root = scratch_path(spark, "bucket-merge")
    changes = event_changes(spark, d)
    table = tables.BucketTable(spark, f"{root}/users", ("user_id",), n_buckets=16)
    rule = [Expectation("has_user", "user_id IS NOT NULL", "drop")]
    src = changes.withColumn("day", F.dayofmonth("ts"))
    for where, n in ARRIVALS:
        _land_arrival(src, f"{root}/landing", where, n)
        landed = apply_expectations(files.stream_snapshots(spark, f"{root}/landing", changes.schema), rule)
        tables.merge_stream(table, landed.select("user_id", *EVENT_COLS), ["user_id"], "ts", f"{root}/_checkpoint", ignore_null_updates=True)
    before = table.manifest()
    again = apply_expectations(changes, rule).select("user_id", *EVENT_COLS)
    if tables.merge_changes(table, again, ["user_id"], "ts", True, "stream", max(before.batches.values())).version != before.version:
        raise RuntimeError("a replayed batch was merged twice")
    return tables.current_rows(table).select("user_id", *EVENT_COLS)


@register("scd1_full_refresh", with_ctes(
    "SELECT user_id, arg_max(ts, ts) AS ts, arg_max(event_type, ts) AS event_type, arg_max(event_id, ts) AS event_id FROM ch WHERE event_type <> 'view' GROUP BY user_id",
    {"ch": EVENT_CHANGES}))
def q_scd1_full_refresh(spark, d):
    """A table and its checkpoint are built again from a corrected feed while the old ones stay live; a refresh that fails changes nothing."""
    root = scratch_path(spark, "full-refresh")
    changes = event_changes(spark, d).select("user_id", "ts", "event_type", "event_id")

    def table(folder: str) -> tables.BucketTable:
        return tables.BucketTable(spark, f"{folder}/users", ("user_id",), n_buckets=16)

    def builder(name: str, rows):
        write_json(rows, f"{root}/landing/{name}")

        def build(folder: str) -> None:
            feed = files.stream_snapshots(spark, f"{root}/landing/{name}", rows.schema).drop("_rescued_data")
            tables.merge_stream(table(folder), feed, ["user_id"], "ts", f"{folder}/_checkpoint")

        return build

    def broken(folder: str) -> None:
        builder("broken", changes.where("event_type = 'view'"))(folder)
        raise InterruptedError

    first = tables.replace_generation(spark, f"{root}/users", builder("first", changes))
    try:
        tables.replace_generation(spark, f"{root}/users", broken)
    except InterruptedError:
        pass
    if tables.live_generation(spark, f"{root}/users") != first:
        raise RuntimeError("a refresh that failed replaced the table")
    tables.replace_generation(spark, f"{root}/users", builder("corrected", changes.where("event_type <> 'view'")))
    return tables.current_rows(table(tables.live_generation(spark, f"{root}/users"))).select("user_id", "ts", "event_type", "event_id")


_FORM_COLUMNS = ["player_name", "match_id", "kickoff_time"]


@register("view_incremental_refresh", ORACLE["rolling_form"])
def q_view_incremental_refresh(spark, d):
    """Rolling form as a stored view over a published table of matches. Late matches of some players arrive, and only the buckets
    of these players are recomputed; the view equals a full run."""
    root = scratch_path(spark, "incremental-view")
    matches = MappedLayers(spark, d).combined_table()
    base = tables.BucketTable(spark, f"{root}/matches", ("player_name",), n_buckets=32)
    view = tables.BucketTable(spark, f"{root}/form", ("player_name",), n_buckets=32)
    late = F.pmod(F.xxhash64("player_name"), F.lit(32)) < 4
    keys = ["player_name", "data_source", "match_id"]

    def arrive(part, batch: int) -> None:
        tables.merge_changes(base, part.withColumn("__at", F.lit(batch)), keys, "__at", source="matches", batch_id=batch)

    def form(rows):
        f = gold.add_form_and_value(rows.drop("__at", "__seq"), window=5)
        return f.select(*_FORM_COLUMNS, *ROLLING)

    arrive(matches.where(~late | (F.col("match_id") % 2 == 0)), 0)
    tables.refresh_view(view, base, form)
    arrive(matches.where(late & (F.col("match_id") % 2 != 0)), 1)
    if len(tables.refresh_view(view, base, form)) > 4:
        raise RuntimeError("buckets without late matches were recomputed")
    return _round_rolling(view.read())


def element_summaries(spark, d):
    """Element-summary documents, one per customer: ``history`` holds this season's orders, ``history_past`` earlier ones (NULL without any)."""
    o = m.load(spark, d, "orders").select(F.col("o_custkey").alias("element_id"), F.col("o_orderkey").alias("fixture"),
                                          F.col("o_totalprice").alias("value"), (F.col("o_orderdate") >= F.lit(m.SEASON_START).cast("timestamp_ntz")).alias("now"))
    docs = m.load(spark, d, "customer").select(F.col("c_custkey").alias("element_id"))
    docs = nest(docs, o.where("now").drop("now"), ["element_id"], "history", order_by=["fixture"])
    return nest(docs, o.where("NOT now").drop("now"), ["element_id"], "history_past", order_by=["fixture"])


_ELEMENT_LOG = """
WITH e AS (SELECT CAST(c_custkey % 3 AS BIGINT) AS _batch_id, c_custkey,
  CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE c_custkey END AS element_id FROM customer),
s AS (SELECT _batch_id, element_id, count(o_orderkey) > 0 AS has FROM e LEFT JOIN orders ON o_custkey = c_custkey GROUP BY _batch_id, c_custkey, element_id),
t AS (SELECT _batch_id, count(*) AS total, count(element_id) AS kept, CAST(count_if(NOT has) AS BIGINT) AS no_history FROM s GROUP BY _batch_id)
SELECT _batch_id, 'has_history' AS rule, 'warn' AS action, no_history AS failed, total, kept FROM t
UNION ALL SELECT _batch_id, 'has_element_id', 'drop', total - kept, total, kept FROM t
"""


@register("stream_expectation_log", _ELEMENT_LOG)
def q_stream_expectation_log(spark, d):
    """B1/B2 on a stream: element summaries in three runs, one warn and one drop rule, counted per micro-batch as the rows are written; the last
    batch is delivered twice and still counts once."""
    root = scratch_path(spark, "expectation-log")
    docs = element_summaries(spark, d).withColumn("part", F.col("element_id") % 3)
    docs = docs.withColumn("element_id", F.when(F.col("element_id") % 10 != 9, F.col("element_id")))
    schema = docs.drop("part").schema
    paths = f"{root}/bronze/element_data", f"{root}/bronze/_expectations/element_data"
    for n in range(3):
        write_json(docs.where(F.col("part") == n).drop("part"), f"{root}/landing/pull={n}")
        stream = files.with_lineage(files.stream_snapshots(spark, f"{root}/landing", schema))
        expectations.append_checked(stream, ELEMENT_RULES, *paths, f"{root}/_checkpoint")
    again = files.with_lineage(files.read_snapshots(spark, f"{root}/landing/pull=2", "json", schema))
    expectations.write_checked(again, 2, ELEMENT_RULES, *paths)
    log = expectations.expectation_log(spark, paths[1])
    if spark.read.parquet(paths[0]).count() != log.where("rule = 'has_history'").agg(F.sum("kept")).first()[0]:
        raise RuntimeError("the stored rows are not those that were counted")
    return log
