"""Registered queries for the bronze sources: snapshot files written from the test tables
and read back through the library readers (files go to a fresh folder under the
session's checkpoint directory on every call)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.functions.scalars import snapshot_stamp
from goldleaf.operators import silver
from goldleaf.operators.quality import Expectation, apply_expectations
from goldleaf.plans import tpch_mapping as m
from goldleaf.plans.workload import register, with_ctes
from goldleaf.session import compiled_methods, scratch_path
from goldleaf.sources import files, landing
from goldleaf.streaming.sinks import backfill_once

PULL_STAMP = "2001-05-01T080000Z"  # the landing stamp of the generated snapshot
ELEMENTS_PER_DOC = 1000  # bound on the array length of one bootstrap document
FIXTURES_PER_FILE = 20_000  # bound on the array length of one fixtures file

# Rules of the bootstrap and fixture feeds.
BOOTSTRAP_RULES = [Expectation("has_elements", "elements IS NOT NULL", "drop"),
                   Expectation("has_teams", "teams IS NOT NULL", "drop")]
FIXTURE_RULES = [Expectation("has_fixture_id", "id IS NOT NULL", "drop")]


def bootstrap_documents(spark, d):
    """Bootstrap-static documents: per (team, block of 1000 player ids) the players and their team."""
    c = m.load(spark, d, "customer")
    elems = c.select(
        F.col("c_nationkey").alias("doc_team"),
        (F.col("c_custkey") / F.lit(ELEMENTS_PER_DOC)).cast("long").alias("doc_block"),
        F.struct(
            F.col("c_custkey").alias("id"), F.expr(m.FIRST_NAME).alias("first_name"),
            F.expr(m.SECOND_NAME).alias("second_name"), F.expr(dict(m.PLAYER)["team_id"]).alias("team"),
            F.expr(m.POSITION_ID).alias("element_type"), F.expr(dict(m.PLAYER)["current_price"]).alias("now_cost"),
            F.col("c_name").alias("web_name")).alias("e"))
    docs = elems.groupBy("doc_team", "doc_block").agg(F.sort_array(F.collect_list("e")).alias("elements"))
    teams = m.load(spark, d, "nation").select(
        F.col("n_nationkey").alias("doc_team"),
        F.array(F.struct(*[F.expr(e).alias(n if n != "team_id" else "id") for n, e in m.TEAM])).alias("teams"))
    return docs.join(teams, "doc_team", "left").select("elements", F.coalesce("teams", F.array().cast(teams.schema["teams"].dataType)).alias("teams"))


@register("ingest_json_snapshot", with_ctes(
    "SELECT player_id, first_name, second_name, team_id, position_id, current_price, web_name, "
    f"'{PULL_STAMP}' AS pulled FROM s_player"))
def q_ingest_json_snapshot(spark, d):
    """Stamped JSON snapshot -> schema inferred once -> batch read with lineage
    -> bronze drop rules -> exploded, typed players."""
    root = scratch_path(spark, "bootstrap")
    land = landing.write_snapshot(bootstrap_documents(spark, d), f"{root}/landing", "bootstrap-static", PULL_STAMP)
    schema = files.infer_once(spark, land, f"{root}/_schemas/bootstrap")
    bronze = apply_expectations(files.with_lineage(files.read_snapshots(spark, land, "json", schema)), BOOTSTRAP_RULES)
    players = silver.players(bronze.select("elements", "teams", "_source_file", "_ingestion_timestamp"))
    return players.select(
        *[c for c in players.columns if not c.startswith("_")],
        F.regexp_extract("_source_file", r"bootstrap-static_([0-9-]+T[0-9]+Z)", 1).alias("pulled"))


def fixture_rows(spark, d):
    """Fixture payload rows (API field names, ISO kickoff text)."""
    o = m.load(spark, d, "orders")
    f = dict(m.FIXTURE)
    return o.select(
        F.col("o_orderkey").alias("id"), F.expr(f["gameweek"]).alias("event"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("kickoff_time"),
        F.expr(f["home_team_id"]).alias("team_h"), F.expr(f["away_team_id"]).alias("team_a"),
        F.expr(f["home_score"]).alias("team_h_score"), F.expr(f["away_score"]).alias("team_a_score"),
        F.expr(f["home_difficulty"]).alias("team_h_difficulty"),
        F.expr(f["away_difficulty"]).alias("team_a_difficulty"),
        F.expr(f["finished"]).alias("finished"))


@register("ingest_json_array", with_ctes("SELECT * FROM s_fixture"))
def q_ingest_json_array(spark, d):
    """A2/A3: JSON arrays at the root of each file, read with multiLine, typed by the silver view."""
    root = scratch_path(spark, "fixtures")
    path = landing.write_json_arrays(fixture_rows(spark, d), f"{root}/landing/fixtures", FIXTURES_PER_FILE)
    raw = files.read_snapshots(spark, path, "json", multiline=True)
    bronze = apply_expectations(files.with_lineage(raw), FIXTURE_RULES)
    fx = silver.fixtures(bronze)
    return fx.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "kickoff_time" else F.col(c)
                       for c in fx.columns if not c.startswith("_")])


@register("ingest_csv_backfill", with_ctes(
    "SELECT * EXCLUDE (data_source) FROM s_hist"))
def q_ingest_csv_backfill(spark, d):
    """Season-partitioned CSV, seasons with different headers -> matched by
    name -> one-time backfill into bronze with a rescue column (a second call is a no-op) -> season
    from the path -> typed, ruled, SCD-1 historical rows."""
    root = scratch_path(spark, "historical")
    raw = m.historical_raw(spark, d).withColumn(
        "kickoff_time", F.date_format("kickoff_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    target, marker = f"{root}/bronze/historical_raw", f"{root}/_flows/history_backfill.done"
    with compiled_methods(spark):
        raw.write.parquet(f"{root}/rows")  # joined once for both kinds of headers
        src = _land_seasons(spark.read.schema(raw.schema).parquet(f"{root}/rows"), root)
        bronze_schema = T.StructType([f for f in raw.schema.fields if f.name != "season"])
        reader = files.season_from_path(files.read_csv_by_name(spark, src, _as_read(bronze_schema)))
        ran_first = backfill_once(spark, "history_backfill", reader, target, marker)
        ran_again = backfill_once(spark, "history_backfill", reader, target, marker)
    if not ran_first or ran_again:
        raise RuntimeError("one-time backfill did not run exactly once")
    bronze = spark.read.parquet(target)
    hist = m.silver_historical(spark, d, raw=bronze)
    return hist.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c == "kickoff_time" else F.col(c)
                         for c in hist.columns if c not in ("data_source", "_ingestion_timestamp", "_source_file")])


def _as_read(schema: T.StructType) -> T.StructType:
    """The types that values have as CSV text is cast: instants stay text until silver."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def _land_seasons(raw, root: str) -> str:
    """Seasons as CSV folders; every second season has its columns in another order and two more of them."""
    odd = F.col("season").substr(4, 1).cast("int") % 2 == 1
    landing.write_seasons(raw.where(~odd | odd.isNull()), f"{root}/landing")
    mixed = raw.where(odd).select("was_home", "round", F.lit("x").alias("fixture_note"), *[
        c for c in reversed(raw.columns) if c not in ("was_home", "round", "season")], F.length("team").alias("team_chars"), "season")
    mixed.write.mode("append").option("header", True).partitionBy("season").csv(f"{root}/landing/historical")
    return f"{root}/landing/historical"


@register("ingest_csv_mixed_headers", (
    "SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN NULL "
    "ELSE c_acctbal END AS balance, CASE WHEN c_custkey % 2 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN "
    "'{\"balance\":\"n/a\",\"segment\":\"' || c_mktsegment || '\"}' ELSE '{\"segment\":\"' || c_mktsegment || '\"}' END AS _rescued_data FROM customer"))
def q_ingest_csv_mixed_headers(spark, d):
    """Folders whose headers differ in order and columns are matched by name; what does not
    fit the schema is rescued."""
    root = scratch_path(spark, "mixed")
    c = m.load(spark, d, "customer")
    plain = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    wide = c.where("c_custkey % 2 = 1").select(
        F.when(F.col("c_custkey") % 3 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"))
    plain.write.option("header", True).csv(f"{root}/season=2001-02")
    wide.write.option("header", True).csv(f"{root}/season=2002-03")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("balance", T.DoubleType())])
    return files.read_csv_by_name(spark, root, schema).select("id", "name", "balance", "_rescued_data")


@register("rescue_malformed", (
    "SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 5 = 0 THEN "
    "'{\"user_id\": ' || user_id || ', ' ELSE NULL END AS _rescued_data FROM events"))
def q_rescue_malformed(spark, d):
    """A broken JSON text is kept whole in the rescue column."""
    ev = m.load(spark, d, "events")
    good = F.to_json(F.struct("user_id"))
    broken = F.concat(F.lit('{"user_id": '), F.col("user_id").cast("string"), F.lit(", "))
    raw = ev.select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 5 == 0, broken).otherwise(good).alias("raw"))
    return files.rescue(raw, "raw", T.StructType([T.StructField("user_id", T.LongType())]))


@register("schema_evolution_union", (
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, "
    "CASE WHEN c_custkey % 2 = 1 THEN c_acctbal END AS acctbal FROM customer"))
def q_schema_evolution_union(spark, d):
    """A later snapshot adds a field; it becomes a column and older rows carry NULL."""
    root = scratch_path(spark, "evolve")
    c = m.load(spark, d, "customer")
    first = c.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    second = c.where(F.col("c_custkey") % 2 == 1).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("acctbal"))
    p1 = landing.write_snapshot(first, f"{root}/landing", "customers", "2001-01-01T000000Z")
    p2 = landing.write_snapshot(second, f"{root}/landing", "customers", "2001-02-01T000000Z")
    s1 = files.infer_once(spark, p1, f"{root}/_schemas/customers")
    s1_again = files.infer_once(spark, p2, f"{root}/_schemas/customers")  # persisted: not re-inferred
    if s1_again != s1:
        raise RuntimeError("the persisted schema was inferred again")
    old = files.read_snapshots(spark, p1, "json", s1)
    new = files.read_snapshots(spark, p2, "json", files.infer_schema(spark, p2))
    return files.evolve_union(old, new).select("id", "name", "segment", "acctbal")


RESCUE_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                              T.StructField("value", T.DoubleType())])


@register("rescue_unexpected", (
    "SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, "
    "'{\"event_type\":\"' || event_type || '\",' || CASE WHEN event_type = 'error' THEN '\"value\":\"None\",' "
    "ELSE '' END || '\"k\":\"' || json_extract_string(props, '$.k') || '\"}' AS _rescued_data FROM events"))
def q_rescue_unexpected(spark, d):
    """JSON text with unexpected fields and dirty values: typed columns plus a rescue column."""
    ev = m.load(spark, d, "events")
    raw = ev.select(F.to_json(F.struct(
        "event_id", "user_id", "event_type",
        F.when(F.col("event_type") == "error", F.lit("None")).otherwise(F.col("value").cast("string")).alias("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))).alias("raw"))
    return files.rescue(raw, "raw", RESCUE_SCHEMA)


@register("regexp_season", (
    "SELECT o_orderkey, path, regexp_extract(path, '(\\d{4}-\\d{2})', 1) AS season FROM ("
    "SELECT o_orderkey, '/landing/historical/' || CASE WHEN o_orderkey % 10 = 0 THEN 'misc' ELSE "
    "CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST((year(o_orderdate) + 1) % 100 AS STRING), 2, '0') END "
    "|| '/merged_gws.csv' AS path FROM orders)"))
def q_regexp_season(spark, d):
    """Season label from a landing path; a path without one gives ''."""
    o = m.load(spark, d, "orders")
    season = F.expr(dict(m.HISTORICAL_RAW)["season"])
    path = F.concat(F.lit("/landing/historical/"),
                    F.when(F.col("o_orderkey") % 10 == 0, F.lit("misc")).otherwise(season), F.lit("/merged_gws.csv"))
    return files.season_from_path(o.select("o_orderkey", path.alias("path")), "path")


@register("snapshot_attach_id", (
    "SELECT c_custkey AS element_id, n_orders, total_cents, '{\"element_id\":' || c_custkey || ',\"n_orders\":' "
    "|| n_orders || ',\"total_cents\":' || total_cents || '}' AS payload FROM customer JOIN ("
    "SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) "
    "AS total_cents FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) r ON r.o_custkey = c_custkey"))
def q_snapshot_attach_id(spark, d):
    """Merge each id into its payload, drop failed pulls, encode as JSON."""
    ids = m.load(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    resp = m.load(spark, d, "orders").where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("id")).agg(
        F.struct(F.count(F.lit(1)).alias("n_orders"),
                 F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("total_cents")).alias("data"))
    merged = landing.attach_id(ids, resp, "id")
    return merged.select("*", F.to_json(F.struct(*[F.col(c) for c in merged.columns])).alias("payload"))


@register("snapshot_stamp", (
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H%M%SZ') AS stamp, "
    "'element_data_' || strftime(ts, '%Y-%m-%dT%H%M%SZ') || '.json' AS file_name FROM events"))
def q_snapshot_stamp(spark, d):
    """UTC pull stamps and the stamped landing file names."""
    ev = m.load(spark, d, "events")
    return ev.select("event_id", snapshot_stamp("ts").alias("stamp"),
                     landing.stamped_name("element_data", F.col("ts")).alias("file_name"))
