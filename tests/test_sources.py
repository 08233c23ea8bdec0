"""Bronze sources and landing files: JSON documents, root arrays, CSV seasons, evolution, rescue."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators import silver
from goldleaf.sources import files, landing
from goldleaf.streaming.sinks import append_stream, backfill_once


def _write_text(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_root_array_with_and_without_multiline(spark, workdir):
    d = _local(workdir)
    items = [{"id": 1, "event": 1, "kickoff_time": "2025-08-16T14:00:00Z", "team_h": 1, "team_a": 2,
              "finished": True},
             {"id": 2, "event": None, "kickoff_time": "bad", "team_h": 2, "team_a": 1, "finished": None}]
    _write_text(f"{d}/line", "fixtures_2025-08-16T080000Z.json", json.dumps(items))
    _write_text(f"{d}/pretty", "fixtures_2025-08-16T080000Z.json", json.dumps(items, indent=2))
    one_line = files.read_snapshots(spark, f"{d}/line", "json")
    pretty = files.read_snapshots(spark, f"{d}/pretty", "json", multiline=True)
    for df in (one_line, pretty):
        fx = {r.fixture_id: r for r in silver.fixtures(df).collect()}
        assert set(fx) == {1, 2}
        assert fx[1].kickoff_time is not None and fx[2].kickoff_time is None  # bad text -> NULL, not an error
        assert fx[2].gameweek is None and fx[1].home_difficulty is None       # absent field -> typed NULL


def test_write_json_arrays_round_trip_within_bounds(spark, workdir):
    df = spark.range(0, 1200).select(F.col("id"), F.lit(1).alias("hot"), F.when(F.col("id") == 7, F.repeat(F.lit("x"), 9000)).otherwise("é").alias("v"))
    path = landing.write_json_arrays(df.repartition(3), f"{workdir}/arrays", max_items=300, max_bytes=4000)
    found = os.listdir(_local(path))
    arrays = [open(f"{_local(path)}/{n}").read() for n in found if n.endswith(".txt")]
    assert all(a.count("\n") == 1 and len(json.loads(a)) <= 300 and (len(a) <= 4001 or len(json.loads(a)) == 1) for a in arrays)
    assert 5 < len(arrays) < 40 and not [n for n in found if os.path.isdir(f"{_local(path)}/{n}")]
    for multiline in (True, False):
        back = files.read_snapshots(spark, path, "json", multiline=multiline)
        assert back.count() == 1200 and back.agg(F.sum("id")).first()[0] == sum(range(1200))
    empty = landing.write_json_arrays(df.limit(0), f"{workdir}/none")
    assert not [n for n in os.listdir(_local(empty)) if os.path.getsize(f"{_local(empty)}/{n}") and n.endswith(".txt")]


def test_infer_once_persists_schema(spark, workdir):
    d = _local(workdir)
    _write_text(f"{d}/a", "s1.json", '{"id": 1, "name": "x"}\n')
    first = files.infer_once(spark, f"{d}/a", f"{workdir}/_schema")
    _write_text(f"{d}/a", "s2.json", '{"id": 2, "name": "y", "extra": 1.5}\n')
    assert files.infer_once(spark, f"{d}/a", f"{workdir}/_schema") == first
    assert "extra" in files.infer_schema(spark, f"{d}/a").names


def test_evolve_schema_widens_and_keeps_types(spark, workdir):
    d = _local(workdir)
    _write_text(f"{d}/a", "s1.json", '{"id": 1, "name": "x"}\n')
    first = files.evolve_schema(spark, f"{d}/a", f"{workdir}/_schema")
    _write_text(f"{d}/a", "s2.json", '{"id": "2x", "name": "y", "extra": 1.5}\n')
    again = files.evolve_schema(spark, f"{d}/a", f"{workdir}/_schema")
    assert again.names == [*first.names, "extra"] and again["id"].dataType == first["id"].dataType
    assert files.evolve_schema(spark, f"{d}/a", f"{workdir}/_schema") == again


def test_csv_by_name_loses_nothing(spark, workdir):
    d = _local(workdir)
    _write_text(f"{d}/2019-20", "a.csv", "name,round,total_points,minutes\nSalah,1,12,90\nbroken,2\n")
    _write_text(f"{d}/2020-21", "a.csv", "name,position,team,round,total_points,minutes\nAlisson,GK,Liv,3,6,many\n")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("round", T.IntegerType()),
                           T.StructField("total_points", T.IntegerType()), T.StructField("minutes", T.IntegerType())])
    rows = {r["name"]: r for r in files.read_csv_by_name(spark, d, schema).collect()}
    assert tuple(rows["Salah"][:4]) == ("Salah", 1, 12, 90) and rows["Salah"]._rescued_data is None
    assert tuple(rows["Alisson"][:4]) == ("Alisson", 3, 6, None)
    assert json.loads(rows["Alisson"]._rescued_data) == {"minutes": "many", "position": "GK", "team": "Liv"}
    assert json.loads(rows["broken"]._rescued_data) == {"_corrupt_record": "broken,2"}


def test_malformed_json_text_is_rescued(spark):
    schema = T.StructType([T.StructField("id", T.LongType())])
    raw = spark.createDataFrame([('{"id": 1',), ("[3]",), (None,), ('{"id": 2}',)], "raw string")
    assert sorted(((r.id, r._rescued_data) for r in files.rescue(raw, "raw", schema).collect()), key=str) == sorted(
        [(None, '{"id": 1'), (None, "[3]"), (None, None), (2, None)], key=str)


def test_evolve_union_new_field_older_rows_null(spark):
    old = spark.createDataFrame([(1, "a")], "id long, name string")
    new = spark.createDataFrame([(2, "b", 3.5)], "id long, name string, price double")
    rows = {r.id: r for r in files.evolve_union(old, new).collect()}
    assert rows[1].price is None and rows[2].price == 3.5


def test_rescue_keeps_unexpected_fields_and_bad_values(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.DoubleType())])
    raw = spark.createDataFrame([('{"id": 1, "value": "3.5"}',), ('{"id": 2, "value": "None", "new": [1,2]}',),
                                 ('{"id": "x"}',)], "raw string")
    rows = {r.value if r.id is None else r.id: r for r in files.rescue(raw, "raw", schema).collect()}
    assert rows[1].value == 3.5 and rows[1]._rescued_data is None
    assert rows[2].value is None and json.loads(rows[2]._rescued_data) == {"value": "None", "new": "[1,2]"}
    assert json.loads(rows[None]._rescued_data) == {"id": "x"}


def test_season_from_path(spark):
    df = spark.createDataFrame([("/l/historical/2023-24/merged_gws.csv",), ("/l/historical/misc/merged_gws.csv",)],
                               "_source_file string")
    assert [r.season for r in files.season_from_path(df).collect()] == ["2023-24", ""]


def test_csv_seasons_backfill_once(spark, workdir):
    rows = [("A B", "MID", 1, "2016-17"), ("C D", "FWD", 2, "2016-17"), ("A B", "MID", 1, "2017-18")]
    df = spark.createDataFrame(rows, "name string, position string, round int, season string")
    src = landing.write_seasons(df, f"{workdir}/landing")
    reader = files.season_from_path(files.with_lineage(files.read_snapshots(spark, src, "csv")))
    target, marker = f"{workdir}/bronze", f"{workdir}/_flows/once.done"
    assert backfill_once(spark, "once", reader, target, marker) is True
    assert backfill_once(spark, "once", reader, target, marker) is False
    out = spark.read.parquet(target)
    assert sorted((r.name, r.season, r.round) for r in out.collect()) == sorted((a, d, c) for a, b, c, d in rows)


def test_append_stream_picks_up_only_new_files(spark, workdir):
    d = _local(workdir)
    _write_text(f"{d}/in", "a.json", '{"id": 1}\n')
    schema = T.StructType([T.StructField("id", T.LongType())])
    out, ckpt = f"{workdir}/out", f"{workdir}/ckpt"
    assert append_stream(files.with_lineage(files.stream_snapshots(spark, f"{d}/in", schema)), out, ckpt) == 1
    _write_text(f"{d}/in", "b.json", '{"id": 2}\n{"id": 3}\n')
    assert append_stream(files.with_lineage(files.stream_snapshots(spark, f"{d}/in", schema)), out, ckpt) == 1
    assert append_stream(files.with_lineage(files.stream_snapshots(spark, f"{d}/in", schema)), out, ckpt) == 0
    got = spark.read.parquet(out)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]
    assert got.where(F.col("_source_file").endswith("b.json")).count() == 2


def test_attach_id_drops_failed_pulls(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    resp = spark.createDataFrame([(1, (5, "x")), (3, None)], "id long, data struct<n:int,s:string>")
    rows = landing.attach_id(ids, resp, "id").collect()
    assert [(r.element_id, r.n, r.s) for r in rows] == [(1, 5, "x")]


def test_nest_then_explode_round_trip(spark):
    parent = spark.createDataFrame([(1,), (2,)], "element_id long")
    child = spark.createDataFrame([(1, 7, 3), (1, 8, 1)], "element_id long, fixture long, total_points int")
    docs = landing.nest(parent, child, ["element_id"], "history", order_by=["fixture"])
    assert {r.element_id: r.history is None for r in docs.collect()} == {1: False, 2: True}
    perf = silver.performances(docs)
    assert sorted((r.fixture_id, r.total_points) for r in perf.collect()) == [(7, 3), (8, 1)]


def test_materialize_replaces_the_stored_view(spark, workdir):
    from goldleaf.streaming.sinks import materialize

    first = materialize(spark.range(5).withColumn("src", F.lit("a")), f"{workdir}/mv", ["src"])
    assert first.count() == 5
    second = materialize(spark.range(3).withColumn("src", F.lit("b")), f"{workdir}/mv", ["src"])
    assert sorted((r.id, r.src) for r in second.collect()) == [(0, "b"), (1, "b"), (2, "b")]


def test_rescue_columns_for_csv(spark, workdir):
    d = _local(workdir)
    _write_text(f"{d}/csv", "merged_gws.csv", "name,round,minutes,surprise\nA B,1,90,x\nC D,3.0,None,\n")
    raw = files.read_snapshots(spark, f"{d}/csv", "csv", options={"inferSchema": False})
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("round", T.IntegerType()),
                           T.StructField("minutes", T.IntegerType()), T.StructField("kickoff_time", T.StringType())])
    rows = {r.name: r for r in files.rescue_columns(raw, schema).collect()}
    assert rows["A B"]["round"] == 1 and rows["A B"].minutes == 90 and rows["A B"].kickoff_time is None
    assert json.loads(rows["A B"]._rescued_data) == {"surprise": "x"}
    assert rows["C D"]["round"] is None and rows["C D"].minutes is None
    assert json.loads(rows["C D"]._rescued_data) == {"round": "3.0", "minutes": "None"}


def test_silver_projection_on_a_stream(spark, workdir):
    d = _local(workdir)
    docs = [{"elements": [{"id": i, "first_name": "F", "second_name": str(i), "team": 1, "element_type": 2,
                           "now_cost": "45", "web_name": f"W{i}"}], "teams": [{"id": 1, "name": "T"}]}
            for i in range(3)]
    for i, doc in enumerate(docs):
        _write_text(f"{d}/boot", f"bootstrap-static_2025-08-0{i + 1}T080000Z.json", json.dumps(doc))
    schema = files.infer_schema(spark, f"{d}/boot")
    stream = files.with_lineage(files.stream_snapshots(spark, f"{d}/boot", schema, max_files=1))
    players = silver.players(stream)
    assert players.isStreaming
    n = append_stream(players, f"{workdir}/silver", f"{workdir}/ckpt")
    assert n == 3
    rows = sorted((r.player_id, r.current_price, r._source_file.rsplit("/", 1)[-1])
                  for r in spark.read.parquet(f"{workdir}/silver").collect())
    assert rows == [(i, 45.0, f"bootstrap-static_2025-08-0{i + 1}T080000Z.json") for i in range(3)]


def test_json_snapshots_rescue_what_does_not_fit(spark, workdir):
    d = _local(workdir)
    lines = ['{"id": 1, "at": "2001-01-01T00:00:00.000000Z", "sub": {"a": 1}}', '{"id": 2, "sub', '{"id": "3x", "name": "n"}', "",
             '{"id": 4, "more": [1, 2]}', '{"id": 5, "sub": {"a": 2, "b": 7}}', '{"id": 6, "sub": {"a": "z"}}', "[]", '[{"id": 7}, {"id": 8, "w": null, "x": "y"}]',
             "17", '{"id": null}']
    _write_text(f"{d}/in", "a.json", "\n".join(lines))
    schema = T.StructType.fromDDL("id long, name string, at timestamp, sub struct<a:int>")
    out = f"{workdir}/out"
    stream = files.with_lineage(files.stream_snapshots(spark, f"{d}/in", schema))
    assert append_stream(stream, out, f"{workdir}/ckpt") == 1
    batch = files.with_lineage(files.read_snapshots(spark, f"{d}/in", "json", schema))
    for df in (spark.read.parquet(out), batch):
        assert df.columns == [*schema.names, "_rescued_data", "_ingestion_timestamp", "_source_file"]
        rows = df.collect()
        assert all(r._source_file.endswith("a.json") for r in rows)
        kept = sorted((r.id, json.loads(r._rescued_data)) for r in rows if r._rescued_data and r.id)
        assert [(i, {k: json.loads(v) if k in ("sub", "more") else v for k, v in m.items()}) for i, m in kept] == [
            (4, {"more": [1, 2]}), (5, {"sub": {"a": 2, "b": 7}}), (6, {"sub": {"a": "z"}}), (8, {"w": None, "x": "y"})]
        assert sorted(r._rescued_data for r in rows if r._rescued_data and not r.id and r.name is None) == ["17", '{"id": 2, "sub']
        assert [json.loads(r._rescued_data) for r in rows if r.name] == [{"id": "3x"}]
        clean = [r for r in rows if r._rescued_data is None]
        assert sorted((r.id or 0, r.at is not None) for r in clean) == [(0, False), (1, True), (7, False)]
    assert "_corrupt_record" not in files.infer_schema(spark, f"{d}/in").names


def test_csv_headers_that_repeat_a_name_or_differ_in_one_folder(spark, workdir):
    d = _local(workdir)
    _write_text(f"{d}/one folder", "a.csv", "id,name,name\n1,x,y\n")
    _write_text(f"{d}/one folder", "b.csv", "name,id\nz,2\n")
    _write_text(f"{d}/other", "c.csv", "﻿id,name,name\n3,u,v\nshort\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    rows = {r["name"]: (r["id"], r["_rescued_data"] and json.loads(r["_rescued_data"])) for r in files.read_csv_by_name(spark, d, schema).collect()}
    assert rows == {"x": (1, {"name__2": "y"}), "z": (2, None), "u": (3, {"name__2": "v"}), None: (None, {"id": "short", "_corrupt_record": "short"})}


def test_json_objects_that_repeat_a_key_are_kept_whole(spark, workdir):
    d = _local(workdir)
    lines = ['{"id":1,"x":1,"x":2}', '{"id":2,"id":3}', '{"id":4,"s":{"a":1,"a":2}}', '{"id":5,"it\'s":6}', '{"id":7,"arr":[{"a":1,"a":2}]}']
    _write_text(f"{d}/a", "s.json", "\n".join(lines))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("it's", T.LongType()),
                           T.StructField("s", T.StructType([T.StructField("a", T.LongType())])),
                           T.StructField("arr", T.ArrayType(T.StructType([T.StructField("a", T.LongType())])))])
    rows = {r["_rescued_data"]: (r["id"], r["it's"]) for r in files.read_snapshots(spark, f"{d}/a", "json", schema).collect()}
    assert rows.keys() == {lines[0], lines[1], '{"s":"{\\"a\\":1,\\"a\\":2}"}', None, '{"arr":"[{\\"a\\":1,\\"a\\":2}]"}'}
    assert rows[lines[0]] == (1, None) and rows[None] == (5, 6)
    raw = spark.createDataFrame([(x,) for x in lines[:4]], "raw string")
    plain = T.StructType(schema.fields[:2])
    got = {r["_rescued_data"]: (r["id"], r["it's"]) for r in files.rescue(raw, "raw", plain).collect()}
    assert got == {lines[0]: (None, None), lines[1]: (None, None), '{"s":"{\\"a\\":1,\\"a\\":2}"}': (4, None), None: (5, 6)}


def test_backfill_joins_its_rows_once(spark, monkeypatch):
    """Both kinds of headers are written from stored rows, by compiled methods only while the query writes."""
    from goldleaf.plans import workload_sources as w

    seen, real, key = [], w._land_seasons, "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)

    def land(raw, root):
        seen.append((raw._jdf.queryExecution().optimizedPlan().toString(), spark.conf.get(key)))
        return real(raw, root)

    monkeypatch.setattr(w, "_land_seasons", land)
    assert w.q_ingest_csv_backfill(spark, "/root/testdata/sf0.001").count() > 0
    (plan, limit), = seen
    assert "Join" not in plan and "Aggregate" not in plan and limit == "8000" and spark.conf.get(key) == before


def test_rescue_columns_evaluate_no_map(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType())])
    df = spark.createDataFrame([("1", "a", None), ("x", None, 'say "hi"'), (None, None, "")], "n string, s string, extra string")
    out = files.rescue_columns(df, schema)
    assert [tuple(r) for r in out.collect()] == [(1, "a", None), (None, None, '{"n":"x","extra":"say \\"hi\\""}'), (None, None, '{"extra":""}')]
    assert "map_from_entries" not in out._jdf.queryExecution().optimizedPlan().toString()
