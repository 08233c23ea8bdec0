"""Nested schema evolution: merged types, aligned rows, streams and stored rows of several generations."""

import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.sources import files
from goldleaf.sources.nested import align, merge_types, union_evolved
from goldleaf.streaming.sinks import append_stream


def _type(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_merge_widens_at_every_depth_and_keeps_known_types(spark):
    old = _type(spark, "id long, s struct<a: int, in: struct<x: string>>, arr array<struct<p: long>>, m map<string, struct<k: int>>, nothing void, same string")
    new = _type(spark, "arr array<struct<q: string, p: string>>, s struct<in: struct<y: int, x: long>, b: date>, m map<string, struct<l: int>>, nothing int, extra double, same array<int>")
    want = _type(spark, "id long, s struct<a: int, in: struct<x: string, y: int>, b: date>, arr array<struct<p: long, q: string>>, "
                        "m map<string, struct<k: int, l: int>>, nothing int, same string, extra double")
    assert merge_types(old, new).simpleString() == want.simpleString()
    assert merge_types(want, old) == want and merge_types(T.StructType([]), old).names == old.names


def test_align_keeps_nulls_and_fills_absent_fields(spark):
    old = spark.createDataFrame([(1, [(5,), None], {"k": (1,)}, (7,)), (2, None, None, None), (3, [], {}, (None,))],
                                "id int, arr array<struct<p: int>>, m map<string, struct<a: int>>, s struct<`x y`: int>")
    want = _type(spark, "arr array<struct<p: long, q: string>>, m map<string, struct<a: int, b: int>>, s struct<`x y`: int, z: array<int>>, id string, `new.one` int")
    got = {r["id"]: r.asDict(True) for r in align(old, want).collect()}
    assert align(old, want).schema.simpleString() == want.simpleString()
    assert got["1"]["arr"] == [{"p": 5, "q": None}, None] and got["1"]["m"] == {"k": {"a": 1, "b": None}} and got["1"]["s"] == {"x y": 7, "z": None}
    assert got["2"] == {"id": "2", "arr": None, "m": None, "s": None, "new.one": None}
    assert got["3"]["arr"] == [] and got["3"]["m"] == {} and got["3"]["s"] == {"x y": None, "z": None}


def test_union_of_generations(spark):
    a = spark.createDataFrame([(1, [(5,)])], "id int, arr array<struct<p: int>>")
    b = spark.createDataFrame([([("x", 6)], 2, True)], "arr array<struct<q: string, p: int>>, id int, f boolean")
    rows = {r["id"]: r.asDict(True) for r in union_evolved(a, b).collect()}
    assert rows == {1: {"id": 1, "arr": [{"p": 5, "q": None}], "f": None}, 2: {"id": 2, "arr": [{"p": 6, "q": "x"}], "f": True}}
    assert files.evolve_union(a, b).count() == 2


def test_stream_picks_up_nested_fields_and_older_rows_are_null(spark, workdir):
    landed, out = f"{workdir}/landing", f"{workdir}/bronze"
    local = landed.removeprefix("file:")

    def pull(n, docs):
        os.makedirs(f"{local}/pull={n}")
        with open(f"{local}/pull={n}/x.json", "w") as fh:
            fh.write("\n".join(map(json.dumps, docs)))

    def run():
        schema = files.evolve_schema(spark, landed, f"{workdir}/_schemas")
        append_stream(files.stream_snapshots(spark, landed, schema), out, f"{workdir}/_checkpoint")

    pull(1, [{"n": 1, "elements": [{"id": 1, "cost": 5}, {"id": 2, "cost": 6}]}, {"n": 2, "elements": None}])
    run()
    pull(2, [{"n": 3, "elements": [{"id": 3, "cost": "free", "news": "hurt", "form": {"last": [1, 2]}}]}])
    run()
    schema = files.evolve_schema(spark, landed, f"{workdir}/_schemas")
    assert schema["elements"].dataType.elementType.names == ["cost", "id", "form", "news"]
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("_rescued_data", T.StringType())])).parquet(out)
    got = {r["id"]: r for r in rows.select(F.explode("elements").alias("e"), "_rescued_data").select("e.*", "_rescued_data").collect()}
    assert got[1].asDict(True) == {"cost": 5, "id": 1, "form": None, "news": None, "_rescued_data": None}
    assert got[3]["news"] == "hurt" and got[3]["form"]["last"] == [1, 2] and got[3]["cost"] is None
    assert "free" in got[3]["_rescued_data"] and rows.where("n = 2 and elements is null").count() == 1
