"""SCD-1 change capture: both NULL rules, out-of-order input, state merge, streaming replay."""

import datetime as dt
import random

from pyspark.sql import functions as F

from goldleaf.operators import cdc
from goldleaf.streaming.sinks import append_stream, scd1_compact, scd1_stream, scd1_target

SCHEMA = "player_id long, price double, team long, name string, seq timestamp"


def t(day):
    return dt.datetime(2025, 8, day, 8, 0, 0)


ROWS = [
    (1, 5.5, 10, "A", t(1)),
    (1, None, 11, None, t(3)),      # late update with NULL price / name
    (1, 6.0, None, "A2", t(2)),     # older than the previous one, arrives after it
    (2, 4.5, 20, "B", t(2)),
    (2, 4.6, 20, "B", t(2)),        # tie on the sequence; tie broken by the second sequence column below
    (3, None, None, None, t(1)),    # only NULLs
]


def _frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def _dict(df, key="player_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_overwrite_takes_latest_row_whole(spark):
    out = _dict(cdc.scd1(_frame(spark).where("player_id != 2"), ["player_id"], "seq"))
    assert out[1] == {"player_id": 1, "price": None, "team": 11, "name": None, "seq": t(3)}
    assert out[3]["price"] is None


def test_ignore_nulls_is_per_column(spark):
    out = _dict(cdc.scd1(_frame(spark).where("player_id != 2"), ["player_id"], "seq", ignore_null_updates=True))
    # price: latest non-NULL is 6.0 (day 2), team: 11 (day 3), name: "A2" (day 2)
    assert out[1] == {"player_id": 1, "price": 6.0, "team": 11, "name": "A2", "seq": t(3)}
    assert out[3] == {"player_id": 3, "price": None, "team": None, "name": None, "seq": t(1)}


def test_sequence_ties_resolved_by_second_column(spark):
    df = _frame(spark).withColumn("tie", F.col("price"))
    out = _dict(cdc.scd1(df, ["player_id"], ["seq", "tie"]))
    assert out[2]["price"] == 4.6


def test_composite_key_keeps_double_gameweeks_apart(spark):
    rows = [(7, 100, 2, t(1)), (7, 101, 5, t(1)), (7, 100, 3, t(2))]
    df = spark.createDataFrame(rows, "player_id long, fixture_id long, pts int, seq timestamp")
    out = {(r.player_id, r.fixture_id): r.pts for r in cdc.scd1(df, ["player_id", "fixture_id"], "seq").collect()}
    assert out == {(7, 100): 3, (7, 101): 5}


def test_merge_in_any_arrival_order_equals_batch(spark):
    rng = random.Random(7)
    rows = [(k % 13, rng.choice([None, float(i)]), rng.choice([None, k]), rng.choice([None, "x", "y"]), t(1 + i % 27))
            for i, k in enumerate(rng.sample(range(400), 300))]
    df = _frame(spark, rows)
    for nulls in (False, True):
        batch = sorted(map(tuple, cdc.scd1(df, ["player_id"], "seq", nulls).collect()))
        order = list(range(5))
        rng.shuffle(order)
        parts = [df.where(F.dayofmonth("seq") % 5 == p) for p in order]
        state = cdc.scd1_state(parts[0], ["player_id"], "seq", nulls)
        for p in parts[1:]:
            state = cdc.scd1_merge(state, p, ["player_id"], "seq", nulls)
        assert sorted(map(tuple, cdc.current(state).select(*df.columns).collect())) == batch


def test_stream_replay_equals_batch_and_restart_adds_nothing(spark, workdir):
    land = f"{workdir}/landing"
    rows = ROWS[:2] + ROWS[3:4] + ROWS[5:] + [ROWS[2]]  # the older update lands in the last file
    for i, r in enumerate(rows):
        spark.createDataFrame([r], SCHEMA).coalesce(1).write.json(f"{land}/f{i:02d}")
    schema = _frame(spark).schema
    for nulls in (False, True):
        path, ckpt = f"{workdir}/target{int(nulls)}", f"{workdir}/ckpt{int(nulls)}"
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option(
            "recursiveFileLookup", True).json(land)
        n = scd1_stream(stream, ["player_id"], "seq", path, ckpt, ignore_null_updates=nulls)
        assert n == len(rows)  # one micro-batch per file
        got = sorted(map(tuple, scd1_target(spark, path, ["player_id"]).select(*schema.names).collect()))
        want = sorted(map(tuple, cdc.scd1(spark.createDataFrame(rows, SCHEMA), ["player_id"], "seq", nulls)
                          .select(*schema.names).collect()))
        assert got == want
        again = spark.readStream.schema(schema).option("recursiveFileLookup", True).json(land)
        assert scd1_stream(again, ["player_id"], "seq", path, ckpt, ignore_null_updates=nulls) == 0
        assert sorted(map(tuple, scd1_target(spark, path, ["player_id"]).select(*schema.names).collect())) == want


def test_compaction_keeps_the_table_and_prunes_old_batches(spark, workdir):
    land, path, ckpt = f"{workdir}/landing", f"{workdir}/target", f"{workdir}/ckpt"
    schema = _frame(spark).schema
    want_rows = []
    for i, r in enumerate(ROWS):
        spark.createDataFrame([r], SCHEMA).coalesce(1).write.json(f"{land}/f{i:02d}")
        want_rows.append(r)
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).json(land)
        scd1_stream(stream, ["player_id"], "seq", path, ckpt, ignore_null_updates=True)
        if i == 2:
            assert scd1_compact(spark, path, ["player_id"]) is not None
            assert scd1_compact(spark, path, ["player_id"]) is None  # nothing new
        want = sorted(map(tuple, cdc.scd1(spark.createDataFrame(want_rows, SCHEMA), ["player_id"], "seq", True)
                          .select(*schema.names).collect()))
        got = sorted(map(tuple, scd1_target(spark, path, ["player_id"]).select(*schema.names).collect()))
        assert got == want
    assert scd1_compact(spark, path, ["player_id"]) is not None
    final = scd1_target(spark, path, ["player_id"])
    assert all("through=" in f for f in final.inputFiles())  # only the newest snapshot is read


def test_null_sequence_comes_first(spark):
    rows = [(1, 5.0, None), (1, 6.0, t(1)), (2, 7.0, None)]
    df = spark.createDataFrame(rows, "player_id long, price double, seq timestamp")
    for ignore in (False, True):
        assert {r.player_id: r.price for r in cdc.scd1(df, ["player_id"], "seq", ignore).collect()} == {1: 6.0, 2: 7.0}


def test_an_append_run_counts_more_batches_than_spark_reports_by_default(spark, workdir):
    spark.range(0, 150, 1, 150).write.parquet(f"{workdir}/in")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{workdir}/in")
    assert append_stream(stream, f"{workdir}/out", f"{workdir}/ckpt") == 150
    assert spark.read.parquet(f"{workdir}/out").count() == 150
