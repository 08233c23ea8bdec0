"""Published bucket tables: upserts, replays, failures, retention, views and full refreshes."""

import random
import time

import pytest
from pyspark.sql import functions as F

from goldleaf.operators import cdc
from goldleaf.operators.quality import Expectation, expectation_report
from goldleaf.sources import shared_files
from goldleaf.streaming import expectations, tables

CHANGES = "k int, g string, seq int, a int, b string"


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def made(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(12)]), rng.choice(["x", "y"]), i, rng.choice([None, 1, 2, 3]), rng.choice([None, "p", "q"])) for i in rng.sample(range(1000), n)]


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_merges_in_any_order_equal_one_reduction(spark, workdir, ignore_nulls):
    table = tables.BucketTable(spark, workdir, ("k",), n_buckets=5, keep=2)
    every = []
    for n, size in enumerate((40, 1, 7, 30, 3)):
        batch = made(n, size)
        every += batch
        tables.merge_changes(table, spark.createDataFrame(batch, CHANGES), ["k", "g"], "seq", ignore_nulls, "s", n)
    assert tables.merge_changes(table, spark.createDataFrame([], CHANGES), ["k", "g"], "seq", ignore_nulls, "s", 9).version == 5
    want = cdc.scd1(spark.createDataFrame(every, CHANGES), ["k", "g"], "seq", ignore_nulls)
    assert rows(tables.current_rows(table)) == rows(want)


def test_replays_touched_buckets_and_new_columns(spark, workdir):
    table = tables.BucketTable(spark, workdir, ("k",), n_buckets=8)
    first = spark.createDataFrame([(i, "x", 1, i, "p") for i in range(50)], CHANGES)
    m1 = tables.merge_changes(table, first, ["k"], "seq", source="s", batch_id=0)
    m2 = tables.merge_changes(table, spark.createDataFrame([(3, "z", 2, 0, None, 1.5)], CHANGES + ", extra double"), ["k"], "seq", source="s", batch_id=1)
    assert sum(m1.live[b] != m2.live[b] for b in m2.live) == 1 and m2.batches == {"s": 1}
    assert tables.merge_changes(table, first, ["k"], "seq", source="s", batch_id=0) == m2
    got = {r["k"]: r for r in tables.current_rows(table).collect()}
    assert got[3]["g"] == "z" and got[3]["extra"] == 1.5 and got[4]["extra"] is None and len(got) == 50
    assert table.read(manifest=m1).where("g = 'z'").count() == 0  # the version before is still there for its readers


def test_a_write_that_fails_is_never_seen_and_can_be_repeated(spark, workdir):
    table = tables.BucketTable(spark, workdir, ("k",), n_buckets=4)
    good = spark.createDataFrame([(i, "x", 1, i, "p") for i in range(20)], CHANGES)
    tables.merge_changes(table, good, ["k"], "seq", batch_id=0)
    before = rows(tables.current_rows(table))
    bad = good.withColumn("a", F.when(F.col("k") < 19, F.col("a")).otherwise(F.raise_error(F.lit("lost")).cast("int"))).withColumn("seq", F.lit(2))
    with pytest.raises(Exception, match="lost"):
        tables.merge_changes(table, bad, ["k"], "seq", batch_id=1)
    assert rows(tables.current_rows(table)) == before
    # what a crash between the data and the manifest leaves is overwritten by the next attempt
    good.where("k < 3").withColumn(tables.BUCKET, F.lit(1)).write.partitionBy(tables.BUCKET).parquet(f"{workdir}/data/v=2")
    tables.merge_changes(table, good.withColumn("seq", F.lit(3)).withColumn("a", F.lit(7)), ["k"], "seq", batch_id=1)
    assert tables.current_rows(table).where("a = 7").count() == 20
    with pytest.raises(FileExistsError):
        shared_files.write_new(spark, f"{workdir}/manifest/{2:012d}.json", "{}")


def test_rows_outside_the_replaced_buckets_are_refused(spark, workdir):
    table = tables.BucketTable(spark, workdir, ("k",), n_buckets=4)
    with pytest.raises(ValueError, match="not replaced"):
        table.publish(spark.createDataFrame([(i,) for i in range(20)], "k int"), [0])
    assert table.manifest() is None and table.read() is None


def test_two_hundred_batches_stay_cheap_and_small(spark, workdir):
    table = tables.BucketTable(spark, workdir, ("k",), n_buckets=4, keep=3)
    took, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for n in range(200):
            batch = spark.createDataFrame([(n % 50, "x", n, n, "p")], CHANGES).coalesce(1)
            t = time.time()
            tables.merge_changes(table, batch, ["k"], "seq", source="s", batch_id=n)
            took.append(time.time() - t)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(table.versions()) == 3 and table.manifest().batches == {"s": 199}
    assert len([n for n in shared_files.names(spark, f"{workdir}/data") if n.startswith("v=")]) <= 4 + 3
    assert tables.current_rows(table).where("a >= 150").count() == 50
    middle = lambda x: sorted(x)[len(x) // 2]
    assert middle(took[-40:]) < 2 * middle(took[20:60]) + 0.2


def test_view_recomputes_only_what_changed(spark, workdir):
    base = tables.BucketTable(spark, f"{workdir}/base", ("k",), n_buckets=8)
    view = tables.BucketTable(spark, f"{workdir}/view", ("k",), n_buckets=8)
    define = lambda df: df.groupBy("k").agg(F.sum("a").alias("total"))
    start = [(i % 20, str(i), 1, i, "p") for i in range(60)]
    tables.merge_changes(base, spark.createDataFrame(start, CHANGES), ["k", "g"], "seq", batch_id=0)
    assert len(tables.refresh_view(view, base, define)) == len(base.manifest().live)
    assert tables.refresh_view(view, base, define) == []
    before = view.manifest()
    tables.merge_changes(base, spark.createDataFrame([(5, "late", 2, 100, None)], CHANGES), ["k", "g"], "seq", batch_id=1)
    with pytest.raises(Exception, match="broken"):
        tables.refresh_view(view, base, lambda df: define(df).withColumn("total", F.raise_error(F.lit("broken")).cast("long")))
    assert view.manifest() == before and view.read().count() == 20
    changed = tables.refresh_view(view, base, define)
    assert len(changed) == 1 and sum(before.live[b] != view.manifest().live[b] for b in before.live) == 1
    assert rows(view.read()) == rows(define(base.read()))
    base.publish(base.read(changed).limit(0), changed)  # a bucket that is emptied is emptied in the view
    assert tables.refresh_view(view, base, define) == changed and rows(view.read()) == rows(define(base.read()))


def test_full_refresh_replaces_data_and_state_or_nothing(spark, workdir):
    path = f"{workdir}/t"

    def build(n):
        return lambda folder: spark.range(n).write.parquet(f"{folder}/rows")

    def failing(folder):
        build(7)(folder)
        raise ZeroDivisionError

    live = lambda: spark.read.parquet(f"{tables.live_generation(spark, path)}/rows").count()
    assert tables.live_generation(spark, path) is None
    tables.replace_generation(spark, path, build(1))
    for n in (2, 3):
        with pytest.raises(ZeroDivisionError):
            tables.replace_generation(spark, path, failing)
        assert live() == n - 1
        tables.replace_generation(spark, path, build(n))
        assert live() == n
    assert [x for x in shared_files.names(spark, path) if x.startswith("gen")] == ["gen=2", "gen=3"]


RULES = [Expectation("positive", "a > 0", "warn"), Expectation("has_key", "k IS NOT NULL", "drop"), Expectation("known", "g IN ('x')", "drop")]


def test_stream_counts_equal_batch_counts_after_a_replay(spark, workdir):
    parts = [spark.createDataFrame(made(n, size), CHANGES) for n, size in enumerate((30, 1, 12))]
    for n, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"{workdir}/in/part={n}")
    source = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).option("latestFirst", False)
    ran = expectations.append_checked(source.parquet(f"{workdir}/in"), RULES, f"{workdir}/out", f"{workdir}/metrics", f"{workdir}/ckpt")
    assert ran == 3 and expectations.append_checked(source.parquet(f"{workdir}/in"), RULES, f"{workdir}/out", f"{workdir}/metrics", f"{workdir}/ckpt") == 0

    def check():
        log = expectations.expectation_log(spark, f"{workdir}/metrics").collect()
        got = sorted(tuple(r)[1:] for r in log)
        want = sorted(tuple(r) for p in parts for r in expectation_report(p, RULES).select("rule", "action", "failed", "total", "kept").collect())
        assert got == want and len(got) == 9
        assert spark.read.parquet(f"{workdir}/out").count() == sum(r["kept"] for r in log if r["rule"] == "positive")

    check()
    by_total = {r["total"]: r["_batch_id"] for r in expectations.expectation_log(spark, f"{workdir}/metrics").collect()}
    expectations.write_checked(parts[2], by_total[12], RULES, f"{workdir}/out", f"{workdir}/metrics")
    check()


def test_a_batch_without_rows_counts_zero(spark, workdir):
    expectations.write_checked(spark.createDataFrame([], CHANGES), 0, RULES, f"{workdir}/out", f"{workdir}/metrics")
    assert {tuple(r)[3:] for r in expectations.expectation_log(spark, f"{workdir}/metrics").collect()} == {(0, 0, 0)}
