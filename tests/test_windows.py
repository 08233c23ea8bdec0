"""The skew-safe row-frame window equals the plain window, with and without hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from goldleaf.operators.windows import Frame, hot_keys, over_rows


def _data(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rng.randrange(40)}")
        rows.append((key, rng.randrange(50), i, rng.choice([None, float(rng.randrange(10))]), f"s{i % 2}"))
    return spark.createDataFrame(rows, "k string, t int, id int, v double, season string")


FRAMES = {
    "avg5": Frame(4, 0, lambda w: F.avg("v").over(w)),
    "past": Frame(3, -1, lambda w: F.collect_list(F.struct("id")).over(w)),
    "ahead": Frame(0, 2, lambda w: F.collect_list(F.struct("id")).over(w)),
}


def totals():
    return {"tot": (["season"], F.sum("v"))}


def _rows(df):
    return sorted((r.id, r.avg5, tuple(x.id for x in r.past), tuple(x.id for x in r.ahead), r.tot) for r in df.collect())


@pytest.mark.parametrize("hot_rows,bucket", [(50, 7), (50, 1000), (10**9, 10), (0, 10)])
def test_split_equals_plain(spark, hot_rows, bucket):
    df = _data(spark)
    plain = over_rows(df, ["k"], ["t", "id"], FRAMES, totals(), hot_rows=0)
    split = over_rows(df, ["k"], ["t", "id"], FRAMES, totals(), hot_rows=hot_rows, bucket_rows=bucket)
    assert _rows(split) == _rows(plain)
    assert split.count() == 900


@pytest.mark.parametrize("bucket", [1, 2, 3, 4, 5, 11])
@pytest.mark.parametrize("hot_rows,max_hot", [(5, 1), (50, 10)])
def test_buckets_smaller_than_the_frame_and_all_keys_split(spark, bucket, hot_rows, max_hot):
    """max_hot 1 takes the path that splits every key; 10 the one that splits the hot keys only."""
    df = _data(spark).where("id % 4 < 2")
    assert (hot_keys(df, ["k"], hot_rows, max_hot) is None) == (max_hot == 1)
    plain = over_rows(df, ["k"], ["t", "id"], FRAMES, totals(), hot_rows=0)
    split = over_rows(df, ["k"], ["t", "id"], FRAMES, totals(), hot_rows=hot_rows, bucket_rows=bucket, max_hot=max_hot)
    assert _rows(split) == _rows(plain)
