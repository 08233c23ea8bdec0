"""Scalar helpers: rounding, guarded division, name concat, position labels, stamps."""

import datetime as dt

from pyspark.sql import functions as F

from goldleaf.functions import full_name, position_label, round_half_up, safe_divide, snapshot_stamp


def test_scalars(spark):
    df = spark.createDataFrame(
        [(1.005, 10, 0, "A", "B", 1, dt.datetime(2025, 8, 16, 8, 5, 9)),
         (2.5, 3, 2, None, "C", 5, dt.datetime(2025, 1, 2, 23, 0, 0))],
        "x double, a int, b int, f string, s string, p int, t timestamp")
    r = df.select(
        round_half_up("x", 2).alias("r2"), round_half_up(F.col("x"), 0).alias("r0"),
        safe_divide("a", "b").alias("q"), full_name("f", "s").alias("n"), position_label("p").alias("pos"),
        snapshot_stamp("t").alias("stamp")).collect()
    assert (r[0].r2, r[0].r0, r[0].q, r[0].n, r[0].pos, r[0].stamp) == (1.01, 1.0, None, "A B", "GK", "2025-08-16T080509Z")
    assert (r[1].r2, r[1].r0, r[1].q, r[1].n, r[1].pos) == (2.5, 3.0, 1.5, None, None)
