"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.session import scratch_path


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    Each round links every node to the smallest node of its neighbourhood, first looking at larger and then
    at smaller neighbours, until nothing moves. Sums and minima are taken before the shuffle, so the hub of a
    large star is no hot key; each round is written to the shared folder, which cuts the lineage.
    """
    spark = edges.sparkSession

    def stored(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark:
            break
        mark = now
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
