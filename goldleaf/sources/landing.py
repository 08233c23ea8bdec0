"""Landing-zone writers and payload shaping (the data part of the snapshot fetcher).

The HTTP client of the reference is out of scope; these functions produce the same
files from DataFrames so the bronze readers can be exercised end to end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions.scalars import snapshot_stamp

# Timestamps are written and read with microsecond precision (Spark's JSON default keeps
# milliseconds only, which would silently change instants on a landing round trip).
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """JSON lines with lossless timestamps."""
    df.write.mode(mode).options(**JSON_TIME_OPTIONS).json(path)
    return path


def nest(parent: DataFrame, child: DataFrame, keys: Sequence[str], field: str,
         order_by: Sequence[str] | None = None, how: str = "left") -> DataFrame:
    """Attach ``child`` rows to each parent row as ``field: array<struct>``.

    Children are aggregated per key first (one shuffle), then joined to the parent, so a
    parent without children gets NULL (``how="left"``). Items are sorted by ``order_by``
    (child columns, placed first in the struct). Use it for documents whose arrays are
    bounded by the data model (lines of one order, matches of one player-season): the
    array of one key is built in one task.
    """
    first = list(order_by or [])
    value_cols = first + [c for c in child.columns if c not in keys and c not in first]
    item = F.struct(*[F.col(c) for c in value_cols])
    grouped = child.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias(field))
    return parent.join(grouped, list(keys), how)


def attach_id(ids: DataFrame, responses: DataFrame, key: str, out_key: str = "element_id") -> DataFrame:
    """``{out_key: id, **payload}`` for each id with a payload; failed pulls (no payload) are dropped.

    ``responses`` holds ``key`` and one struct column ``data``.
    """
    joined = ids.select(F.col(key)).join(responses, key, "left").where(F.col("data").isNotNull())
    return joined.select(F.col(key).alias(out_key), "data.*")


def stamped_name(prefix: str, ts: Column) -> Column:
    """``<prefix>_<yyyy-MM-ddTHHmmssZ>.json`` landing file name for a pull at ``ts``."""
    return F.concat(F.lit(f"{prefix}_"), snapshot_stamp(ts), F.lit(".json"))


def write_snapshot(df: DataFrame, landing: str, name: str, stamp: str) -> str:
    """Write one snapshot as JSON lines under ``<landing>/<name>/<name>_<stamp>/``; returns the path."""
    return write_json(df, f"{landing.rstrip('/')}/{name}/{name}_{stamp}")


def write_json_arrays(df: DataFrame, path: str, max_items: int = 50_000, max_bytes: int = 4 << 20) -> str:
    """Write ``df`` as files whose whole content is one JSON array at the root, ``[{...},{...}]`` on one line, the format of a list endpoint.

    Every task packs its rows in the order it gets them: an array is closed before it would exceed ``max_bytes`` characters or ``max_items`` rows (one
    row larger than that is an array of its own). Nothing is shuffled or counted, no key is special, and all files lie in one folder. No rows
    make no file. Readable in line mode and with ``multiLine``.
    """
    import pyarrow as pa

    def pack(batches):
        held, size = [], 0
        for batch in batches:
            for item in batch.column(0).to_pylist():
                if held and (size + len(item) + len(held) + 2 > max_bytes or len(held) >= max_items):
                    yield pa.RecordBatch.from_arrays([pa.array([f"[{','.join(held)}]"])], names=["value"])
                    held, size = [], 0
                held.append(item)
                size += len(item)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([f"[{','.join(held)}]"])], names=["value"])

    items = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_TIME_OPTIONS).alias("item"))
    items.mapInArrow(pack, "value string").write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)
    return path


def write_seasons(df: DataFrame, landing: str, season_col: str = "season") -> str:
    """Season-partitioned CSV landing layout with a header row, one folder per season."""
    path = f"{landing.rstrip('/')}/historical"
    df.write.mode("errorifexists").option("header", True).partitionBy(season_col).csv(path)
    return path
