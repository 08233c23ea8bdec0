"""Tables that are rewritten bucket by bucket and published by a manifest.

Rows are dealt to buckets by a hash of some columns. A change rewrites only the buckets it touches, into a folder of the new
version, and then publishes a manifest that names the live folder of every bucket. Readers open the folders the manifest names and nothing else,
so a write that fails, or is still running, is never seen. Old manifests, and the folders that only they name, are deleted. There is one writer at a time.

* ``merge_changes`` / ``merge_stream``: keyed upsert (SCD type 1, both NULL rules) of a batch or a stream.
* ``refresh_view``: a stored view brought up to date by recomputing the buckets that changed in its source.
* ``replace_generation``: full refresh of any stored table with its checkpoint, old one live until the new one is whole.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators import cdc
from goldleaf.sources import shared_files

BUCKET = "__bucket"


@dataclass(frozen=True)
class Manifest:
    """One published state: the version in which each bucket was last written, its schema, and what has been read to get there."""

    version: int
    schema: str
    live: dict[int, int]
    #: per source stream: its last batch that is in the table
    batches: dict[str, int] = field(default_factory=dict)
    #: of a view: the buckets' versions in its source
    source: dict[int, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def of(text: str) -> Manifest:
        d = json.loads(text)
        return Manifest(d["version"], d["schema"], {int(k): v for k, v in d["live"].items()}, d["batches"], {int(k): v for k, v in d["source"].items()})


@dataclass(frozen=True)
class BucketTable:
    """A table at ``path`` in ``n_buckets`` buckets by the hash of ``bucket_by``. ``keep`` versions stay readable, for readers that still run."""

    spark: SparkSession
    path: str
    bucket_by: tuple[str, ...]
    n_buckets: int = 64
    keep: int = 3

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.n_buckets)).cast("int")

    def _file(self, version: int) -> str:
        return f"{self.path}/manifest/{version:012d}.json"

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in shared_files.names(self.spark, f"{self.path}/manifest") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest published state (or that of ``version``); None before the first."""
        known = self.versions()
        if not known:
            return None
        return Manifest.of(shared_files.read_text(self.spark, self._file(known[-1] if version is None else version)))

    def read(self, buckets: Iterable[int] | None = None, manifest: Manifest | None = None) -> DataFrame | None:
        """The rows of all (or the given) buckets of the newest (or the given) state; None before the first."""
        m = manifest or self.manifest()
        if m is None:
            return None
        schema = T.StructType.fromJson(json.loads(m.schema))
        wanted = sorted(m.live if buckets is None else m.live.keys() & set(buckets))
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/v={m.live[b]}/{BUCKET}={b}" for b in wanted])

    def publish(self, rows: DataFrame, touched: Iterable[int], batches: dict[str, int] | None = None, source: dict[int, int] | None = None) -> Manifest:
        """Replace the touched buckets by ``rows`` and publish the result as the next version.

        A bucket's rows are spread over as many tasks as their size needs. A write left behind by a failed attempt at the same version is overwritten.
        """
        old = self.manifest() or Manifest(0, "", {})
        version, folder = old.version + 1, f"{self.path}/data/v={old.version + 1}"
        rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        written = {int(n.partition("=")[2]) for n in shared_files.names(self.spark, folder) if n.startswith(f"{BUCKET}=")}
        gone = set(touched)
        if written - gone:
            raise ValueError(f"rows of buckets that are not replaced: {sorted(written - gone)[:5]}")
        new = Manifest(version, rows.schema.json(), {b: v for b, v in old.live.items() if b not in gone} | dict.fromkeys(sorted(written), version),
                       old.batches | (batches or {}), old.source if source is None else source)
        shared_files.write_new(self.spark, self._file(version), new.text())
        self.expire()
        return new

    def expire(self) -> None:
        """Delete all but the newest ``keep`` versions, and the bucket folders that no kept version names."""
        known = self.versions()
        old, kept = known[:-self.keep], known[-self.keep:]
        if not old:
            return
        live = {(b, v) for k in kept for b, v in self.manifest(k).live.items()}
        for k in old:
            for b, v in self.manifest(k).live.items():
                if (b, v) not in live:
                    shared_files.delete(self.spark, f"{self.path}/data/v={v}/{BUCKET}={b}")
                    if not any(n.startswith(BUCKET) for n in shared_files.names(self.spark, f"{self.path}/data/v={v}")):
                        shared_files.delete(self.spark, f"{self.path}/data/v={v}")
            shared_files.delete(self.spark, self._file(k))


def merge_changes(table: BucketTable, changes: DataFrame, keys: Sequence[str], sequence_by, ignore_null_updates: bool = False,
                  source: str = "batch", batch_id: int | None = None) -> Manifest | None:
    """Upsert a batch of changes (SCD type 1, see ``cdc``) and publish the new version.

    The table holds the state of ``cdc`` (values with the sequences that set them), so arrival order does not matter. Only buckets with a changed key are
    read and rewritten; ``bucket_by`` must be among the keys. A batch whose id is not above the source's last one is in the table already and
    changes nothing, so a replay after a crash is harmless. Fields that are new in the changes become columns, NULL in older rows.
    """
    if not set(table.bucket_by) <= set(keys):
        raise ValueError("bucket_by must be among the keys")
    m = table.manifest()
    if m is not None and batch_id is not None and m.batches.get(source, -1) >= batch_id:
        return m
    incoming = cdc.scd1_state(changes, keys, sequence_by, ignore_null_updates).persist()
    try:
        touched = [r[0] for r in incoming.select(table.bucket()).distinct().collect()]  # at most n_buckets
        if not touched:
            return m
        rows = incoming
        if m is not None:
            old = table.read(touched, m)
            # Rows of a bucket already meet in one task by key; the changes are reduced before, so no key is hot here.
            rows = cdc.reduce_state(old.unionByName(incoming, allowMissingColumns=True), keys, ignore_null_updates)
        return table.publish(rows, touched, {source: batch_id} if batch_id is not None else None)
    finally:
        incoming.unpersist()


def merge_stream(table: BucketTable, changes: DataFrame, keys: Sequence[str], sequence_by, checkpoint: str, ignore_null_updates: bool = False,
                 source: str = "stream") -> int:
    """Upsert what a change stream has brought since the last run; the number of micro-batches run.

    The table itself is the state: nothing is kept in the state store, and no log grows.
    """
    ran = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        ran.append(batch_id)
        merge_changes(table, batch, keys, sequence_by, ignore_null_updates, source, batch_id)

    changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start().awaitTermination()
    return len(ran)


def current_rows(table: BucketTable) -> DataFrame:
    """The readable rows of an upserted table."""
    rows = table.read()
    if rows is None:
        raise FileNotFoundError(f"nothing published under {table.path}")
    return cdc.current(rows)


def refresh_view(view: BucketTable, source: BucketTable, define: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Bring a stored view up to its source's newest version; the buckets that were recomputed.

    ``define`` maps rows of the source to rows of the view and must need, for a view row, only source rows with the same ``bucket_by`` values (windows and
    groups by them, or finer). Buckets whose version in the source is the one the view has read are neither read nor written.
    """
    if (view.bucket_by, view.n_buckets) != (source.bucket_by, source.n_buckets):
        raise ValueError("a view has the buckets of its source")
    now, before = source.manifest(), view.manifest()
    if now is None:
        raise FileNotFoundError(f"nothing published under {source.path}")
    seen = before.source if before else {}
    changed = sorted(b for b in now.live.keys() | seen.keys() if now.live.get(b) != seen.get(b))
    if changed or before is None:
        view.publish(define(source.read(changed, now)), changed, source=now.live)
    return changed


def live_generation(spark: SparkSession, path: str) -> str | None:
    """Folder of the generation that is live under ``path``; None before the first."""
    known = [n for n in shared_files.names(spark, f"{path}/live") if n.isdigit()]
    return f"{path}/gen={int(known[-1])}" if known else None


def replace_generation(spark: SparkSession, path: str, build: Callable[[str], object]) -> str:
    """Full refresh: ``build(folder)`` makes the data and checkpoints of a new generation, which then replaces the live one.

    While it runs, and if it fails, the live generation stays as it is; what a failed run left is deleted by the next. The replaced generation
    is kept until the refresh after next, for readers that still run.
    """
    known = [int(n) for n in shared_files.names(spark, f"{path}/live") if n.isdigit()]
    folder = f"{path}/gen={(known[-1] if known else 0) + 1}"
    shared_files.delete(spark, folder)
    build(folder)
    shared_files.write_new(spark, f"{path}/live/{(known[-1] if known else 0) + 1:012d}", "")
    for old in known[:-1]:
        shared_files.delete(spark, f"{path}/live/{old:012d}")
        shared_files.delete(spark, f"{path}/gen={old}")
    return folder
