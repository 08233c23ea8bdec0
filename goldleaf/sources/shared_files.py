"""Small files and folders of the shared file system, through the Hadoop client of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly under ``path`` in order; none where it does not exist."""
    place, fs = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    place, fs = _at(spark, path)
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet. It appears whole, by a rename, or not at all."""
    place, fs = _at(spark, path)
    if fs.exists(place):
        raise FileExistsError(path)
    folder, _, name = path.rpartition("/")
    part, _ = _at(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, place):
        fs.delete(part, False)
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    place, fs = _at(spark, path)
    fs.delete(place, True)
