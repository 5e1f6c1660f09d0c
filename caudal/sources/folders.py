"""Folders on any file system Spark can reach: what is there, and switching one for another."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def make(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.mkdirs(place)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, place = _at(spark, source)
    if not fs.rename(place, _at(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it doesn't exist."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _beside(path: str, kind: str) -> str:
    """A sibling that readers of the parent folder pass over."""
    folder, name = posixpath.split(path.rstrip("/"))
    return posixpath.join(folder, f"_{name}-{kind}-{uuid.uuid4().hex}")


def _left(spark: SparkSession, path: str, kind: str) -> list[str]:
    folder, name = posixpath.split(path.rstrip("/"))
    return [posixpath.join(folder, c) for c in children(spark, folder or ".") if c.startswith(f"_{name}-{kind}-")]


def recover(spark: SparkSession, path: str) -> None:
    """Ends a switch that was cut off between its two renames: a complete new folder takes its place, else the old one
    comes back. Where the path exists nothing is done."""
    if exists(spark, path):
        return
    old = _left(spark, path, "old")
    new = [p for p in _left(spark, path, "new") if exists(spark, f"{p}/_SUCCESS") or exists(spark, f"{p}/metadata/_SUCCESS")]
    if old:
        rename(spark, (new or old)[0], path)


def replace(spark: SparkSession, path: str, write) -> None:
    """``write(folder)`` fills a new folder beside the path, which then takes its place.

    A write that fails leaves the old content as it was; so does one that is cut off, and what it left is removed by the next
    one. Between the two renames of the switch the path is missing for a moment; `recover`, which readers and writers
    of these zones call first, ends a switch that was cut off there. One writer a path at a time.
    """
    recover(spark, path)
    for rest in (*_left(spark, path, "new"), *_left(spark, path, "old")):
        delete(spark, rest)
    fresh = _beside(path, "new")
    try:
        write(fresh)
        if exists(spark, path):
            old = _beside(path, "old")
            rename(spark, path, old)
            try:
                rename(spark, fresh, path)
            except Exception:
                rename(spark, old, path)
                raise
            delete(spark, old)
        else:
            rename(spark, fresh, path)
    except Exception:
        delete(spark, fresh)
        raise


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a text file, compressed or not; None if it is empty."""
    context = spark.sparkContext
    fs, place = _at(spark, file)
    stream = fs.open(place)
    try:
        codec = context._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(context._jsc.hadoopConfiguration()).getCodec(place)
        plain = codec.createInputStream(stream) if codec else stream
        java = context._jvm.java.io
        line = java.BufferedReader(java.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    return line
