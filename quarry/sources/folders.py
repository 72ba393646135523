"""Folders of results, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, on any file system, is a folder."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def make(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def holds_files(spark: SparkSession, path: str) -> bool:
    return is_folder(spark, path) and len(_fs(spark, path)[0].listStatus(_fs(spark, path)[1])) > 0


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replace the folder ``path`` by what ``write`` puts into a new one.

    ``write`` gets a sibling path; only when it has returned is the old folder
    renamed away, the new one renamed into its place and the old one deleted.
    A write that fails leaves the old result as it was. Between the two
    renames the path is missing for a moment; where renaming is not atomic (an
    object store), read results through a table format instead.
    """
    base = path.rstrip("/")
    new, old = (f"{base}.{k}-{uuid.uuid4().hex[:12]}" for k in ("new", "old"))
    write(new)
    fs, target = _fs(spark, base)
    if fs.exists(target):
        if not fs.rename(target, _fs(spark, old)[1]):
            raise OSError(f"can't move {base} away")
    if not fs.rename(_fs(spark, new)[1], target):
        fs.rename(_fs(spark, old)[1], target)
        raise OSError(f"can't move the new result to {base}")
    if fs.exists(_fs(spark, old)[1]):
        fs.delete(_fs(spark, old)[1], True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """One small file."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that readers see whole or not at all; False, and
    nothing changed, if there is one already."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        return False
    _, new = _fs(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex[:12]}")
    stream = fs.create(new, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(new, target):
        fs.delete(new, False)
        return False
    return True
