"""Small file operations through Hadoop's FileSystem, so any Spark path works."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _at(spark, source)
    if not fs.rename(p, _at(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    row = spark.read.text(path, wholetext=True).first()
    return None if row is None else row["value"]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it into place.

    A reader sees no file or the whole file. An existing file is replaced, which takes a moment
    without it; files that must never be missing get a new name for every version.
    """
    fs, p = _at(spark, path)
    tmp = _at(spark, f"{path}.tmp")[1]
    fs.mkdirs(p.getParent())
    stream = fs.create(tmp, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not write {path}")


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if another writer was first.

    The text is written under a name of its own and moved into place by a rename that never replaces a file, so a
    reader sees no file or the whole one, and of two writers exactly one succeeds.
    """
    fs, p = _at(spark, path)
    tmp = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")[1]
    fs.mkdirs(p.getParent())
    stream = fs.create(tmp, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(tmp, p, options)
    except Py4JJavaError as error:
        fs.delete(tmp, False)
        if fs.exists(p):
            return False
        raise OSError(f"could not write {path}") from error
    return True


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it exists already."""
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    try:
        fs.create(p, False).close()
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    return True


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since the last change of a file or folder."""
    fs, p = _at(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000.0
