"""Small files and folders on the file system that driver and executors share."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import SparkSession

# A local file system looks before it renames, so that threads of one driver take turns.
_one_at_a_time = threading.Lock()


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = _path(spark, path)
    return fs.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    fs, found = _path(spark, path)
    fs.delete(found, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the target must not be there, its folder is made."""
    fs, old = _path(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if fs.exists(new) or not fs.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, in order; nothing if it is not there."""
    fs, found = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(found)) if fs.exists(found) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, found = _path(spark, path)
    stream = fs.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file all at once; False if there is one already.

    The text is written aside and renamed without overwriting, which a distributed file system
    lets only one writer do.
    """
    fs, target = _path(spark, path)
    fs.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    renames = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    with _one_at_a_time:
        try:
            context.rename(fs.makeQualified(aside), fs.makeQualified(target), renames)
            return True
        except Exception:
            if not fs.exists(target):
                raise
            fs.delete(aside, False)
            return False
