"""Written intermediate results, in a folder that every executor can reach."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

@dataclass(frozen=True)
class _Item:
    spark: SparkSession
    name: str
    is_database: bool = False

    def remove(self) -> None:
        if self.is_database:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.name}` CASCADE")
        else:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


# Everything handed out, in order; and per thread the part of it that each open scope owns.
_handed_out: list[_Item] = []
_scopes = threading.local()


def shared_root(spark: SparkSession) -> str:
    """The session's checkpoint folder, else one beside its warehouse, which executors reach too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-scratch"


def _hand_out(item: _Item) -> str:
    _handed_out.append(item)
    for owned in getattr(_scopes, "open", [])[-1:]:
        owned.append(item)
    return item.name


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path for one intermediate result, removed by the scope or at exit."""
    path = f"{shared_root(spark)}/tunemart-{purpose}-{uuid.uuid4().hex}"
    return _hand_out(_Item(spark, path))


def new_database(spark: SparkSession) -> str:
    """A fresh database for trial tables, dropped by the scope or at exit."""
    name = f"tunemart_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{new_folder(spark, 'db')}'")
    return _hand_out(_Item(spark, name, is_database=True))


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result once and read it back, so that later jobs see the same rows
    even when executors are lost in between."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_dealt(df: DataFrame, by: str, n: int) -> DataFrame:
    """Write a result as files dealt out by a column, so that grouping by it moves no rows."""
    spark = df.sparkSession
    name = f"`{new_database(spark)}`.dealt"
    df.write.bucketBy(n, by).format("parquet").saveAsTable(name)
    return spark.table(name)


def release(items: list[_Item] | None = None) -> None:
    """Remove what was handed out, last first: all of it, or the given items."""
    for item in reversed(_handed_out[:] if items is None else items):
        item.remove()
        _handed_out.remove(item)


@contextmanager
def scope() -> Iterator[None]:
    """Remove on exit what this thread asked for inside the block."""
    owned: list[_Item] = []
    _scopes.open = [*getattr(_scopes, "open", []), owned]
    try:
        yield
    finally:
        _scopes.open = _scopes.open[:-1]
        release(owned)


@atexit.register
def _release_at_exit() -> None:
    for item in reversed(_handed_out[:]):
        try:
            release([item])
        except Exception:  # its session may be gone already
            pass
