"""Session settings, and sizing of shuffles and buckets from the input."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Song metadata comes as one small file per song: pack many into one task.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
    # Of a field that is given twice in a record the last one counts, by name and by path.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A load parts its records by verdict without sorting them by it.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # The five loads of the star schema share the cluster.
    "spark.scheduler.mode": "FAIR",
}

# Raw input per shuffle partition and per bucket: the shuffled columns of a log record are
# a fraction of its JSON text. Both numbers follow the input at any size; a limit that a
# cluster needs is a setting of the load (`max_partitions`, `max_buckets`).
INPUT_PER_PARTITION = 512 * 1024**2
INPUT_PER_BUCKET = 4 * 1024**3
LEAST_BUCKETS = 8

# What text takes beside its compressed size, about, by the ending of the file.
COMPRESSED = {"gz": 8, "bz2": 10, "zst": 8, "xz": 10, "lz4": 4, "snappy": 4, "deflate": 8}


def build_session(app_name: str = "tunemart", master: str | None = None, **conf) -> SparkSession:
    """Create or fetch a session with the settings of this package."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def input_bytes(spark: SparkSession, *locations: str | list[str]) -> int:
    """Bytes of text in the files below some paths, from their listing alone."""
    ending = F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)
    grown = F.coalesce(F.create_map(*[F.lit(x) for kv in COMPRESSED.items() for x in kv])[ending], F.lit(1))
    total = 0
    for location in locations:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
        total += files.select("path", "length").agg(F.sum(F.col("length") * grown)).first()[0] or 0
    return total


def partitions_for(nbytes: int, most: int | None = None) -> int:
    """Shuffle partitions for a load of `nbytes` of raw input."""
    wanted = max(1, ceil(nbytes / INPUT_PER_PARTITION))
    return min(wanted, most or wanted)


def bucket_count_for(nbytes: int, most: int | None = None) -> int:
    """Buckets of the placed tables for a load of `nbytes` of raw input."""
    wanted = max(LEAST_BUCKETS, ceil(nbytes / INPUT_PER_BUCKET))
    return min(wanted, most or wanted)


@contextmanager
def shuffle_partitions(spark: SparkSession, wanted: int) -> Iterator[None]:
    """Raise the session's shuffle partitions inside the block, and set them back.

    Adaptive execution merges what turns out too small, so they are never lowered.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(key, before)
