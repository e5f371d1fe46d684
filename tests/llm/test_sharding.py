"""Extendible hashing against the textbook's splitting."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tunemart import scratch
from tunemart.llm import sharding


def key_bits(key):
    text = "\\N" if key is None else str(key)
    return f"{int(hashlib.md5(text.encode()).hexdigest()[:15], 16):060b}"


def split(rows, limit, prefix=""):
    """Shard by row, splitting a bucket over the limit on its next bit."""
    if not rows:
        return {}
    if sum(n for _, n in rows.values()) <= limit or len(rows) == 1 or len(prefix) == 60:
        return {k: prefix for k in rows}
    out = {}
    for bit in "01":
        own = {k: v for k, v in rows.items() if v[0].startswith(prefix + bit)}
        out |= split(own, limit, prefix + bit)
    return out


@pytest.mark.parametrize("limit", [1, 50, 400, 5000, 10**9])
def test_shards_equal_splitting(spark, limit):
    rng = random.Random(limit)
    sizes = {k: rng.choice([0, 1, 10, 30, 700]) for k in range(300)}
    df = spark.createDataFrame(list(sizes.items()), "k long, n long")
    found = {r.k: r for r in sharding.shard(df, "k", F.col("n"), limit).collect()}
    wanted = split({k: (key_bits(k), n) for k, n in sizes.items()}, limit)
    assert {k: r.shard for k, r in found.items()} == wanted
    for k, r in found.items():
        total = sum(sizes[j] for j in wanted if wanted[j] == wanted[k])
        assert (r.depth, r.shard_bytes, r.oversized) == (len(r.shard), total, total > limit)


def test_hot_key_is_spread_only_when_it_must_be(spark):
    rows = [(7, "x" * 10)] * 200 + [(None, None)] * 50 + [(k, "y") for k in range(50)]
    df = spark.createDataFrame(rows, "k long, t string")
    size = F.octet_length("t")
    found = sharding.shard(df, "k", size, 100).collect()
    assert sorted(str((r.k, r.t)) for r in found) == sorted(str(r) for r in rows)
    assert all(r.shard_bytes <= 100 for r in found)
    assert len({r.shard for r in found if r.k == 7}) >= 20
    assert len({r.shard for r in found if r.k is None}) == 1
    whole = sharding.shard(df, "k", size, 2100).collect()
    assert len({r.shard for r in whole if r.k == 7}) == 1


def test_written_shards(spark):
    df = spark.range(500).select("id", F.lit("abc").alias("t"))
    path = scratch.new_folder(spark, "shards")
    sharding.write_shards(df, "id", F.octet_length("t"), 100, path)
    back = spark.read.option("basePath", path).parquet(path)
    assert back.count() == 500
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length("t")).alias("n")).collect()
    assert len(sizes) > 10 and max(r.n for r in sizes) <= 100


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "k long, n long")
    assert sharding.shard(empty, "k", F.col("n"), 10).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(empty.withColumn("depth", F.lit(1)), "k", F.col("n"), 10)
