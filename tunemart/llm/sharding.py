"""Extendible hashing: shards by hash prefix, each only as long as its bytes require.

All rows start in one bucket. A bucket over the limit is split on the next bit of its rows'
hash, others stay, until every bucket fits. The directory has a row for each shard: the bits of
its prefix. Byte totals come from aggregates over prefixes, which combine before the shuffle.

A row's hash is a string of bits: 60 of its key's MD5 and, behind them, 60 of its place in the
written keys. So rows of one key stay together until that key alone is over the limit, and
only then are spread.

Defined cases: a NULL key is a key of its own; a NULL payload has no bytes; a single row over the
limit is a shard of its own, marked `oversized`; equal rows may be spread over shards but are
never lost or doubled; an empty table has no shards. Added columns are shard, depth,
shard_bytes and oversized; input columns of these names are an error.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunemart import scratch

WORD = 60  # bits of each of the two hash words
STEP = 6  # bits by which buckets are counted finer than an even directory would need
ADDED = ("shard", "depth", "shard_bytes", "oversized")


def bits(word: Column) -> Column:
    """60 bits of a non-negative integer as text."""
    return F.lpad(F.bin(word), WORD, "0")


def key_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key as text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("\\N")).cast("binary"))
    return bits(F.conv(F.substring(digest, 1, WORD // 4), 16, 10).cast("long"))


def place_bits() -> Column:
    """60 bits of a hash of the row's place in its partition's files."""
    return bits(F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - WORD))


def directory(hashed: DataFrame, limit: int) -> DataFrame:
    """(shard, depth, shard_bytes, oversized) for rows of (bits, n_bytes).

    One pass counts bytes by prefixes somewhat longer than even data would need, and their sums
    over each shorter prefix give the directory. Prefixes that are still over the limit are
    counted again by longer ones, from their rows only; a bucket all of whose rows begin with
    the same bits goes on behind these at once.
    """
    total, rows = hashed.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.count("*")).first()
    start, found = 0, []
    open_rows = hashed.withColumn("parent", F.lit(""))
    longest = 2 * WORD
    while rows:
        depth = min(longest, start + max(1, ceil(log2(max(1, total / limit)))) + STEP)
        cells = open_rows.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(
            F.sum("n_bytes").alias("n_bytes"),
            F.count("*").alias("n_rows"),
            F.min("bits").alias("low"),
            F.max("bits").alias("high"),
        )
        cells = scratch.materialize(cells, "cells")
        # All prefixes of the cells, shortest first, with what they hold.
        lengths = F.sequence(F.lit(start), F.lit(depth))
        spread = cells.select("*", F.explode(lengths).alias("depth"))
        sums = spread.groupBy(F.expr("substring(cell, 1, depth)").alias("shard"), "depth").agg(
            F.sum("n_bytes").alias("shard_bytes"), F.sum("n_rows").alias("n_rows")
        )
        fits = (F.col("shard_bytes") <= limit) | (F.col("n_rows") == 1) | (F.col("depth") == longest)
        leaves = scratch.materialize(_topmost(sums.withColumn("fits", fits), start), "leaves")
        found.append(leaves.filter("fits").select("shard", "depth", "shard_bytes"))
        over = leaves.filter("NOT fits").select(F.col("shard").alias("cell"), "shard_bytes")
        total, rows = over.agg(F.coalesce(F.max("shard_bytes"), F.lit(0)), F.count("*")).first()
        if rows:
            kept = F.substring("bits", 1, depth)
            open_rows = open_rows.join(over.select(F.col("cell").alias("_cell")), kept == F.col("_cell"), "left_semi")
            open_rows = scratch.materialize(open_rows, "open")
            alike = F.filter(
                F.sequence(F.lit(1), F.lit(longest)),
                lambda k: F.substring(F.col("low"), F.lit(1), k) == F.substring(F.col("high"), F.lit(1), k),
            )
            start = cells.join(over, "cell", "left_semi").agg(F.min(F.size(alike))).first()[0]
    if not found:
        return hashed.sparkSession.createDataFrame([], "shard string, depth int, shard_bytes long, oversized boolean")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumn("oversized", F.col("shard_bytes") > limit)


def _topmost(sums: DataFrame, start: int) -> DataFrame:
    """Of the prefixes: those that fit and whose parent does not, and the longest that do not."""
    parent = sums.filter("NOT fits").select(F.col("shard").alias("_p"), F.col("depth").alias("_d"))
    longest = sums.agg(F.max("depth").alias("_longest"))
    split = (F.expr("substring(shard, 1, depth - 1)") == F.col("_p")) & (F.col("depth") - 1 == F.col("_d"))
    below = sums.filter(F.col("depth") > start).join(parent, split, "left_semi").filter("fits")
    root = sums.filter((F.col("depth") == start) & F.col("fits")) if start == 0 else sums.filter("false")
    stuck = sums.filter("NOT fits").join(F.broadcast(longest), F.col("depth") == F.col("_longest")).drop("_longest")
    return below.unionByName(root).unionByName(stuck)


def shard(df: DataFrame, key: str, n_bytes: Column, limit: int) -> DataFrame:
    """All rows and columns with the row's shard, the shard's depth and bytes, and whether it is
    over the limit.

    Pass only the columns that are wanted back: they are written once with their hash. A row
    finds its shard by an equi-join on its prefixes of the lengths that the directory has.
    """
    own = {"_bits", "_n_bytes", *ADDED}
    if clash := own & {*df.columns}:
        raise ValueError(f"columns {sorted(clash)} are added here; rename them first")
    size = F.coalesce(n_bytes.cast("long"), F.lit(0)).alias("_n_bytes")
    hashed = df.select("*", size, F.concat(key_bits(F.col(key)), place_bits()).alias("_bits"))
    placed = scratch.materialize(hashed, "hashed")
    thin = placed.select(F.col("_bits").alias("bits"), F.col("_n_bytes").alias("n_bytes"))
    shards = scratch.materialize(directory(thin, limit), "directory")
    depths = sorted(r[0] for r in shards.select("depth").distinct().collect())  # 121 at most
    prefixes = F.array(*[F.substring("_bits", 1, d) if d else F.lit("") for d in depths])
    tried = placed.select("*", F.explode(prefixes).alias("shard"))
    return tried.join(shards, "shard").select(*df.columns, *ADDED)


def write_shards(df: DataFrame, key: str, n_bytes: Column, limit: int, path: str) -> None:
    """One folder per shard, in Parquet; a task writes whole shards.

    Folders are named `shard=b` and the bits, so that readers do not take the bits for a number.
    """
    named = shard(df, key, n_bytes, limit).withColumn("shard", F.concat(F.lit("b"), "shard"))
    named.repartition("shard").write.partitionBy("shard").parquet(path)
