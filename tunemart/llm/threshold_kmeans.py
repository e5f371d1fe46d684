"""Centroid clustering whose assignments come from the threshold algorithm.

For each dimension the centroids are sorted by their value there. From a vector's own value such a
list is walked outward, the nearer side first, in all dimensions at the same depth. A centroid that
is met for the first time gets its exact distance. One that no list has shown yet is at least as far
in each dimension as that list's last step, so once the sum of these frontier distances strictly
exceeds the best exact distance, no unseen centroid can be nearer or as near, and the walk ends.

All vectors of a block walk together and leave as they end. Vectors stay distributed; a round sends
the centroids (k times the dimensions) out and one sum for each of their components back.

Defined cases: vectors that are NULL, of another length, or hold NULL or non-finite components are
left out; components are held within 2^27 units, so that a squared distance fits a long; ties go to
the smaller centroid; an empty centroid stays where it is; fewer vectors than centroids make as many
centroids as there are vectors; equal ids are told apart by their vectors, rows without an id can
become centroids only after all others; an empty table gives an empty one; other columns of the
input are not read, so that their names don't matter, but a kept column may not be called like an
added one. A sum that does not fit a long is NULL.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunemart import scratch

# Units that a component may be away from 0.
MOST_UNITS = 2**27
# Vectors that walk together.
BLOCK = 2_048


@dataclass
class Lists:
    """Centroids, and for each dimension their values in order and whose they are."""

    centroids: np.ndarray
    values: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Lists:
        owners = np.argsort(centroids, axis=0, kind="stable")
        return cls(centroids, np.take_along_axis(centroids, owners, 0), owners)


def nearest(vectors: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, squared distance, exact distances worked out) of each vector's nearest centroid."""
    n, dims = vectors.shape
    k = len(lists.centroids)
    best = np.full(n, np.iinfo(np.int64).max)
    cluster, worked = np.full(n, k), np.zeros(n, np.int64)
    at = np.arange(dims)
    # The next entry of each list upward and the one downward of the vector's value.
    up = np.empty((n, dims), np.int64)
    for d in range(dims):
        up[:, d] = np.searchsorted(lists.values[:, d], vectors[:, d])
    down = up - 1
    seen = np.zeros((n, k), bool)
    walking = np.arange(n)
    far = np.iinfo(np.int64).max
    for _ in range(k):
        x, high, low = vectors[walking], up[walking], down[walking]
        above = np.where(high < k, np.abs(lists.values[np.minimum(high, k - 1), at] - x), far)
        below = np.where(low >= 0, np.abs(x - lists.values[np.maximum(low, 0), at]), far)
        upward = above <= below
        met = lists.owners[np.where(upward, np.minimum(high, k - 1), np.maximum(low, 0)), at]
        up[walking] += upward
        down[walking] -= ~upward
        new = np.zeros((len(walking), k), bool)
        new[np.arange(len(walking))[:, None], met] = True
        new &= ~seen[walking]
        seen[walking] |= new
        who, which = np.nonzero(new)
        exact = np.full((len(walking), k), far)
        exact[who, which] = ((x[who] - lists.centroids[which]) ** 2).sum(1)
        worked[walking] += new.sum(1)
        nearest_new = exact.argmin(1)
        distance = exact[np.arange(len(walking)), nearest_new]
        better = (distance < best[walking]) | ((distance == best[walking]) & (nearest_new < cluster[walking]))
        best[walking[better]], cluster[walking[better]] = distance[better], nearest_new[better]
        frontier = (np.minimum(above, below) ** 2).sum(1)
        walking = walking[frontier <= best[walking]]
        if not len(walking):
            break
    return cluster, best, worked


def whole_numbers(df: DataFrame, vec_id: str, vector: str, dims: int, scale: float) -> DataFrame:
    """(vec_id, packed) of the usable vectors: floor(scale * component) as little-endian longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                units = np.floor(flat.astype(np.float64) * scale)
            held = np.clip(units, -MOST_UNITS, MOST_UNITS).astype("<i8").reshape(batch.num_rows, dims)
            packed = pa.array([row.tobytes() for row in held], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packed], names=["vec_id", "packed"])

    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    usable = df.filter((F.size(vector) == dims) & finite).select(F.col(vec_id).alias("vec_id"), value.alias("v"))
    schema = T.StructType([T.StructField("vec_id", df.schema[vec_id].dataType), T.StructField("packed", T.BinaryType())])
    return usable.mapInArrow(run, schema)


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of `<seed>:<vec_id>`."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(drawn.asc_nulls_last(), "packed").limit(k).select("packed").collect()  # k rows
    return np.array([np.frombuffer(r.packed, "<i8") for r in first], np.int64)


def _unpacked(packed: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), "<i8").reshape(-1, dims)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at floor(sum / count) of the vectors that are nearest to it."""
    k, dims = centroids.shape
    shared = vectors.sparkSession.sparkContext.broadcast(Lists.of(centroids))  # k * dims numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), object)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                block = _unpacked(batch.column(0).slice(start, BLOCK), dims)
                cluster = nearest(block, shared.value)[0]
                for c in np.unique(cluster):
                    own = block[cluster == c]
                    counts[c] += len(own)
                    sums[c] += own.sum(0)  # 2^11 times 2^27 at most
        used = np.flatnonzero(counts)
        columns = [
            pa.array(np.repeat(used, dims), pa.int32()),
            pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
            pa.array([str(x) for x in sums[used].ravel()], pa.string()),
            pa.array(np.repeat(counts[used], dims), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "dim", "total", "n"])

    parts = vectors.select("packed").mapInArrow(run, "cluster int, dim int, total string, n long")
    sums = parts.groupBy("cluster", "dim").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    moved = centroids.copy()
    for row in sums.collect():  # k * dims rows
        moved[row.cluster, row.dim] = int(row.total) // row.n
    return moved


def _assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, n_exact) of all vectors."""
    dims = centroids.shape[1]
    shared = vectors.sparkSession.sparkContext.broadcast(Lists.of(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                cluster, distance, worked = nearest(_unpacked(part.column(1), dims), shared.value)
                found = [pa.array(cluster, pa.int32()), pa.array(distance), pa.array(worked, pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *found], names=["vec_id", "cluster", "distance", "n_exact"]
                )

    added = T.StructType().add("cluster", T.IntegerType()).add("distance", T.LongType()).add("n_exact", T.IntegerType())
    return vectors.mapInArrow(run, T.StructType([vectors.schema["vec_id"], *added.fields]))


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    df: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: float = 64.0,
    seed: str = "1",
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(vec_id, cluster, distance, n_exact, cluster_inertia, inertia, centroid_sha256).

    `n_exact` tells for how many centroids a vector needed its exact distance; the rest were left
    out by the threshold. Centroids start at the k vectors whose hash is smallest.
    """
    spark = df.sparkSession
    vectors = scratch.materialize(whole_numbers(df, vec_id, vector, dims, scale), "vectors")
    centroids = first_centroids(vectors, k, seed).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(vectors, centroids)
    if len(centroids):
        found = scratch.materialize(_assigned(vectors, centroids), "assigned")
    else:
        found = vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0 AS n_exact")
    digests = spark.createDataFrame([(c, digest(x)) for c, x in enumerate(centroids)], "cluster int, centroid_sha256 string")
    total: Column = F.try_sum("distance")
    by_cluster = found.groupBy("cluster").agg(total.alias("cluster_inertia")).join(digests, "cluster")
    inertia = found.agg(total).first()[0]
    return found.join(F.broadcast(by_cluster), "cluster").withColumn("inertia", F.lit(inertia).cast("long"))  # k rows
