"""Threshold clustering against plain loops; the query is compared with SQL in test_llm_sql.py."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from tunemart.llm import threshold_kmeans as tk

SCHEMA = "vec_id long, embedding array<double>"


def by_hand(rows, k, rounds, dims, scale=64.0):
    kept = [
        (i, [max(-tk.MOST_UNITS, min(tk.MOST_UNITS, math.floor(x * scale))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = [[] for _ in centroids]
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(g) for x in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = [sum(d for _, c, d in found if c == n) for n in range(len(centroids))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, inertia[c], sum(inertia), shas[c]) for i, c, d in found)


def clustered(df, **options):
    found = tk.cluster(df, **options)
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted(map(tuple, found.select(*columns).collect())), found


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 12), st.integers(1, 8), st.integers(1, 40))
def test_walk_finds_the_nearest_and_smallest(seed, k, dims, spread):
    rng = np.random.default_rng(seed)
    centroids, vectors = (rng.integers(-spread, spread + 1, (n, dims)) for n in (k, 50))
    cluster, distance, worked = tk.nearest(vectors, tk.Lists.of(centroids))
    exact = ((vectors[:, None] - centroids[None]) ** 2).sum(2)
    assert (cluster == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert (worked >= 1).all() and (worked <= k).all()


def test_threshold_leaves_centroids_out():
    rng = np.random.default_rng(1)
    centroids = np.arange(64)[:, None] * 1_000 + np.zeros((1, 2), np.int64)
    vectors = centroids[rng.integers(0, 64, 500)] + rng.integers(-50, 50, (500, 2))
    assert tk.nearest(vectors, tk.Lists.of(centroids))[2].mean() < 3


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert clustered(df)[0] == by_hand(rows, 16, 3, 64)


def test_cases(spark):
    far = 3.0e38
    rows = [
        (1, [0.0, 0.0]),
        (2, [0.0, 0.0]),
        (2, [0.0, 0.0]),
        (3, [1.0, -0.001]),
        (4, [far, -far]),
        (5, None),
        (6, []),
        (7, [1.0]),
        (8, [1.0, None]),
        (9, [float("nan"), 0.0]),
        (10, [float("inf"), 0.0]),
        (11, [0.5, 0.5]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS cluster", "1 AS distance")
    found, frame = clustered(df, k=3, dims=2)
    assert found == by_hand(rows, 3, 3, 2)
    assert "n_exact" in frame.columns
    # More centroids than vectors, equal vectors, all at one place.
    same = [(i, [0.25, 0.25]) for i in range(5)]
    assert clustered(spark.createDataFrame(same, SCHEMA), k=9, dims=2)[0] == by_hand(same, 9, 3, 2)


def test_rows_without_id_and_empty_table(spark):
    rows = [(None, [9.0, 9.0]), (1, [0.0, 0.0]), (2, [1.0, 1.0])]
    found = tk.cluster(spark.createDataFrame(rows, SCHEMA), k=2, rounds=0, dims=2).collect()
    assert {(r.vec_id, r.distance) for r in found} == {(None, 2 * 512**2), (1, 0), (2, 0)}
    assert tk.cluster(spark.createDataFrame([], SCHEMA), dims=2).collect() == []
    assert tk.cluster(spark.createDataFrame([(1, [1.0])], SCHEMA), dims=2).collect() == []
