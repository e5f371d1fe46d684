"""Cover-tree pairs against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunemart.llm import covertree


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def clusters(rng, n=600, size=16):
    centers = rng.normal(size=(12, size))
    spread = rng.choice([0.02, 0.1, 0.4, 2.0], size=(n, 1))
    return unit(centers[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, size)))


def check_node(points, node):
    distance = np.linalg.norm(points[node.rows] - node.center, axis=1)
    assert distance.max() <= node.radius + 1e-6
    if node.children:
        assert sorted(np.concatenate([c.rows for c in node.children])) == sorted(node.rows)
        for child in node.children:
            check_node(points, child)


def test_tree_covers_and_traversal_loses_nothing():
    rng = np.random.default_rng(0)
    a, b = clusters(rng), clusters(rng, 300)
    tree_a, tree_b = (covertree.build(x, leaf=8, children=300) for x in (a, b))
    assert tree_a.children
    check_node(a, tree_a)
    for threshold in (0.5, 0.95, 0.999):
        met = set()
        visited = 0
        for rows_a, rows_b in covertree.dual(tree_a, tree_b, covertree.reach_of(threshold)):
            visited += len(rows_a) * len(rows_b)
            met |= {(i, j) for i in rows_a for j in rows_b}
        wanted = {*zip(*np.nonzero(a @ b.T >= threshold))}
        assert wanted <= met
        if threshold == 0.999:
            assert visited < 0.7 * len(a) * len(b)


def plain(ids, vectors, threshold):
    n = len(ids)
    usable = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors
    ]
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and usable[i] and usable[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(vectors[k], float) / np.abs(vectors[k]).max() for k in (i, j))
                linked[i, j] = a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
    label = np.arange(n)
    for _ in range(n):
        label = np.array([min([label[i], *label[linked[i]]]) for i in range(n)])
    groups = {k: [ids[i] for i in np.flatnonzero(label == k) if ids[i] is not None] for k in label}
    return [(ids[i], int(linked[i].sum()), min(groups[label[i]], default=None)) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"block": 40, "cells": 4, "sample": 60}])
def test_all_pairs_and_odd_vectors(spark, options):
    rng = np.random.default_rng(1)
    vectors = clusters(rng, 230, 6).tolist()
    vectors += [vectors[0]] * 5 + [(3 * np.array(vectors[1])).tolist()]
    vectors += [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5]
    vectors += [[1e-200] * 6, [1e200] * 6, [1.0, 1.0], [2.0, 2.0], [1.0, -1.0]]
    ids = [*range(1000, 1000 + len(vectors))]
    ids[3], ids[5], ids[7] = None, None, 1000
    rows = list(zip(ids, vectors))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash"))
    found = covertree.near_duplicates(df.repartition(3), threshold=0.95, **options).collect()
    text = lambda x: str(tuple(x))
    assert sorted(text(r[:3]) for r in found) == sorted(map(text, plain(ids, vectors, 0.95)))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)


def test_a_crowd_within_reach(spark):
    rng = np.random.default_rng(2)
    vectors = unit(rng.normal(size=(1, 8)) + 1e-3 * rng.normal(size=(300, 8))).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    found = covertree.near_duplicates(df, block=50).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(299, 0)}


def test_empty_table(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
