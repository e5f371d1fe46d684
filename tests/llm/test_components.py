from __future__ import annotations

import random

from tunemart.llm.components import connected_components


def test_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 40)]
    edges += [(7, 7), (8, 5), (None, 3), (70, None)] + [(k, 200 + k) for k in range(50, 60)]
    random.Random(2).shuffle(edges)
    found = {tuple(r) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    wanted = {(k, 100) for k in range(100, 161)} | {(k, 5) for k in range(5, 40)}
    wanted |= {(k, k % 200) for j in range(50, 60) for k in (j, 200 + j)}
    assert found == wanted


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
