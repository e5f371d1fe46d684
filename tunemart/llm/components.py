"""Connected components of a graph given as edges, without gathering any of it in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemart import scratch


def _state(edges: DataFrame) -> tuple[int, int | None]:
    """Number of edges and a sum over them: equal if and, but for chance, only if they are."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to its smallest one."""
    if large:
        arcs = edges.union(edges.select("v", "u")).toDF("u", "v")
    else:
        arcs = edges
    lowest = arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = arcs.join(lowest, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = moved.union(lowest.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of an edge (u, v), root the smallest node it is linked to.

    Edges are turned into stars by linking, in turns, each node's larger and smaller
    neighbours to its smallest neighbour. The number of edges never grows, a node with many
    edges is met by joins that adaptive execution splits, and the rounds follow the logarithm
    of the longest path. Each round is written, so that lost executors cost one round.

    Loops, repeated edges and either direction are allowed; edges with a NULL end are none.
    """
    clean = edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").select("u", "v")
    ordered = clean.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = scratch.materialize(ordered, "edges")
    before = _state(now)
    while before[0]:
        now = scratch.materialize(_step(_step(now, large=True), large=False), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.union(now.select("v", "v").distinct())
