"""Exact cosine pairs of embeddings by dual traversal of cover trees.

Unit vectors with cosine >= t lie within sqrt(2 - 2t) of each other. A cover tree holds points
in nested levels: a node covers its points within a radius, its children within half of it. Two
nodes whose centres are further apart than their radii and that distance together hold no pair,
and are dropped with all below them; nodes that cannot be split are compared point by point.

1. Equal vectors become one row with a count.
2. A tree over a bounded sample of the vectors gives cells. Every vector goes to the cell with
   the nearest centre; covering radii are the largest distances met, over all vectors.
3. A traversal of the cells with themselves names the pairs of cells that may hold links.
4. Cells are cut into blocks of bounded size. Each pair of blocks in such a pair of cells is one
   task: a dual traversal of the trees of both blocks.
5. A pair of blocks returns, per vector, its number of links and one linked vector that stands
   for its component in the pair, never the links themselves. Components follow from these.

Vectors that are NULL, zero or hold NULL or non-finite components link with nothing; vectors of
different length do not link with each other. Other columns are not looked at. Rows repeated
under one id count as vectors of their own; a NULL id has a row, but names no component.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunemart import scratch
from tunemart.llm.components import connected_components

THRESHOLD = 0.95
SAMPLE = 4_096  # vectors that the cells are fitted to, at most
CELLS = 256  # at most
BLOCK = 4_096  # vectors in a block, about
LEAF = 64  # points in a node that is not split
CHILDREN = 64  # of a node, at most: beyond, halving the radius does not pay
SLACK = 1e-7  # by which distances may be off; the pairs themselves are decided by cosine


class Node:
    """Points (by row) within `radius` of `center`."""

    __slots__ = ("rows", "center", "radius", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray, center: np.ndarray):
        self.rows, self.center, self.children = rows, center, []
        self.radius = float(np.sqrt(np.max(_squares(points[rows], center[None, :]), initial=0.0)))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors."""
    return np.maximum(2.0 - 2.0 * (a @ b.T), 0.0)


def cover(points: np.ndarray, rows: np.ndarray, radius: float, most: int) -> tuple[list[int], np.ndarray] | None:
    """Centres among `rows` such that every row lies within `radius` of its nearest one.

    The next centre is the row furthest from all before it, so that centres are more than
    `radius` apart. None if that takes more than `most` centres.
    """
    centers = [int(rows[0])]
    near = _squares(points[rows], points[centers[0]][None, :])[:, 0]
    of = np.zeros(len(rows), np.int64)
    while near.max() > radius * radius:
        if len(centers) == most:
            return None
        centers.append(int(rows[near.argmax()]))
        closer = _squares(points[rows], points[centers[-1]][None, :])[:, 0]
        of[closer < near] = len(centers) - 1
        near = np.minimum(near, closer)
    return centers, of


def build(
    points: np.ndarray,
    rows: np.ndarray | None = None,
    scale: float = 2.0,
    leaf: int = LEAF,
    children: int = CHILDREN,
) -> Node:
    """The cover tree of some unit vectors: from level to level radii are halved.

    A node stays a leaf if it has few points, or if a cover of half its radius would take very
    many nodes, as it does where all points are about as far from each other.
    """
    rows = np.arange(len(points)) if rows is None else rows
    node = Node(points, rows, points[rows[0]])
    scale = min(scale, node.radius)
    while len(rows) > leaf and scale > 1e-6:
        scale /= 2
        found = cover(points, rows, scale, children)
        if found is None:
            break
        centers, of = found
        if len(centers) > 1:
            node.children = [build(points, rows[of == k], scale, leaf, children) for k in range(len(centers))]
            break
    return node


def dual(a: Node, b: Node, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of a, rows of b) of the leaves between which pairs within `reach` may lie."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        apart = float(np.linalg.norm(a.center - b.center))
        if apart - a.radius - b.radius > reach + SLACK:
            continue
        if a.children and (a.radius >= b.radius or not b.children):
            stack += [(child, b) for child in a.children]
        elif b.children:
            stack += [(a, child) for child in b.children]
        else:
            yield a.rows, b.rows


def reach_of(threshold: float) -> float:
    return sqrt(max(0.0, 2.0 - 2.0 * threshold))


def linked(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of a, rows of b, matrix of links) for the leaf pairs that hold any.

    With `same`, both are one block; a pair of rows is then met in both orders, or both within
    one leaf, and a row is not linked with itself.
    """
    reach = reach_of(threshold)
    tree_a = build(a)
    tree_b = tree_a if same else build(b)
    for rows_a, rows_b in dual(tree_a, tree_b, reach):
        for k in range(0, len(rows_a), 1_024):
            part = rows_a[k : k + 1_024]
            links = a[part] @ b[rows_b].T >= threshold
            if same:
                links &= part[:, None] != rows_b[None, :]
            any_a, any_b = links.any(axis=1), links.any(axis=0)
            if any_a.any():
                yield part[any_a], rows_b[any_b], links[np.ix_(any_a, any_b)]


def summarize(
    a: np.ndarray, b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray,
    threshold: float, same: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, number of vectors linked, smallest id of its component here) of the rows with links."""
    size = len(a) if same else len(a) + len(b)
    shift = 0 if same else len(a)
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    counts = np.zeros(size, np.int64)
    lowest = ids.copy()
    found = []
    for rows_a, rows_b, links in linked(a, b, threshold, same):
        # Whole numbers below 2^53: exact as doubles.
        weights = links.astype(np.float64)
        counts[rows_a] += (weights @ n_b[rows_b]).astype(np.int64)
        if not same:
            counts[rows_b + shift] += (n_a[rows_a] @ weights).astype(np.int64)
        found.append((rows_a, rows_b + shift, np.packbits(links, axis=1)))
    while found:
        before = lowest.copy()
        for rows_a, rows_b, packed in found:
            links = np.unpackbits(packed, axis=1, count=len(rows_b)).astype(bool)
            most = np.iinfo(np.int64).max
            low_a = np.where(links, lowest[rows_b][None, :], most).min(axis=1)
            lowest[rows_a] = np.minimum(lowest[rows_a], low_a)
            low_b = np.where(links, lowest[rows_a][:, None], most).min(axis=0)
            lowest[rows_b] = np.minimum(lowest[rows_b], low_b)
        if (lowest == before).all():
            break
    rows = np.flatnonzero(counts)
    return ids[rows], counts[rows], lowest[rows]


def valid_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) with v the unit vector as packed doubles, NULL where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for values in batch.column("v").to_pylist():
                v = np.array([np.nan if x is None else x for x in values or []], np.float64)
                # Scaled first, so that squares neither vanish nor overflow.
                largest = np.abs(v).max(initial=0.0)
                usable = len(v) > 0 and np.isfinite(largest) and largest > 0
                if usable:
                    v = v / largest
                    v = v / np.sqrt(v @ v)
                found.append(v.tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(found, pa.binary())], names=["vec_id", "v"]
            )

    thin = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))
    return thin.mapInArrow(run, "vec_id long, v binary")


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def sample_cells(unique: DataFrame, sample: int, cells: int) -> tuple[np.ndarray, float]:
    """Centres of the finest level, of at most `cells` nodes, of a tree over a bounded sample."""
    rows = unique.orderBy(F.xxhash64("v", "rep")).select("v").limit(sample).toArrow()
    points = _matrix(rows.column("v"))
    every = np.arange(len(points))
    centers, radius = [0], 2.0
    while (finer := cover(points, every, radius / 2, cells)) is not None and radius > 1e-3:
        centers, radius = finer[0], radius / 2
    return points[centers]


def cell_pairs(centers: np.ndarray, radii: np.ndarray, reach: float) -> list[tuple[int, int]]:
    """Pairs of cells, each once and with itself, that the covering radii do not rule out."""
    apart = np.sqrt(_squares(centers, centers))
    near = apart - radii[:, None] - radii[None, :] <= reach + SLACK
    return [(i, j) for i, j in zip(*np.nonzero(np.triu(near)))]


def links_of_length(unique: DataFrame, threshold: float, sample: int, cells: int, block: int) -> DataFrame:
    """(rep, n_links, other): per different vector of one length, its links with other vectors
    in a pair of blocks and the smallest one that it is linked to there."""
    spark = unique.sparkSession
    centers = spark.sparkContext.broadcast(sample_cells(unique, sample, cells))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 8_192):
                part = batch.slice(k, 8_192)
                squares = _squares(_matrix(part.column("v")), centers.value)
                cell = squares.argmin(axis=1)
                distance = np.sqrt(squares[np.arange(len(cell)), cell])
                columns = [*part.columns, pa.array(cell, pa.int32()), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, names=["rep", "n", "v", "cell", "distance"])

    placed = unique.select("rep", "n", "v").mapInArrow(place, "rep long, n long, v binary, cell int, distance double")
    placed = scratch.materialize(placed, "cells")
    # One row for each cell.
    sizes = {r[0]: (r[1], r[2]) for r in placed.groupBy("cell").agg(F.count("*"), F.max("distance")).collect()}
    own = sorted(sizes)
    radii = np.array([sizes[c][1] for c in own])
    pairs = [(own[i], own[j]) for i, j in cell_pairs(centers.value[own], radii, reach_of(threshold))]
    blocks = {c: ceil(n / block) for c, (n, _) in sizes.items()}
    n_blocks = F.create_map(*[F.lit(x) for c in own for x in (c, blocks[c])])
    # Within a cell by distance from its centre would be finer; a hash is even in size.
    blocked = placed.select("*", F.pmod(F.xxhash64("rep"), n_blocks[F.col("cell")]).cast("int").alias("block"))
    met = spark.createDataFrame([(int(i), int(j)) for i, j in pairs], "a int, b int")
    tasks = met.select("*", F.explode(F.sequence(F.lit(0), n_blocks[F.col("a")] - 1)).alias("a_block"))
    tasks = tasks.select("*", F.explode(F.sequence(F.lit(0), n_blocks[F.col("b")] - 1)).alias("b_block"))
    tasks = tasks.filter("a < b OR a_block <= b_block").withColumn("task", F.monotonically_increasing_id())
    tasks = scratch.materialize(tasks, "tasks")
    left = tasks.select(F.col("a").alias("cell"), F.col("a_block").alias("block"), "task", F.lit(0).alias("side"))
    right = tasks.filter("a <> b OR a_block <> b_block").select(
        F.col("b").alias("cell"), F.col("b_block").alias("block"), "task", F.lit(1).alias("side")
    )
    sent = blocked.join(left.union(right), ["cell", "block"]).select("task", "side", "rep", "n", "v")

    def run(rows: pa.Table) -> pa.Table:
        side = rows.column("side").to_numpy()
        parts = []
        for k in (0, 1):
            part = rows.filter(pa.array(side == k))
            points = _matrix(part.column("v").combine_chunks()) if part.num_rows else None
            parts.append((points, part.column("rep").to_numpy(), part.column("n").to_numpy().astype(np.float64)))
        (a, ids_a, n_a), (b, ids_b, n_b) = parts
        if b is None and len({*side.tolist()}) == 1:
            b, ids_b, n_b = a, ids_a, n_a
            found = summarize(a, b, ids_a, ids_b, n_a, n_b, threshold, same=True)
        else:
            found = summarize(a, b, ids_a, ids_b, n_a, n_b, threshold, same=False)
        return pa.table([pa.array(c) for c in found], names=["rep", "n_links", "other"])

    return sent.groupBy("task").applyInArrow(run, "rep long, n_links long, other long")


def near_duplicates(
    df: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
    cells: int = CELLS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id reachable), kept."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0, and 1 at most")
    # A number of its own for each row, since ids may repeat or be missing.
    rows = valid_vectors(df, vec_id, embedding).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.materialize(rows, "vectors")
    usable = rows.filter("v IS NOT NULL")
    unique = usable.groupBy("v").agg(F.min("row").alias("rep"), F.count("*").alias("n"))
    unique = scratch.materialize(unique.withColumn("length", F.octet_length("v")), "unique")
    lengths = [r[0] for r in unique.select("length").distinct().collect()]  # of the vectors
    found = df.sparkSession.createDataFrame([], "rep long, n_links long, other long")
    for length in sorted(lengths):
        same = unique.filter(F.col("length") == length)
        found = found.union(links_of_length(same, threshold, sample, cells, block))
    found = scratch.materialize(found, "links")
    counted = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    roots = connected_components(found.select(F.col("rep").alias("u"), F.col("other").alias("v")))
    placed = (
        unique.select("rep", "n", "v")
        .join(counted, "rep", "left")
        .join(roots.toDF("rep", "root"), "rep", "left")
        .select("v", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    )
    own = scratch.materialize(
        rows.join(placed, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "row").alias("root")),
        "own",
    )
    named = own.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = own.join(named, "root")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return out.select(F.col("vec_id").alias(vec_id), F.col("n_links").cast("long"), "component_id", kept.alias("kept"))
