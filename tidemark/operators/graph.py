"""Connected components of undirected edges by contraction.

In each round a node takes, of all nodes within two steps, the one that a hash of the round puts first,
and the edges are laid between what their ends took. Hashes make hubs and long chains alike: the nodes left shrink by a
constant factor, so rounds are logarithmic in the number of nodes, and all but the first few are small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.work import durable

#: Edges that a task looks at together.
EDGES_AT_ONCE = 1 << 21


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Places of edges (x, y) between nodes 0 to n - 1 that make up the forest of earliest edges, in rounds in which each tree takes its earliest edge to another one."""
    kept, at = [np.zeros(0, np.int64)], np.arange(len(x))
    while True:
        other = x != y
        x, y, at = x[other], y[other], at[other]
        if not len(x):
            return np.sort(np.concatenate(kept))
        best = np.full(n, -1)
        both, place = np.stack([x, y], 1).ravel()[::-1], np.repeat(np.arange(len(x)), 2)[::-1]
        best[both] = place  # the last one written is the earliest edge
        nodes = np.flatnonzero(best >= 0)
        edge, up = best[nodes], np.arange(n)
        kept.append(np.unique(at[edge]))
        up[nodes] = x[edge] + y[edge] - nodes
        mutual = nodes[(up[up[nodes]] == nodes) & (nodes < up[nodes])]
        up[mutual] = mutual
        while True:
            far = up[up]
            if (far == up).all():
                break
            up = far
        x, y = up[x], up[y]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every EDGES_AT_ONCE edges (a, b and perhaps t) those of the forest of earliest ones."""

    def thin(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        edges = pa.Table.from_batches(held)
        if "t" in edges.column_names:
            edges = edges.sort_by("t")
        ends = pa.chunked_array([*edges["a"].chunks, *edges["b"].chunks]).combine_chunks().dictionary_encode()
        codes = ends.indices.to_numpy()
        return edges.take(pa.array(_forest(codes[: len(edges)], codes[len(edges) :], len(ends.dictionary)))).to_batches()

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= EDGES_AT_ONCE:
            yield from thin(held)
            held = []
    if held:
        yield from thin(held)


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer of the edges (a, b and perhaps t, none null) with the same components, those of the edges up to any t too.

    Each task takes as many at once as it may hold and leaves out what closes a circle of earlier ones: without a shuffle, fewer edges are left than nodes were read together."""
    return edges.mapInArrow(_thinned, edges.schema)


def _contract(edges: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, taken) for every end of the edges (x, y), and the edges between what was taken."""

    rank = lambda c: F.xxhash64(F.col(c), F.lit(seed))
    # Longs alone are aggregated, so nothing needs sorting.
    both = edges.union(edges.select("y", "x"))
    near = both.groupBy("x").agg(F.min_by("y", rank("y")).alias("y"))
    first = near.select("x", F.when(rank("x") <= rank("y"), F.col("x")).otherwise(F.col("y")).alias("first"))
    beside = both.join(first.withColumnRenamed("x", "y"), "y").select("x", "first").union(first)
    taken = durable(beside.groupBy(F.col("x").alias("node")).agg(F.min_by("first", rank("first")).alias("taken")), "taken")
    moved = edges.join(taken.select(F.col("node").alias("x"), F.col("taken").alias("p")),
        "x").join(taken.select(F.col("node").alias("y"), F.col("taken").alias("q")), "y")
    return taken, durable(moved.filter("p <> q").select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct(), "edges")


def contract(edges: DataFrame) -> DataFrame:
    """node and root, the same for all nodes of a component, for edges (x, y) of long nodes."""
    return _rounds(durable(edges.filter("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(), "edges"))


def _rounds(edges: DataFrame) -> DataFrame:
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        taken, edges = _contract(edges, len(steps))
        steps.append(taken)
    if not steps:
        return edges.select(F.col("x").alias("node"), F.col("y").alias("root"))
    roots = steps.pop().withColumnRenamed("taken", "root")
    while steps:
        above = roots.select(F.col("node").alias("taken"), "root")
        roots = steps.pop().join(above, "taken", "left").select("node", F.coalesce("root", "taken").alias("root"))
    return roots


def as_longs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pairs (a, b and others) with x and y, their ends as 64-bit hashes; and id and node of all ends. Should two nodes share a hash, all are hashed anew."""
    seed = 0
    while True:
        hashed = durable(pairs.withColumns({"x": F.xxhash64("a", F.lit(seed)), "y": F.xxhash64("b", F.lit(seed))}), "pairs")
        # Distinct first: texts are then sorted once a node, not once an edge.
        each = hashed.select(F.col("x").alias("id"), F.col("a").alias("node")).union(hashed.select("y", "b")).distinct()
        named = durable(each.groupBy("id").agg(F.min("node").alias("node"), F.max("node").alias("other")), "nodes")
        if named.filter("node <> other").isEmpty():
            return hashed, named.select("id", "node")
        seed += 1
        pairs = hashed.drop("x", "y")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (its smallest node), for nodes of any type that has an order.

    Nodes are worked on as 64-bit hashes."""
    hashed, named = as_longs(thinned(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")))
    roots = _rounds(hashed.select("x", "y")).withColumnRenamed("node", "id")
    roots = durable(roots.join(named, "id"), "roots")
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")
