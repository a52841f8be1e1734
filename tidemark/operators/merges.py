"""Clusters as of any time, from one history of how they merged.

Edges have times, and the clusters of a time are those of the edges known by then. Each round takes every node's earliest edge; nodes that these
edges connect become one node of the next round, at the end of whose earliest edge they stand. A node is in that cluster from the time of its own earliest
edge on: all edges between it and the earliest of the group are older. So a node needs one step a round, at most as many as the logarithm of the
number of nodes, and its cluster at a time is found by taking steps until one lies after that time. No graph is made for a time that is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import micros
from tidemark.operators.asof import asof_join
from tidemark.operators.cuts import any_hot, hot_cuts, same, with_chunks
from tidemark.operators.graph import as_longs, thinned
from tidemark.work import durable


def _earliest(edges: DataFrame) -> DataFrame:
    """x, up and t: each node's earliest edge. Edges are told apart by (t, u, v), so that two nodes may choose each other, but no more do in a circle."""
    both = edges.union(edges.select("y", "x", "t", "u", "v"))
    own = both.groupBy("x").agg(F.min(F.struct("t", "u", "v", "y")).alias("m"))
    return durable(own.select("x", F.col("m.y").alias("up"), F.col("m.t").alias("t")), "earliest")


def _round(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(x, up, t): the node that x is part of from t on; and the edges between those nodes, the earliest of each two."""
    own = _earliest(edges)
    pair = own.alias("o").join(own.alias("p"), F.col("o.up") == F.col("p.x"))
    first = (F.col("p.up") == F.col("o.x")) & (F.col("o.x") < F.col("o.up"))
    ups = durable(pair.select("o.x", F.when(first, F.col("o.x")).otherwise(F.col("o.up")).alias("up"), "o.t"), "ups")
    while True:  # each time, nodes stand twice as far up
        far = ups.alias("o").join(ups.alias("p"), F.col("o.up") == F.col("p.x"))
        far = durable(far.select("o.x", "p.up", "o.t", (F.col("o.up") != F.col("p.up")).alias("moved")), "ups")
        ups = far.drop("moved")
        if far.filter("moved").isEmpty():
            break
    moved = edges.alias("e").join(ups.alias("a"), F.col("e.x") == F.col("a.x")).join(ups.alias("b"), F.col("e.y") == F.col("b.x")).filter("a.up <> b.up")
    ends = moved.select(F.least("a.up", "b.up").alias("x"), F.greatest("a.up", "b.up").alias("y"), F.struct("e.t", "e.u", "e.v").alias("e"))
    return ups, durable(ends.groupBy("x", "y").agg(F.min("e").alias("e")).select("x", "y", "e.*"), "edges")


def merge_history(edges: DataFrame, a: str, b: str, at: str) -> DataFrame:
    """node, id and steps (array of t, label in order) for every node of an edge with both ends and a time.

    A label is a node of a round and the round, as a node may go by its number for several. A node's label is its id in round 0 before the first step; from step k on it is that step's label, if all steps up to k have a t (microseconds) at or before the
    time asked for. At one time, nodes have the same label if and only if known edges connect them. An edge of a node to itself counts for nothing."""
    known = edges.select(F.col(a).alias("a"), F.col(b).alias("b"), micros(at).alias("t")).filter("a IS NOT NULL AND b IS NOT NULL AND t IS NOT NULL")
    hashed, named = as_longs(thinned(known.filter("a <> b")))
    ends = hashed.groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).agg(F.min("t").alias("t"))
    left = durable(ends.select("x", "y", "t", F.col("x").alias("u"), F.col("y").alias("v")), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        step, left = _round(left)
        rounds.append(step)
    out = named.select("node", "id", F.col("id").alias("_at"), F.expr("CAST(array() AS array<struct<t: bigint, label: struct<round: int, id: bigint>>>)").alias("steps"))
    for k, step in enumerate(rounds):
        met = out.alias("o").join(step.alias("s"), F.col("o._at") == F.col("s.x"), "left")
        longer = F.when(F.col("s.x").isNull(), F.col("o.steps")).otherwise(F.concat("o.steps", F.array(F.struct("s.t", F.struct(F.lit(k + 1).alias("round"), F.col("s.up").alias("id")).alias("label")))))
        out = met.select("o.node", "o.id", F.col("s.up").alias("_at"), longer.alias("steps"))
    return durable(out.drop("_at"), "history")


def _label(id_: Column, steps: Column, t: Column) -> Column:
    """The label at t: that of the last step before the first that lies after t."""
    late = F.array_position(F.transform(steps, lambda s: s["t"] > t), True)
    taken = F.when(late == 0, F.size(steps)).otherwise((late - 1).cast("int"))
    return F.when(taken > 0, F.try_element_at(steps, taken)["label"]).otherwise(F.struct(F.lit(0).alias("round"), id_.alias("id")))


def cluster_growth(history: DataFrame) -> DataFrame:
    """label, since (microseconds), size and least: how many nodes a cluster has from then on, and the smallest.

    Only clusters of two or more. The line of a cluster with very many nodes is summed up in chunks."""
    reach = F.transform("steps", lambda s, k: F.struct(F.array_max(F.slice(F.transform("steps", lambda x: x["t"]), F.lit(1), k + 1)).alias("since"),
        s["label"].alias("label"), F.try_element_at("steps", k + 2)["t"].alias("until")))
    each = history.select("node", F.explode(reach).alias("r")).filter("r.until IS NULL OR r.since < r.until")
    at = each.groupBy(F.col("r.label").alias("label"), F.col("r.since").alias("since")).agg(F.count(F.lit(1)).alias("_n"), F.min("node").alias("_least"))
    if not any_hot(at.select("label", "since"), ["label"], "since"):
        w = Window.partitionBy("label").orderBy("since").rowsBetween(Window.unboundedPreceding, 0)
        return at.select("label", "since", F.sum("_n").over(w).alias("size"), F.min("_least").over(w).alias("least"))
    cuts = hot_cuts(at, ["label"], "since")
    along = Window.partitionBy("label").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = with_chunks(at, cuts, ["label"], "since", only_hot=True).groupBy("label", "_chunk").agg(F.sum("_n").alias("_n"), F.min("_least").alias("_least"))
    before = sums.select("label", "_chunk", F.sum("_n").over(along).alias("_b"), F.min("_least").over(along).alias("_l"))
    w = Window.partitionBy("label", "_chunk").orderBy("since").rowsBetween(Window.unboundedPreceding, 0)
    cut = with_chunks(at, cuts, ["label"], "since").withColumns({"_s": F.sum("_n").over(w), "_m": F.min("_least").over(w)})
    joined = cut.alias("c").join(F.broadcast(before.alias("b")), same("c", "b", ["label", "_chunk"]), "left")  # of hot labels alone
    return joined.select("c.label", "c.since", (F.col("_s") + F.coalesce("_b", F.lit(0))).alias("size"), F.least("_m", "_l").alias("least"))


def clusters_as_of(probes: DataFrame, node: str, at: str, history: DataFrame, names: Sequence[str] = ("cluster", "cluster_size")) -> DataFrame:
    """probes with the cluster of their node at their time: its smallest node and its size.

    A node without an edge by then is a cluster of its own; a probe without a node or a time gets nulls. probes must not have columns named
    _label or _p_*. Rows, repeated ones too, come back once each."""
    own = {c: f"_p_{c}" for c in probes.columns}
    p = probes.withColumnsRenamed(own)
    who, when = F.col(f"p.`{own[node]}`"), micros(F.col(f"p.`{own[at]}`"))
    met = p.alias("p").join(history.alias("h"), who == F.col("h.node"), "left").select("p.*", F.when(when.isNotNull(), _label(F.col("h.id"), F.col("h.steps"), when)).alias("_label"))
    growth = cluster_growth(history).withColumn("_since", F.timestamp_micros("since")).select("label", "_since", "size", "least")
    found = asof_join(met, growth.withColumnRenamed("label", "_label"), ["_label"], own[at], "_since", ["size", "least"], prefix="_g_")
    asked = F.col(f"`{own[node]}`").isNotNull() & F.col(f"`{own[at]}`").isNotNull()
    return found.select(*[F.col(f"`{own[c]}`").alias(c) for c in probes.columns], F.when(asked, F.coalesce("_g_least", F.col(f"`{own[node]}`"))).alias(names[0]),
        F.when(asked, F.coalesce("_g_size", F.lit(1)).cast("long")).alias(names[1]))
