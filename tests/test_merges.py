"""Clusters as of a time against plain Python: chains in either order of time, stars, ties, and clusters of their own."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cuts, merges

START = datetime(2024, 1, 1)


def at(k):
    return None if k is None else START + timedelta(seconds=k)


def plain(edges, nodes, t):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b, s in edges:
        if a is not None and b is not None and s is not None and s <= t:
            low, high = sorted((find(a), find(b)))
            up[high] = low
    names = {n: find(n) for n in set(nodes) | set(up)}
    return {n: (names[n], sum(v == names[n] for v in names.values())) for n in nodes}


def shapes():
    rng = random.Random(5)
    n = lambda k: f"n{k:03d}"
    yield [(n(k), n(k + 1), k) for k in range(60)]  # a chain, later edges further on
    yield [(n(k), n(k + 1), 60 - k) for k in range(60)]
    yield [(n(0), n(k), rng.randrange(20)) for k in range(1, 60)]  # a star with ties
    yield [(n(rng.randrange(80)), n(rng.randrange(80)), rng.randrange(40)) for _ in range(100)]  # repeats and edges of a node to itself
    yield [(n(rng.randrange(40)), n(rng.randrange(40)), 7) for _ in range(30)] + [(None, n(1), 1), (n(2), None, 1), (n(1), n(39), None)]  # one time, and nulls


@pytest.mark.parametrize("shape", range(5))
@pytest.mark.parametrize("cut", [False, True])
def test_against_plain(spark, shape, cut, monkeypatch):
    if cut:
        monkeypatch.setattr(cuts, "HOT_ROWS", 8)
        monkeypatch.setattr(cuts, "ONE_IN", 1)
    edges = list(shapes())[shape]
    df = spark.createDataFrame([(a, b, at(s)) for a, b, s in edges], "a string, b string, at timestamp")
    history = merges.merge_history(df, "a", "b", "at")
    assert history.agg(F.max(F.size("steps"))).first()[0] <= 7
    nodes = sorted({x for e in edges for x in e[:2] if x is not None}) + ["alone"]
    times = [-1, 0, 3, 7, 12, 30, 31, 59, 99]
    probes = spark.createDataFrame([(x, at(t), t) for x in nodes for t in times] + [(None, at(1), 1), (nodes[0], None, None)] * 2, "size string, at timestamp, t long")
    got = merges.clusters_as_of(probes, "size", "at", history).collect()
    assert len(got) == len(nodes) * len(times) + 4
    want = {t: plain(edges, nodes, t) for t in times}
    for r in got:
        assert (r.cluster, r.cluster_size) == ((None, None) if r["size"] is None or r.t is None else want[r.t][r["size"]]), r


def test_no_edges(spark):
    none = spark.createDataFrame([], "a string, b string, at timestamp")
    probes = spark.createDataFrame([("x", at(1))], "who string, at timestamp")
    r = merges.clusters_as_of(probes, "who", "at", merges.merge_history(none, "a", "b", "at")).first()
    assert (r.cluster, r.cluster_size) == ("x", 1)
