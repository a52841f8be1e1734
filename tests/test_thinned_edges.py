"""Edges that close circles are left out before any shuffle, and clusters stay what they were at every time."""

import random

import pyarrow as pa

from tidemark.operators import graph


def components(edges, nodes):
    of = {n: n for n in nodes}

    def top(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in edges:
        of[max(top(a), top(b))] = min(top(a), top(b))
    return {n: top(n) for n in nodes}


def test_a_forest_has_the_components_of_every_time(monkeypatch):
    rng = random.Random(3)
    rows = [(f"n{rng.randrange(300)}", f"n{rng.randrange(300)}", rng.randrange(50)) for _ in range(4000)]
    rows = [r for r in rows if r[0] != r[1]]
    nodes = {n for r in rows for n in r[:2]}
    table = pa.table({k: [r[i] for r in rows] for i, k in enumerate("abt")})
    for most in (1 << 20, 900):
        monkeypatch.setattr(graph, "EDGES_AT_ONCE", most)
        kept = [tuple(r.values()) for b in graph._thinned(iter(table.to_batches(200))) for r in b.to_pylist()]
        assert len(kept) < len(nodes) * (1 if most > 4000 else 5) and set(kept) <= set(rows)
        for t in range(50):
            assert components([r[:2] for r in kept if r[2] <= t], nodes) == components([r[:2] for r in rows if r[2] <= t], nodes)
    assert list(graph._thinned(iter([]))) == []


def test_components_carry_a_forest_alone(spark):
    rows = [(f"a{i % 40}", f"b{i % 37}") for i in range(5000)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    assert graph.thinned(df).count() == 76
    got = {(r.node, r.component) for r in graph.connected_components(df, "a", "b").collect()}
    assert got == {(n, "a0") for r in rows for n in r}
