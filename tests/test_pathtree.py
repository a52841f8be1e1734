"""Spans put together of tree nodes against facts met one by one: extremes, gaps, jumps, ends and first crossings of nested spans."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS
from tidemark.operators import pathtree
from tidemark.plans import dataset
from tidemark.work import durable

T0 = datetime(2026, 8, 16, 12)
MARKS = (30, 45, 60, 3600, 4500, 86_400)


@pytest.fixture(scope="module")
def facts():
    rng = random.Random(4)
    out = []
    for i in range(3000):
        t = rng.randrange(0, 200_000) * MICROS + rng.choice((0, 0, 1, 999_999)) if i % 3 else rng.randrange(0, 300) * 10 * MICROS
        out.append((rng.choice("aab"), t, i, rng.choice((None, 0.0, 1.0, 2.0, round(rng.lognormvariate(0, 1), 3))), rng.choice((None, rng.random()))))
    return out


def test_covers_are_whole_and_few(spark, facts):
    rng = random.Random(9)
    entries = [(n, rng.choice("abc"), rng.randrange(0, 12_000) * 10 * MICROS + rng.choice((0, 1, 5_000_000))) for n in range(40)]
    f = spark.createDataFrame(facts, "k string, at long, fact long, p double, l double").repartition(4)
    e = spark.createDataFrame(entries, "n int, k string, t long")
    nodes = durable(pathtree.build(f, ["k"]), "nodes")
    cut = F.array(*[F.col("t") + m * MICROS for m in MARKS])
    items = pathtree.with_neighbours(pathtree.cover(e, nodes, f, ["k"], "t", cut), ["n"]).cache()
    rows = {}
    for r in items.collect():
        rows.setdefault(r.n, []).append(r)
    for n, k, t in entries:
        path = sorted((x for x in facts if x[0] == k and t < x[1] <= t + MARKS[-1] * MICROS), key=lambda x: (x[1], x[2]))
        own = sorted(rows.get(n, []), key=lambda r: (r.first.at, r.first.fact))
        assert bool(own) == bool(path) and len(own) < max(80, len(path))
        if not path:
            continue
        assert all(not (r.first.at <= t + m * MICROS < r.last.at) for r in own for m in MARKS), "a cut lies within a node"
        for m in MARKS:
            inner, part = [x for x in path if x[1] <= t + m * MICROS], [r for r in own if r.last.at <= t + m * MICROS]
            prices = [x[3] for x in inner if x[3] is not None]
            top = lambda xs, f=max: f([x for x in xs if x is not None], default=None)
            assert top([r.high for r in part]) == top(prices) and top([r.low for r in part], min) == top(prices, min)
            assert top([r.low_nonzero for r in part], min) == top([x for x in prices if x], min) and top([r.thin for r in part], min) == top([x[4] for x in inner], min)
            assert top([r.gap for r in part]) == top([b[1] - a[1] for a, b in zip(inner, inner[1:], strict=False)])
            jumps = [abs(b[3] / a[3] - 1) for a, b in zip(inner, inner[1:], strict=False) if a[3] and a[3] > 0 and b[3]]
            assert top([r.jump for r in part]) == top(jumps)
            if prices:
                best = max(prices)
                assert min((r.peak.down, r.peak.at, r.peak.fact) for r in part if r.peak)[1:] == next((x[1], x[2]) for x in inner if x[3] == best)
    # First crossings: in a node of some level, then found by descent.
    asked = []
    for n, k, t in entries:
        for bound, above in ((3.0, True), (8.0, True), (0.2, False), (0.0, False)):
            hits = sorted((r for r in rows.get(n, []) if (r.high if above else r.low) is not None and (r.high >= bound if above else r.low <= bound)), key=lambda r: (r.first.at, r.first.fact))
            if hits and hits[0].level >= 0:
                asked.append((n, k, bound, above, hits[0].level, hits[0].node, t))
    df = spark.createDataFrame(asked, "n int, k string, bound double, above boolean, level int, node long, t long")
    got = {(r.n, r.bound): r["at"] for r in pathtree.descend(df, nodes, f, ["k"]).collect()}
    assert len(got) == len(asked) > 20 and len({a[4] for a in asked}) > 2
    for n, k, bound, above, _, _, t in asked:
        want = min(x[1] for x in facts if x[0] == k and t < x[1] and x[3] is not None and (x[3] >= bound if above else x[3] <= bound))
        assert got[n, bound] == want


def test_labels_of_tree_and_facts_agree(spark, facts):
    at = lambda us: T0 + timedelta(microseconds=us)
    obs = spark.createDataFrame([(i, k, "p", at(t), p, l) for k, t, i, p, l in facts], "id long, token_id string, pair_id string, received_at timestamp_ntz, price_usd double, liquidity_usd double")
    candidates = spark.createDataFrame([(k, at(t * MICROS)) for k in "abz" for t in (0, 1000, 1010, 55_555, 199_990)], "token_id string, decision_at timestamp_ntz")
    few = {"1m": (60, 30), "1h": (3600, 900), "24h": (86400, 10800)}
    rows = [sorted(map(str, dataset.outcome_labels(candidates, {"observations": obs}, few, dense=d).collect())) for d in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) == 15
