"""Quantiles and sweeps over a key that holds nearly all rows: cut into chunks, they give what plain Python gives."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cuts, stats, windows


@pytest.fixture(params=["whole", "cut"])
def hot(request, monkeypatch):
    if request.param == "cut":
        monkeypatch.setattr(cuts, "HOT_ROWS", 200)
        monkeypatch.setattr(cuts, "ONE_IN", 2)
    return request.param


def test_quantiles(spark, hot):
    rng = random.Random(3)
    rows = [(rng.choice("a" * 30 + "b") if i else None, None if rng.random() < 0.05 else round(rng.gauss(0, 50), rng.choice((0, 3)))) for i in range(4000)] + [("only nulls", None), ("one", 5.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    values = {}
    for k, v in rows:
        if v is not None:
            values.setdefault(k, []).append(v)
    wanted = {f"{kind[0]}{int(p * 100)}": (kind, p) for kind in ("interpolated", "lower", "nearest") for p in (0.0, 0.05, 0.5, 0.95, 1.0)}
    counts = stats.value_counts(df, ["k"], "v")
    got = {r.k: r for r in stats.quantiles(counts, ["k"], wanted).collect()}
    assert set(got) == set(values)
    assert hot == "whole" or [r.k for r in cuts.hot_cuts(counts, ["k"], "_v").collect()] == ["a"]
    for k, vs in values.items():
        vs, n = sorted(vs), len(vs)
        for a, (kind, p) in wanted.items():
            at = (n - 1) * p
            want = {"interpolated": vs[math.floor(at)] + (at - math.floor(at)) * (vs[math.ceil(at)] - vs[math.floor(at)]), "lower": vs[math.floor(at)], "nearest": vs[max(math.ceil(n * p), 1) - 1]}[kind]
            assert math.isclose(got[k][a], want, rel_tol=1e-12, abs_tol=1e-12), (k, a)


def spans(seed):
    rng = random.Random(seed)
    out = []
    for i in range(3000):
        s = rng.randrange(0, 40_000)
        out.append((rng.choice("a" * 30 + "b"), s, s + rng.choice((-3, 0, 1, 2, 5, 9, 400 if i % 500 == 0 else 3))))
    return out


def test_union_and_peak(spark, hot):
    rows = spans(1)
    df = spark.createDataFrame(rows, "k string, s long, e long").repartition(4)
    assert hot == "whole" or cuts.hot_cuts(df.select("k", F.col("s").alias("_s")), ["k"], "_s").count() == 1
    want, peaks = [], {}
    for k in "ab":
        reach = None
        for _, s, e in sorted(r for r in rows if r[0] == k and r[2] > r[1]):
            if reach is None or s > reach:
                want.append([k, s, e])
            want[-1][2] = reach = max(want[-1][2], e)
        steps = sorted((t, d) for r in rows if r[0] == k for t, d in ((r[1], 1), (r[2], -1)))
        level = most = 0
        for _, d in steps:
            level += d
            most = max(most, level)
        peaks[k] = most
    assert sorted(map(list, windows.interval_union(df, ["k"], "s", "e").collect())) == sorted(want)
    assert {r.k: r.peak for r in windows.peak_concurrency(df, ["k"], "s", "e").collect()} == peaks


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_rolling_sums(spark, span):
    rng = random.Random(2)
    rows = [(i, rng.choice("aaab"), rng.randrange(-3000, 3000) if i % 97 else None, rng.randrange(10)) for i in range(800)]
    df = spark.createDataFrame(rows, "i int, k string, t long, v int")
    got = {r.i: r.total for r in windows.rolling_sum(df, ["k"], "t", F.col("v"), span, "total").collect()}
    assert len(got) == len(rows)
    for i, k, t, _ in rows:
        assert got[i] == sum(r[3] for r in rows if r[1] == k and (r[2] is None if t is None else r[2] is not None and t - span < r[2] <= t))
