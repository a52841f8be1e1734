"""What a row takes from the one before it, over a key that holds nearly all rows: cut into chunks, it is what plain Python gives."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cuts, windows


@pytest.fixture(params=["whole", "cut"])
def lines(request, spark, monkeypatch):
    if request.param == "cut":
        monkeypatch.setattr(cuts, "HOT_ROWS", 200)
        monkeypatch.setattr(cuts, "ONE_IN", 2)
    rng = random.Random(8)
    rows, v = [], 0.0
    for i in range(3000):
        v = v if rng.random() < 0.97 else rng.choice((None, -2.0, 0.0, 1.0, 3.0))
        rows.append((rng.choice("a" * 40 + "b") if i % 300 else None, i // 4 if i % 500 else None, i, v))
    df = spark.createDataFrame(rows, "k string, t long, id long, v double").repartition(4)
    assert request.param == "whole" or [r.k for r in cuts.hot_cuts(df, ["k"], "t").collect()] == ["a"]
    keyed = {}
    for r in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2])):
        keyed.setdefault(r[0], []).append(r)
    return df, keyed


def test_changes(lines):
    df, keyed = lines
    want = {r[2] for rs in keyed.values() for p, r in zip([None, *rs], rs, strict=False) if p is None or p[3] is None or (r[3] is not None and p[3] != r[3])}
    assert {r.id for r in windows.changed_only(df, ["k"], F.col("v"), "t", "id").collect()} == want


def test_crossings(lines):
    df, keyed = lines
    want = set()
    for rs in keyed.values():
        for p, r in zip(rs, rs[1:], strict=False):
            if p[3] is not None and r[3] is not None:
                want |= {(r[2], t, "up") for t in (0.0, 2.0) if p[3] < t <= r[3]} | {(r[2], t, "down") for t in (0.0, 2.0) if p[3] >= t > r[3]}
    got = windows.threshold_crossings(df, ["k"], "v", ["t", "id"], (0, 2))
    assert got.columns == [*df.columns, "threshold", "direction"] and {(r.id, r.threshold, r.direction) for r in got.collect()} == want


def test_runs(lines):
    df, keyed = lines
    want = {}
    for rs in keyed.values():
        sign, n = None, 0
        for r in rs:
            s = 0 if r[3] is None else (r[3] > 0) - (r[3] < 0)
            n = n + 1 if s == sign else 1
            sign = s
            want[r[2]] = 0 if s == 0 else n
    got = windows.trailing_run(df, ["k"], F.signum("v"), "t", "id")
    assert got.columns == [*df.columns, "run_length"] and {r.id: r.run_length for r in got.collect()} == want
