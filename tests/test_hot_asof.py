"""A key that holds nearly all rows: its line is cut by itself, the pieces go to many tasks, and results are those of one piece."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, cuts

T0 = datetime(2026, 8, 16, 12)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    key = lambda: rng.choice("a" * 18 + "b" + "c")
    # Bursts: half of the rows lie in a hundredth of the time.
    second = lambda: rng.randrange(0, 50_000) if rng.random() < 0.5 else rng.randrange(20_000, 20_500)
    facts = [(i, key() if rng.random() > 0.02 else None, T0 + timedelta(seconds=second()), float(i)) for i in range(6000)]
    probes = [(n, key() if rng.random() > 0.02 else None, T0 + timedelta(seconds=second()) if n % 50 else None) for n in range(1500)]
    return spark.createDataFrame(facts, "id int, k string, at timestamp_ntz, v double").repartition(4), spark.createDataFrame(probes, "n int, k string, t timestamp_ntz").repartition(4)


CALLS = {
    "back": lambda p, f: asof.asof_join(p, f, ["k"], "t", "at", ["id", "v"], tie="id", lookback=30, tolerance=400),
    "forward": lambda p, f: asof.asof_join(p, f, ["k"], "t", "at", ["id", "v"], tie="id", forward=True, strict=True),
    "largest": lambda p, f: asof.asof_largest(p, f.withColumn("seen", F.col("at") + F.expr("INTERVAL 90 SECOND")), ["k"], "t", ["at", "seen"], ["v", "id"], ["id"]),
    "lookbacks": lambda p, f: asof.lookbacks(p, f, ["k"], ["n"], "t", "at", ["v"], {"1m": (60, 600), "9m": (540, 60)}, "id"),
}


@pytest.mark.parametrize("name", list(CALLS))
def test_cut_or_whole_is_the_same(spark, tables, monkeypatch, name):
    facts, probes = tables
    call = lambda: sorted(map(str, CALLS[name](probes, facts).collect()))
    whole = call()
    monkeypatch.setattr(cuts, "HOT_ROWS", 1000)
    monkeypatch.setattr(cuts, "ONE_IN", 4)
    assert call() == whole and len(whole) > 1000


def test_pieces_are_small(spark, tables, monkeypatch):
    facts, probes = tables
    monkeypatch.setattr(cuts, "HOT_ROWS", 1000)
    monkeypatch.setattr(cuts, "ONE_IN", 4)
    line = asof._timeline(probes, facts, ["k"], asof.micros("t"), asof.micros("at"), F.col("id"), ["id", "at"])
    where = cuts.hot_cuts(line, ["k"], "_t")
    (row,) = where.collect()
    assert row.k == "a" and [len(c) for c in row.cuts] == [cuts.SIDE] * cuts.SIDE
    sizes = [r["count"] for r in cuts.with_chunks(line, where, ["k"], "_t", only_hot=True).groupBy("_chunk").count().collect()]
    rows = line.filter("k = 'a'").count()
    assert sum(sizes) == rows and max(sizes) < rows / 30 and len(sizes) > 100
