"""Rows that a candidate meets in its spans do not grow with how dense facts are."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS
from tidemark.operators import pathtree
from tidemark.plans import dataset

T0 = datetime(2026, 8, 16, 12)
OBS = "id long, token_id string, pair_id string, received_at timestamp_ntz, price_usd double, liquidity_usd double"


@pytest.fixture(scope="module")
def few():
    return {"1m": (60, 30), "5m": (300, 0), "1h": (3600, 900)}


def test_a_candidate_meets_no_fact_or_node_of_its_own(spark, few, monkeypatch):
    # 2,000 facts in an hour: cover() would give each candidate its own nodes and facts.
    monkeypatch.setattr(pathtree, "cover", lambda *a: pytest.fail("nodes and facts are met by each candidate"))
    rng = random.Random(5)
    at = lambda us: T0 + timedelta(microseconds=us)
    times = [rng.randrange(0, 4000) * MICROS + rng.choice((0, 1, 999_999)) for _ in range(2000)]
    facts = [(i, "a", "p", at(t), rng.choice((None, 0.0, round(rng.lognormvariate(0, 1), 3))), rng.choice((None, rng.random()))) for i, t in enumerate(times)]
    asked = [("a", at(t)) for t in {*rng.sample(times, 40), 0, 30 * MICROS, 30 * MICROS - 1, 3_999 * MICROS}]
    obs, candidates = spark.createDataFrame(facts, OBS), spark.createDataFrame(asked, "token_id string, decision_at timestamp_ntz")
    rows = [sorted(map(str, dataset.outcome_labels(candidates, {"observations": obs}, few, dense=d).collect())) for d in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) == len(asked)


def test_pieces_are_one_row_an_entry(spark):
    rng = random.Random(6)
    width = 10 * MICROS
    facts = [("k", rng.randrange(0, 200) * MICROS, i, float(rng.randrange(9)), None) for i in range(1500)]
    f = spark.createDataFrame(facts, "k string, at long, fact long, p double, l double")
    starts = [0, 1, 10 * MICROS, 25 * MICROS, 70 * MICROS - 1]
    e = spark.createDataFrame([("k", t, n) for n, t in enumerate(starts)], "k string, t long, n int")
    got = pathtree.pieces(e, f, ["k"], "t", [3 * width], [2 * width], width).orderBy(F.col("t")).collect()
    assert [r.t for r in got] == starts
    for r in got:
        block, t = r.t // width, r.t
        inside = lambda b, keep: sorted((x[1], x[2], x[3]) for x in facts if x[1] // width == b and keep(x[1]))
        wanted = [inside(block, lambda a: a > t), inside(block + 3, lambda a: a <= t + 3 * width), inside(block + 2, lambda a: a >= t + 2 * width)]
        for want, x in zip(wanted, [p.x for p in r.pieces], strict=True):
            assert (x is None) == (not want)
            if want:
                assert (x.first.at, x.first.fact) == want[0][:2] and (x["last"].at, x["last"].fact) == want[-1][:2] and x.high == max(w[2] for w in want)
                assert x.gap == max((b[0] - a[0] for a, b in zip(want, want[1:], strict=False)), default=None)
                assert x.jump == max((abs(b[2] / a[2] - 1) for a, b in zip(want, want[1:], strict=False) if a[2] > 0 and b[2]), default=None)
