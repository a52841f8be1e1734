"""Tier replay in pieces against a plain loop, with pieces of few decisions, hot tokens, ties, late evidence and long quiet stretches."""

import random

import pytest

from tidemark.operators import cuts
from tidemark.plans import policies

RANK = {n: i for i, n in enumerate(policies.TIERS)}
KIND = "token_id string, id long, t long, watermark long, tier string, eligible boolean, ttl long"


def plain(rows):
    out = []
    state = {}
    for token, i, t, mark, want, eligible, ttl in sorted((r for r in rows if None not in (r[2], r[3]) and r[4] in RANK), key=lambda r: (r[2], r[1])):
        tier, seen, until = state.get(token, ("TIER_0", None, None))
        if seen is not None and (mark < seen or (mark == seen and RANK[want] < RANK[tier])):
            continue
        target = tier if not eligible and until is not None and t < until else want
        if target != tier or (tier != "TIER_0" and eligible and until is not None and until <= t):
            until = None if target == "TIER_0" or ttl is None else t + ttl
            out.append((token, i, tier, target, float(t), None if until is None else float(until)))
            state[token] = (target, mark, until)
    return sorted(out, key=lambda r: r[1])


def history(kind):
    rng = random.Random(kind)
    rows = []
    for i in range(900):
        token = rng.choice(["hot"] * 8 + ["a", None])
        t = i // 3 if kind != "quiet" else i
        mark = t - rng.choice((0, 0, 0, 1, 5, 40)) if kind != "marks" else rng.randrange(900)
        tier = rng.choice(policies.TIERS) if kind != "quiet" or i in (3, 500) else "TIER_1"
        rows.append((token, i, t, mark, tier, rng.random() < 0.6 if kind != "quiet" else i == 3, rng.choice((0, 2, 10, 400, None)) if kind != "quiet" else 100_000))
    return rows + [("a", 2001, None, 1, "TIER_1", True, 5), ("a", 2002, 5, None, "TIER_1", True, 5), ("a", 2003, 5, 5, "TIER_9", True, 5), ("a", 2004, 5, 5, None, True, 5), ("n", 2005, 5, 5, "TIER_1", None, 5)]


@pytest.mark.parametrize("kind", ["mixed", "marks", "quiet"])
@pytest.mark.parametrize("cut", [False, True])
def test_against_loop(spark, kind, cut, monkeypatch):
    monkeypatch.setattr(policies, "PIECE", 7)
    if cut:
        monkeypatch.setattr(cuts, "HOT_ROWS", 300)
        monkeypatch.setattr(cuts, "ONE_IN", 1)
    rows = history(kind)
    got = policies.tier_transitions(spark.createDataFrame(rows, KIND).repartition(3)).orderBy("id").collect()
    want = plain(rows)
    assert [tuple(r) for r in got] == want and want


def test_empty(spark):
    assert policies.tier_transitions(spark.createDataFrame([], KIND)).count() == 0
