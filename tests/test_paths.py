"""Paths behind entries: both plans give what plain Python gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, paths

T0 = datetime(2026, 8, 16, 12)


@pytest.mark.parametrize("dense", [True, False])
def test_path_summary(spark, dense):
    rng = random.Random(3)
    facts = [(rng.choice("ab") if i % 50 else None, T0 + timedelta(milliseconds=rng.randrange(0, 600_000)), None if i % 17 == 0 else float(rng.randrange(50, 150))) for i in range(900)]
    facts += facts[:20]
    entries = [(i, "abc"[i % 3] if i % 11 else None, T0 + timedelta(milliseconds=rng.randrange(-60_000, 600_000)) if i % 13 else None, 100.0) for i in range(80)] + [(900, "a", facts[5][1], 100.0)]
    span, bounds = 97, {"up": (F.col("v0") * 1.3, True), "down": (F.col("v0") * 0.6, False), "never": (F.col("v0") * 9, True)}
    e, f = spark.createDataFrame(entries, "e int, k string, t timestamp_ntz, v0 double"), spark.createDataFrame(facts, "k string, at timestamp_ntz, v double")
    got = {r.e: (r.n, r.gap, r.reach, r.high, r.low, r.s_up, r.s_down, r.s_never) for r in paths.path_summary(e, f, ["k"], "e", "t", "at", "v", span, bounds, dense).collect()}
    want = {}
    for i, k, t, v0 in entries:
        inside = sorted(((a, v) for key, a, v in facts if k is not None and key == k and t is not None and t < a <= t + timedelta(seconds=span)), key=lambda x: x[0])
        if inside:
            times, values = [(a - t).total_seconds() for a, _ in inside], [v for _, v in inside if v is not None]
            first = lambda ok: min((s for s, (_, v) in zip(times, inside, strict=True) if v is not None and ok(v)), default=None)  # noqa: B023, E731
            gap = max(b - a for a, b in zip([0, *times], times, strict=False))
            want[i] = (len(inside), gap, times[-1], max(values, default=None), min(values, default=None), first(lambda v: v >= v0 * 1.3), first(lambda v: v <= v0 * 0.6), None)  # noqa: B023
    assert set(got) == set(want)
    for i, w in want.items():
        assert got[i] == pytest.approx(w, abs=1e-6), i


def test_the_plan_is_measured(spark):
    f = spark.range(5000).select(F.lit("a").alias("k"), (F.lit(T0) + F.make_dt_interval(secs=F.col("id") / 10)).cast("timestamp_ntz").alias("at"), F.lit(1.0).alias("v"))
    assert paths.fullest_span(f, ["k"], "at", 100) == 1000 and paths.fullest_span(f.limit(0), ["k"], "at", 100) == 0


def test_hot_keys_are_measured_and_split(spark):
    rng = random.Random(5)
    facts = spark.createDataFrame([(i, rng.choice("aab"), T0 + timedelta(seconds=rng.randrange(0, 5000)), float(i)) for i in range(400)], "id int, k string, at timestamp_ntz, v double")
    probes = spark.createDataFrame([(n, rng.choice("abc"), T0 + timedelta(seconds=rng.randrange(0, 6000))) for n in range(60)], "n int, k string, t timestamp_ntz")
    split = asof.hot_split(facts, ["k"], "at", 100)
    assert 1 <= split <= 5000 * 100 / 200 and asof.hot_split(facts, ["k"], "at", 1000) is None
    wide = lambda s: sorted(map(str, asof.lookbacks(probes, facts, ["k"], ["n"], "t", "at", ["v"], {"1m": (60, 600), "9m": (540, 60)}, "id", s).collect()))
    assert wide(None) == wide(split) == wide(7)
    late = facts.withColumn("seen", F.col("at") + F.expr("INTERVAL 90 SECOND"))
    large = lambda s: sorted(map(str, asof.asof_largest(probes, late, ["k"], "t", ["at", "seen"], ["v", "id"], ["id"], split_seconds=s).collect()))
    assert large(None) == large(split) == large(7)
