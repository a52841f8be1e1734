"""As-of joins against a plain search, and that the future never changes the past."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import asof, windows
from tidemark.plans import research

T0 = datetime(2026, 8, 16, 12)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


#: (key, seconds, id, value): ties in time, null values, keys that one side lacks.
FACT = st.tuples(st.sampled_from("abc"), st.integers(0, 20), st.integers(0, 10_000), st.none() | st.integers(1, 9))
PROBE = st.tuples(st.sampled_from("abd"), st.integers(0, 25))


@given(st.lists(FACT, max_size=15, unique_by=lambda f: f[2]), st.lists(PROBE, min_size=1, max_size=8), st.booleans(), st.booleans(), st.none() | st.integers(0, 6), st.integers(0, 5), st.none() | st.integers(1, 9))
@settings(max_examples=25, deadline=None)
def test_asof_join_equals_a_search(spark, facts, probes, forward, strict, tolerance, shift, split):
    f = spark.createDataFrame([(k, at(t), i, v) for k, t, i, v in facts], "k string, ft timestamp_ntz, id long, v int")
    p = spark.createDataFrame([(n, k, at(t)) for n, (k, t) in enumerate(probes)], "n int, k string, pt timestamp_ntz")
    got = {r.n: (r.asof_id, r.asof_v) for r in asof.asof_join(p, f, ["k"], "pt", "ft", ["id", "v"], tie="id", lookback=shift, tolerance=tolerance, forward=forward, strict=strict, split_seconds=split).collect()}
    for n, (k, t) in enumerate(probes):
        edge = t + shift if forward else t - shift
        seen = [x for x in facts if x[0] == k and (x[1] >= edge if forward else x[1] <= edge) and not (strict and x[1] == edge)]
        best = (min if forward else max)(seen, key=lambda x: (x[1], x[2]), default=None)
        if best and tolerance is not None and abs(best[1] - edge) > tolerance:
            best = None
        assert got[n] == ((best[2], best[3]) if best else (None, None))


def test_largest_by_two_times(spark):
    facts = spark.createDataFrame([("a", at(1), at(9), 1), ("a", at(2), at(4), 2), ("a", at(5), at(3), 3)], "k string, decided timestamp_ntz, effective timestamp_ntz, id int")
    probes = spark.createDataFrame([(s, "a", at(s)) for s in (1, 4, 5, 9)], "n int, k string, pt timestamp_ntz")
    got = {r.n: r.asof_id for r in asof.asof_largest(probes, facts, ["k"], "pt", ["decided", "effective"], ["effective", "decided", "id"], ["id"]).collect()}
    assert got == {1: None, 4: 2, 5: 2, 9: 1}  # at 5 the fact decided last is not the largest


@pytest.fixture(scope="module")
def history(spark):
    rows = []
    for i in range(49):
        price = 1 + 0.02 * i if i <= 24 else max(0.01, 1.48 - 0.35 * (i - 24))
        rows.append(("token-1", f"o-{i:03}", at(15 * i), price))
    return spark.createDataFrame(rows, "key string, id string, at timestamp_ntz, price double")


def features(history, decision):
    probe = history.sparkSession.createDataFrame([("token-1", 1, decision)], "key string, probe int, decided timestamp_ntz")
    return research.lookback_features(probe, history, "key", "probe", "decided", "at", "price", {"1m": (60, 30), "5m": (300, 120)}).first()


def test_return_over_a_minute(history):
    r = features(history, at(120))
    assert r.return_1m == round(1.16 / 1.08 - 1, 6) and r.actual_seconds_1m == 60 and r.return_5m is None


def test_the_future_changes_nothing(history, spark):
    later = spark.createDataFrame([("token-1", "x", at(120) + timedelta(microseconds=1), 999999.0)], history.schema)
    assert features(history.unionByName(later), at(120)) == features(history, at(120))


def test_order_and_partitions_change_nothing(history):
    assert features(history.orderBy(F.rand(3)).repartition(7), at(300)) == features(history.coalesce(1), at(300))


def test_outcomes_of_a_collapse(history, spark):
    entry = spark.createDataFrame([("token-1", 1, at(120), 1.16)], "key string, e int, t timestamp_ntz, v double")
    labels = lambda h: research.path_labels(entry, history, "key", "e", "t", "v", "at", "price", h, {"plus50": 1.5, "plus20": 1.2}, {"minus80": 0.2}).first()
    five = labels(research.Horizon(300, 120))
    assert five.crossed_minus80 == "TRUE" and five.crossed_plus20 == "TRUE" and five.crossed_plus50 == "FALSE" and five.path_complete
    assert five.seconds_to_plus20 < five.seconds_to_minus80
    day = labels(research.Horizon(86400, 10800))
    assert day.crossed_plus50 == "UNKNOWN" and day.crossed_minus80 == "TRUE" and day.best_return is None


def test_candidates_do_not_depend_on_what_follows(history, spark):
    admitted = spark.createDataFrame([("token-1", at(0))], "key string, admitted_at timestamp_ntz")
    times = lambda h: {r.decision_at for r in research.candidate_times(h, admitted, "key", "at", [30, 60]).collect() if r.decision_at <= at(150)}
    assert times(history) == times(history.filter(F.col("at") <= F.lit(at(150))))


def test_leaks_are_raised(spark):
    rows = spark.createDataFrame([(at(5), at(4)), (at(5), None)], "decided timestamp_ntz, known timestamp_ntz")
    assert research.assert_no_leak(rows, "decided", "known").count() == 2
    with pytest.raises(Exception, match="behind its decision"):
        research.assert_no_leak(rows, "known", "decided").count()


def test_split_windows(spark):
    day = lambda d: (T0 + timedelta(days=d)).isoformat(sep=" ")
    w = [research.SplitWindow("train", day(0), day(10), day(10)), research.SplitWindow("validation", day(11), day(15), day(15)), research.SplitWindow("test", day(16), day(20), day(20))]
    research.check_windows(w, 86400, 86400)
    with pytest.raises(ValueError):
        research.check_windows([w[1], w[0]], 86400, 86400)
    with pytest.raises(ValueError):
        research.check_windows(w, 86401, 86400)
    stamp = lambda d: T0 + timedelta(days=d)
    rows = spark.createDataFrame([(1, stamp(0), stamp(2)), (2, stamp(0), stamp(9.5)), (3, stamp(0), stamp(12)), (4, stamp(11), stamp(12))], "n int, a timestamp_ntz, d timestamp_ntz")
    got = {r.n: r.s for r in rows.select("n", research.assign_split(F.col("a"), F.col("d"), w, 86400).alias("s")).collect()}
    assert got == {1: "train", 2: None, 3: None, 4: "validation"}


INTERVALS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.integers(0, 30)), max_size=20)


@given(INTERVALS)
@settings(max_examples=15, deadline=None)
def test_intervals(spark, rows):
    df = spark.createDataFrame([(k, s, s + n) for k, s, n in rows], "k string, s int, e int")
    union, peak = defaultdict_of_sets(rows)
    got = {r.k: r.n for r in windows.interval_union(df, ["k"], "s", "e").groupBy("k").agg(F.sum(F.col("island_end") - F.col("island_start")).alias("n")).collect()}
    assert got == {k: len(v) for k, v in union.items() if v}
    assert {r.k: r.peak for r in windows.peak_concurrency(df.filter("e > s"), ["k"], "s", "e").collect()} == peak


def defaultdict_of_sets(rows):
    union, peak = {}, {}
    for k, s, n in rows:
        union.setdefault(k, set()).update(range(s, s + n))
    for k in union:
        most = max((sum(s <= t < s + n for q, s, n in rows if q == k) for t in range(61)), default=0)
        if most:
            peak[k] = most
    return union, peak
