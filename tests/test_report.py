"""The hourly report against a day computed by hand, and status pieces."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import report, validation

END, HOUR = "2026-08-14 12:00:00", datetime(2026, 8, 14, 10)
m = lambda minutes: HOUR + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def families(spark):
    frames = {
        "requests": ([(m(5), m(5) + timedelta(milliseconds=125), 429)], "requested_at timestamp_ntz, received_at timestamp_ntz, status int"),
        "observations": ([("t", m(6), 1.0, None, 2.0)], "token_id string, received_at timestamp_ntz, price_usd double, liquidity_usd double, volume_m5_usd double"),
        "lifecycle": ([("1", "t", m(-10), "PENDING_DEX"), ("2", "t", m(1), "NEW"), ("3", "t", m(2), "RESURRECTED"), ("4", "u", m(70), "PENDING_DEX")], "id string, token_id string, decided_at timestamp_ntz, new_state string"),
        "discoveries": ([("t", m(3))], "token_id string, received_at timestamp_ntz"), "conflicts": ([(m(4),)], "occurred_at timestamp_ntz"),
        "batches": ([("b1", m(0), 30), ("b2", m(60), 30)], "batch_id string, claimed_at timestamp_ntz, batch_size int"),
        "batch_members": ([("b1", "t", m(0)), ("b2", "t", m(60))], "batch_id string, token_id string, claimed_at timestamp_ntz"),
    }
    return {k: spark.createDataFrame(*v) for k, v in frames.items()}


def test_a_day(spark, families, tmp_path):
    rows = report.hourly_report(spark, families, END)
    by_hour = {r.hour: r for r in rows.collect()}
    assert len(by_hour) == 24
    r = by_hour[HOUR]
    assert (r.discovered, r.reaching_dex, r.pending, r.observations, r.requests, r.http_429s, r.resurrections) == (1, 1, 0, 1, 1, 1, 1)
    assert (r.latency_mean_ms, r.latency_p50_ms, r.latency_p95_ms) == pytest.approx((125, 125, 125)) and r.occupancy_pct == pytest.approx(100 / 30)
    assert r.null_rate_liquidity_usd == 1 and r.null_rate_price_usd == 0 and r.duplicate_rate == 0.2
    assert by_hour[m(60)].longest_gap_seconds == 3600 and by_hour[m(60)].pending == 1 and by_hour[m(-60)].pending == 1
    empty = by_hour[HOUR - timedelta(hours=5)]
    assert empty.requests == 0 and empty.latency_p95_ms is None and empty.duplicate_rate is None
    report.write_report(rows, f"file://{tmp_path}/r")
    assert spark.read.json(f"file://{tmp_path}/r/json").count() == 24 and spark.read.option("header", True).csv(f"file://{tmp_path}/r/csv").count() == 24
    assert report.markdown(rows, ["hour", "requests"]).count("\n") == 25
    with pytest.raises(ValueError):
        report.check_hour("2026-08-14 12:30:00")


def test_live_time(spark):
    runs = spark.createDataFrame([("e", m(10), m(30)), ("e", m(60), m(90)), ("e", m(20), m(25)), ("f", None, m(5)), ("f", m(1), None)], "epoch string, collection_started_at timestamp_ntz, finished_at timestamp_ntz")
    got = {r.epoch: (r.live_seconds, r.intervals) for r in report.live_seconds(runs, "epoch", END).collect()}
    assert got == {"e": (3000.0, 2), "f": (None, None)}


def test_status_and_growth(spark):
    beats = spark.createDataFrame([("a", m(0), "RUNNING"), ("a", m(9), "RUNNING"), ("b", m(1), "RUNNING"), ("c", m(9), "FAILED")], "component string, at timestamp_ntz, state string")
    got = {r.component: r.status for r in report.component_status(beats, str(m(10)), 120).collect()}
    assert got == {"a": "HEALTHY", "b": "STALE", "c": "FAILED"}
    assert report.growth(0, 2**30, 86400)["gib_30d"] == 30 and report.growth(0, 1, 0)["gib_1d"] is None


def test_window_summary(spark):
    frames = {
        "batch_members": ([("t", m(0), "ACTIVE", 100.0, 5, 10), ("t", m(1), "ACTIVE", 300.0, 5, 5), ("t", m(-9999), "ACTIVE", 9e9, 5, 10)], "token_id string, claimed_at timestamp_ntz, lifecycle_state string, claim_lateness_ms double, target_interval_seconds int, effective_interval_seconds int"),
        "schedules": ([("t",), ("u",), ("v",)], "token_id string"), "capacity_decisions": ([(m(0), "NORMAL", 10.0), (m(1), "NORMAL", 20.0)], "decided_at timestamp_ntz, capacity_mode string, degraded_schedule_pct double"),
        "connectivity": ([("g", "disconnected", m(0)), ("g", "reconnected", m(2)), ("h", "disconnected", m(119)), ("i", "reconnected", m(5))], "gap_id string, event_type string, observed_at timestamp_ntz"),
        "storage_samples": ([("a", m(0), 100), ("b", m(5), 50), ("c", m(9), 400)], "sample_id string, sampled_at timestamp_ntz, database_bytes long"),
        "storage_relations": ([("a", "obs", 10), ("c", "obs", 90), ("b", "obs", 7), ("c", "new", 5)], "sample_id string, relation_family string, total_bytes long"),
        "discoveries": ([("t", m(0)), ("t", m(1))], "token_id string, received_at timestamp_ntz"), "runs": ([("r", "e", m(0), None), ("s", "e", None, None), ("x", "f", m(-9999), m(-9998))], "run_id string, epoch_id string, collection_started_at timestamp_ntz, finished_at timestamp_ntz"),
    }
    families = {k: spark.createDataFrame(*v) for k, v in frames.items()}
    got = {(r.section, r["name"], r.measure): r.value for r in validation.summary(families, END).collect()}
    assert (got["claims", "ACTIVE", "claims"], got["claims", "ACTIVE", "p50_ms"], got["claims", "ACTIVE", "max_ms"], got["claims", "ACTIVE", "degraded_pct"]) == (2, 200, 300, 50)
    assert got["schedules", "all", "without_claim"] == 2 and got["capacity", "NORMAL", "degraded_schedule_pct"] == 15 and got["connectivity", "all", "gap_seconds"] == 180
    assert (got["storage", "all", "growth_bytes"], got["storage_growth", "obs", "growth_bytes"], got["storage_growth", "new", "growth_bytes"]) == (350, 80, 5)
    assert got["discoveries", "all", "tokens"] == 1 and got["runs", "all", "starts"] == 1
    mine = validation.of_epoch({"runs": families["runs"], "schedules": families["schedules"]}, families["runs"], "f")
    assert mine["runs"].count() == 1 and mine["schedules"].count() == 3
