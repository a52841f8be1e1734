"""The canonical history: what is known when, features, outcomes, and published datasets."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.plans import dataset

T0 = datetime(2026, 8, 16, 12)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def families(spark):
    obs = []
    for i in range(49):
        price = 1 + 0.02 * i if i <= 24 else max(0.01, 1.48 - 0.35 * (i - 24))
        liquidity = 10000 + 100 * i if i <= 24 else max(200, 12400 - 3000 * (i - 24))
        obs.append((f"o-{i:03}", "token-1", "pair-1", at(15 * i), Decimal(str(round(price, 6))), Decimal(liquidity), Decimal(str(round(price * 1e6, 2))), Decimal(1000 + 50 * i), 30 + i, 5 + i // 10))
    frames = {
        "observations": (obs, "id string, token_id string, pair_id string, received_at timestamp_ntz, price_usd decimal(38,18), liquidity_usd decimal(38,18), market_cap_usd decimal(38,18), volume_m5_usd decimal(38,18), buys_m5 long, sells_m5 long"),
        "lifecycle": ([(f"l{k}", "token-1", at(t), at(t), s) for k, (t, s) in enumerate([(0, "NEW"), (180, "ACTIVE"), (480, "FADING")])], "id string, token_id string, decided_at timestamp_ntz, input_watermark timestamp_ntz, new_state string"),
        "boosts": ([("b-late", "token-1", at(240), 1, Decimal(10), Decimal(10))], "id string, token_id string, received_at timestamp_ntz, active_boost_count int, amount decimal(38,18), total_amount decimal(38,18)"),
        "metadata": ([("m-old", "token-1", at(0), "Before"), ("m-late", "token-1", at(240), "After")], "id string, token_id string, received_at timestamp_ntz, name string"),
        "security": ([("s-old", "token-1", at(5), "available", "spl", "authority", "authority"), ("s-late", "token-1", at(240), "available", "spl", None, None)], "id string, token_id string, received_at timestamp_ntz, status string, token_program string, mint_authority string, freeze_authority string"),
        "context": ([("c", at(0), at(300), at(301), 150.0, 10)], "id string, bucket_start timestamp_ntz, bucket_end timestamp_ntz, received_at timestamp_ntz, sol_usd_price double, admitted_tokens int"),
        "candidate_tiers": ([("t", "token-1", at(240), at(240), "TIER_1")], "id string, token_id string, decided_at timestamp_ntz, input_watermark timestamp_ntz, new_tier string"),
        "selective_security": (
            [("holder-early", "token-1", "holder_snapshots", at(60), "historically_available", {"top10": "25"}), ("holder-late", "token-1", "holder_snapshots", at(240), "historically_available", {"top10": "80"}), ("edge", "token-1", "wallet_relationship_edges", at(60), "retrospectively_reconstructed", {})],
            "id string, token_id string, family string, received_at timestamp_ntz, acquisition_mode string, values map<string,string>",
        ),
    }
    return {k: spark.createDataFrame(rows, schema) for k, (rows, schema) in frames.items()}


def candidates(spark, *seconds):
    return spark.createDataFrame([("token-1", at(s)) for s in seconds], "token_id string, decision_at timestamp_ntz")


def test_state_as_of(spark, families):
    early, late = dataset.state_as_of(candidates(spark, 120, 301), families).orderBy("decision_at").collect()
    assert (early.lifecycle_new_state, early.metadata_name, early.security_mint_authority, early.holder_snapshots_id) == ("NEW", "Before", "authority", "holder-early")
    assert early.boost_received_at is None and early.context_received_at is None and early.tier_new_tier is None and early.obs_received_at == at(120)
    assert (late.lifecycle_new_state, late.metadata_name, late.security_mint_authority, late.holder_snapshots_id) == ("ACTIVE", "After", None, "holder-late")
    assert late.boost_amount == 10 and late.context_sol_usd_price == 150 and late.admission_at == T0


def test_all_families_of_the_state(spark, families):
    context = families["context"].withColumns({"sol_return_5m": F.lit(0.5), "aggregate_buys_m5": F.lit(30), "aggregate_sells_m5": F.lit(10), "mature_cohort_active_fraction": F.lit(0.25)})
    deep = families["selective_security"].unionByName(
        spark.createDataFrame([(f"e{t}", "token-1", "liquidity_event_evidence", at(t), "historically_available", {}) for t in (30, 90, 500)], families["selective_security"].schema)
    )
    more = families | {
        "context": context, "selective_security": deep, "tokens": spark.createDataFrame([("token-1", "mint", "e1", 3, True)], "token_id string, token_address string, epoch_id string, epoch_number long, epoch_data_valid boolean"),
        "discoveries": spark.createDataFrame([("d", "token-1", at(-5))], "id string, token_id string, received_at timestamp_ntz"),
        "pair_facts": spark.createDataFrame([("p", "token-1", "pair-1", at(130), at(-60)), ("q", "token-1", "pair-2", at(0), None)], "id string, token_id string, pair_id string, received_at timestamp_ntz, pair_created_at timestamp_ntz"),
        "candidates": spark.createDataFrame([("k", "token-1", at(200), at(190))], "id string, token_id string, candidate_at timestamp_ntz, input_watermark timestamp_ntz"),
    }
    before, early, late = dataset.state_as_of(candidates(spark, -10, 120, 310), more).orderBy("decision_at").collect()
    assert not before.identity_known and before.availability_watermark is None and before.liquidity_event_evidence_count == 0 and before.token_address == "mint"
    assert (early.identity_known, early.pair_created_at, early.candidate_id, early.liquidity_event_evidence_count, early.availability_watermark) == (True, None, None, 2, at(120))
    assert (late.pair_created_at, late.candidate_id, late.liquidity_event_evidence_id, late.wallet_relationship_edges_count, late.availability_watermark) == (at(-60), "k", "e90", 0, at(301))
    r = dataset.market_features(candidates(spark, 310), more).first()
    assert (r.sol_return_5m, r.aggregate_tracked_buy_ratio_m5, r.recent_active_conversion_fraction, r.aggregate_tracked_volume_m5_usd, r.pair_created_at_known, r.epoch_number) == (0.5, 0.75, 0.25, None, True, 3)
    assert sorted(e.id for e in dataset.security_events(candidates(spark, 120), more, "liquidity_event_evidence").collect()) == ["e30", "e90"]
    dataset.check_epochs(candidates(spark, 120), more)
    with pytest.raises(ValueError, match="epoch"):
        dataset.check_epochs(candidates(spark, 120), more | {"tokens": more["tokens"].withColumn("epoch_data_valid", F.lit(False))})


def test_features(spark, families):
    r = dataset.market_features(candidates(spark, 120), families).first()
    assert r.return_1m == pytest.approx(1.16 / 1.08 - 1) and r.buy_ratio_m5 > 0.8 and r.realized_volatility_5m < 0.02 and r.path_smoothness_5m is not None
    assert r.path_observation_count_5m == 9 and r.consecutive_positive_observations == 8 and r.mint_authority_state == "present" and r.return_5m is None
    assert r.token_age_seconds == 120 and not r.boost_known and r.transactions_m5 == 38 + 5


def test_the_future_changes_no_feature(spark, families):
    later = families["observations"].limit(1).withColumns({"id": F.lit("x"), "received_at": F.lit(at(120) + timedelta(microseconds=1)), "price_usd": F.lit(999999).cast("decimal(38,18)")})
    more = families | {"observations": families["observations"].unionByName(later)}
    assert dataset.market_features(candidates(spark, 120), more).collect() == dataset.market_features(candidates(spark, 120), families).collect()


def test_labels(spark, families):
    r = dataset.outcome_labels(candidates(spark, 120), families).first()
    assert (r.crossed_minus_80pct_5m, r.major_liquidity_collapse_5m, r.crossed_plus_50pct_24h) == ("TRUE", "TRUE", "UNKNOWN")
    assert r.theoretical_market_return_5m is not None and r.execution_adjusted_return is None and r.future_lifecycle_state_5m == "ACTIVE"
    assert r.horizon_5m_available and r.horizon_5m_path_complete and not r.horizon_24h_available and r.plus_50_before_minus_25 == "FALSE"
    assert r.time_to_minus_80_seconds == r.time_to_collapse_seconds and r.maximum_adverse_excursion_5m == pytest.approx(0.01 / 1.16 - 1)


def test_flat_history_stays_unknown(spark, families):
    flat = families["observations"].filter("id < 'o-008'").withColumn("price_usd", F.lit("0.000000131").cast("decimal(38,18)"))
    r = dataset.outcome_labels(candidates(spark, 30), families | {"observations": flat}).first()
    assert r.crossed_plus_100pct_5m == "UNKNOWN"


def test_pair_with_most_liquidity(spark):
    rows = [("a", "t", "p1", at(0), 100.0), ("b", "t", "p2", at(1), 5000.0), ("c", "t", "p2", at(5), None), ("d", "t", "p3", at(9), 9e9)]
    obs = spark.createDataFrame(rows, "id string, token_id string, pair_id string, received_at timestamp_ntz, liquidity_usd double")
    probes = spark.createDataFrame([("t", at(s)) for s in (0, 2, 6, 20)], "token_id string, decision_at timestamp_ntz")
    got = [r.selected_pair_id for r in dataset.selected_pairs(probes, obs).orderBy("decision_at").collect()]
    assert got == ["p1", "p2", "p1", "p3"]


def test_facts_that_look_ahead_are_rejected(spark, families):
    bad = families["lifecycle"].withColumn("input_watermark", F.col("decided_at") + F.expr("INTERVAL 1 SECOND"))
    with pytest.raises(ValueError, match="lifecycle"):
        dataset.check_facts(families | {"lifecycle": bad})


def test_build_and_publish(spark, families, tmp_path):
    rows = dataset.build(candidates(spark, 60, 120, 300), families)
    assert len(rows.columns) > 300 and rows.count() == 3
    said = dataset.publish(rows, f"file://{tmp_path}/d", {"features": 1})
    again = dataset.publish(rows.repartition(5), f"file://{tmp_path}/d", {"features": 1})
    assert said == again and dataset.verify(spark, said)
    assert dataset.content(rows.repartition(7))["digest"] == said["digest"]
    report = {(r.name, r.measure): r.value for r in dataset.quality_report(rows).collect()}
    assert report["execution_adjusted_return", "nulls"] == 1 and report["crossed_plus_50pct_24h", "UNKNOWN"] == 1
    rows.limit(1).write.mode("append").parquet(f"{said['path']}/rows")
    with pytest.raises(ValueError):
        dataset.verify(spark, said)
