"""Holder, trader and wallet analytics, and payload parsing."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.plans import security

ACCOUNTS = [("t", "p", "pool", "400", True, False), ("t", "a1", "wallet-a", "300", False, False), ("t", "a2", "wallet-a", "100", False, False), ("t", "b", "wallet-b", "50", False, True)]
ACCOUNT = "token_id string, token_account string, owner_wallet string, raw_balance string, is_known_pool boolean, is_creator boolean"


def test_holders(spark):
    accounts = spark.createDataFrame(ACCOUNTS, ACCOUNT)
    r = {complete: security.holder_metrics(accounts, spark.createDataFrame([("t", "1000", complete)], "token_id string, supply string, complete boolean")).first() for complete in (False, True)}
    top = r[False]
    assert [top.top_1_pct, top.largest_non_pool_holder_pct, top.creator_holder_pct, top.covered_supply_pct] == pytest.approx([40, 40, 5, 85]) and top.hhi is None
    assert r[True].hhi == pytest.approx(0.3225)
    unknown = security.holder_metrics(accounts, spark.createDataFrame([("t", None, True)], "token_id string, supply string, complete boolean")).first()
    assert all(v is None for k, v in unknown.asDict().items() if k != "token_id")


def trades(spark, wallets):
    rows = [("t", f"w{i % wallets}", "BUY" if i % 3 else "SELL", float(1 + i % 17)) for i in range(1000)]
    return security.trader_metrics(spark.createDataFrame(rows, "token_id string, wallet string, side string, notional_usd double")).first()


def test_traders(spark):
    organic, few, three = (trades(spark, n) for n in (700, 15, 3))
    assert (organic.unique_traders, few.unique_traders, three.unique_traders) == (700, 15, 3)
    assert organic.repeat_trader_ratio < few.repeat_trader_ratio and organic.top_10_trader_volume_share < few.top_10_trader_volume_share < three.top_10_trader_volume_share
    dark = spark.createDataFrame([("t", None, "BUY", 5.0), ("t", "a", "SELL", None)], "token_id string, wallet string, side string, notional_usd double")
    r = security.trader_metrics(dark).first()
    assert (r.unique_buyers, r.unique_sellers, r.unique_traders, r.volume_usd, r.p90_trade_usd) == (None, 1, None, 5.0, 5.0)


def test_clusters(spark):
    rows = [("a", "b", "COMMON_FUNDER"), ("b", "c", "DIRECT_TRANSFER"), ("x", "y", "LP_LINK")]
    schema = "wallet_a string, wallet_b string, relationship_type string"
    got = sorted(security.wallet_clusters(spark.createDataFrame(rows, schema)).collect())
    back = sorted(security.wallet_clusters(spark.createDataFrame([(b, a, t) for a, b, t in rows[::-1]], schema)).collect())
    assert got == back and [(r.cluster, r["size"], r.explanation) for r in got] == [("a", 3, ["COMMON_FUNDER", "DIRECT_TRANSFER"]), ("x", 2, ["LP_LINK"])]


def test_security_features(spark):
    at = "2026-08-16 12:00:00"
    accounts = spark.createDataFrame(ACCOUNTS, ACCOUNT)
    holders = security.holder_metrics(accounts, spark.createDataFrame([("t", "1000", True)], "token_id string, supply string, complete boolean"))
    rows = [("t", f"w{i % 4}", "BUY" if i % 2 else "SELL", 10.0) for i in range(20)]
    trades = spark.createDataFrame(rows, "token_id string, wallet string, side string, notional_usd double")
    members = spark.createDataFrame([("t", "w0", "c1"), ("t", "w1", "c1"), ("t", "w2", "c2")], "token_id string, wallet string, cluster string")
    shares = security.largest_cluster_share(trades, members)
    one, two = (
        security.security_features(spark.createDataFrame([("t", at, ids), ("u", at, [])], "token_id string, generated_at string, input_fact_ids array<string>"), holders, security.trader_metrics(trades), [shares]).orderBy("token_id").collect()
        for ids in (["a", "b"], ["b", "a"])
    )
    t, u = one
    assert one == two and (t.unique_trader_count, t.trades_per_unique_trader, t.wallet_cluster_count, t.largest_cluster_trade_share) == (4, 5, 2, 50)
    assert t.holder_top10_pct == pytest.approx(85) and t.holder_hhi == pytest.approx(0.3225) and t.common_funder_share is None and t.feature_set == security.FEATURE_SET
    assert all(v is None for k, v in u.asDict().items() if k not in ("token_id", "feature_set", "feature_version", "generated_at", "input_sha256"))
    assert len(one[0]) == 21


POLICY = {
    "liquidity": 1000, "transactions": 10, "turnover": 0.05, "second_liquidity": 50000, "second_transactions": 50, "second_turnover": 0.1, "security_freshness": 3600, "deep_holder_top10": 60, "deep_trades": 100,
    "deep_traders": 20, "deep_common_funder": 50, "deep_liquidity_removal": 20,
}
NAMES = {"liquidity": "double", "volume_m5": "double", "buys": "int", "sells": "int", "lifecycle": "string", "security_age": "int", "boosted": "boolean", "resurrected": "boolean", "holder_top10": "double", "unique_traders": "int", "total_trades": "int", "common_funder": "double", "liquidity_removal": "double"}


@pytest.mark.parametrize(
    ("current", "evidence", "tier", "reason"),
    [
        ("TIER_0", {"liquidity": 20000.0, "volume_m5": 2000.0, "buys": 20, "sells": 5}, "TIER_1", "MARKET_ACTIVITY"), ("TIER_0", {"liquidity": 999.0, "volume_m5": 2000.0, "buys": 1, "sells": 0}, "TIER_0", "ACTIVITY_COOLING"),
        ("TIER_0", {"liquidity": 100000.0, "volume_m5": 20000.0, "buys": 60, "sells": 10, "security_age": 300}, "TIER_1", "MARKET_ACTIVITY"), ("TIER_1", {"liquidity": 100000.0, "volume_m5": 20000.0, "buys": 60, "sells": 10, "security_age": 300}, "TIER_2", "MARKET_ACTIVITY"),
        ("TIER_2", {"holder_top10": 65.0}, "TIER_3", "SECURITY_CHANGE"), ("TIER_1", {"holder_top10": 65.0}, "TIER_0", "EVIDENCE_STALE"), ("TIER_0", {"boosted": True}, "TIER_1", "BOOST_ACTIVITY"), ("TIER_0", {}, "TIER_0", "ACTIVITY_COOLING"),
    ],
)
def test_candidate_policy(spark, current, evidence, tier, reason):
    e = {n: F.lit(evidence.get(n)).cast(t) for n, t in NAMES.items()}
    r = spark.range(1).select(security.candidate_decision(F.lit(current), e, POLICY).alias("d")).first().d
    assert (r.tier, r.reason) == (tier, reason)


def test_pair_payload(spark):
    body = {
        "chainId": "solana", "pairAddress": "P", "baseToken": {"address": "B"}, "quoteToken": {"address": "Q"}, "priceUsd": "0.000000000000000123", "liquidity": {"usd": "10", "base": "0", "quote": None},
        "txns": {"h6": {"buys": 0, "sells": None}, "h24": {"buys": 44, "sells": 21}}, "info": {"websites": [{"url": "w"}], "socials": [{"type": "twitter", "url": "t1"}, {"platform": "Telegram", "handle": "t2"}, {"type": "tiktok", "url": "t3"}]},
    }
    raw = spark.createDataFrame([(json.dumps(body),), ("{broken",), (None,)], "body string")
    r = parse.pair_observations(raw).first()
    assert (r.buys_h6, r.sells_h6, r.buys_h24, r.sells_h24, r.buys_m5) == (0, None, 44, 21, None) and (r.liquidity_base, r.liquidity_quote) == (0, None) and str(r.price_usd) == "1.23E-16"
    assert parse.pair_observations(raw).count() == 3
    x = parse.links(raw).first()
    assert (x.website, x.twitter, x.telegram, x.discord, x.other_links) == ("w", "t1", "t2", None, ["t3"])
    wanted = spark.createDataFrame([("Q",), ("Z",)], "address string")
    assert [(m.address, m.side) for m in parse.matched_pairs(parse.pair_observations(raw), wanted).collect()] == [("Q", "quote")]


def test_mint_and_encodings(spark):
    data = (1).to_bytes(4, "little") + bytes(range(32)) + (1_000_000).to_bytes(8, "little") + bytes([6, 1]) + (0).to_bytes(4, "little") + bytes(32)
    df = spark.createDataFrame([(bytearray(data), "x"), (bytearray(b"short"), None)], "data binary, name string")
    good, short = df.select(parse.mint_account("data").alias("m"), parse.base58_text("data").alias("b"), parse.named_uuid(uuid.NAMESPACE_URL)("name").alias("u")).collect()
    assert (good.m.supply, good.m.decimals, good.m.initialized, good.m.mint_authority, good.m.freeze_authority) == (1_000_000, 6, True, bytes(range(32)).hex(), None)
    assert short.m is None and short.u is None and good.u == str(uuid.uuid5(uuid.NAMESPACE_URL, "x")) and parse.base58(b"\0\0hello") == "11Cn8eVZg"
    flags = spark.createDataFrame([('{"a":"\\u0000"}',), ('{"a":"\\ud800"}',), ('{"a":"\\ud83d\\ude00"}',)], "body string").select(parse.raw_is_safe("body").alias("ok")).collect()
    assert [f.ok for f in flags] == [False, False, True]
