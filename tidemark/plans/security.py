"""Holder, trader and wallet analytics of many tokens at once.

Amounts are summed by owner or wallet before anything is ranked, so a token with very many
trades costs one row for each wallet and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import ratio
from tidemark.operators.graph import connected_components
from tidemark.work import spread


def percent(a: Column | str, b: Column | str) -> Column:
    return ratio(a, b) * 100


def holder_metrics(accounts: DataFrame, supplies: DataFrame, by: Sequence[str] = ("token_id",)) -> DataFrame:
    """Shares of a token's supply in percent, and the Herfindahl index of a complete distribution.

    accounts: by, token_account, owner_wallet, raw_balance, is_known_pool, is_creator. supplies: by, supply,
    complete. An account without a known owner is an owner of its own. An unknown or empty supply gives nulls. Balances may
    have more digits than a decimal holds; they are taken as doubles."""
    owner = F.coalesce("owner_wallet", F.concat(F.lit("unknown-token-account:"), F.col("token_account")))
    balance = F.col("raw_balance").cast("double")
    held = accounts.groupBy(*by, owner.alias("owner")).agg(F.sum(balance).alias("held"),
        F.sum(F.when(~F.col("is_known_pool"), balance)).alias("outside"), F.sum(F.when(F.col("is_creator"), balance)).alias("creator"))
    ranked = held.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(F.col("held").desc(), "owner")))
    sums = ranked.groupBy(*by).agg(
        *[F.sum(F.when(F.col("k") <= n, F.col("held"))).alias(f"top{n}") for n in (1, 5, 10, 20)], F.max("outside").alias("outside"),
        F.sum("creator").alias("creator"), F.sum("held").alias("held"), F.sum(F.col("held") * F.col("held")).alias("squares")
    )
    s = supplies.withColumn("supply", F.when(F.col("supply").cast("double") > 0, F.col("supply").cast("double")))
    out = s.join(sums, list(by), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return out.select(
        *by, *[percent(zero(f"top{n}"), "supply").alias(f"top_{n}_pct") for n in (1, 5, 10, 20)],
        percent(zero("outside"), "supply").alias("largest_non_pool_holder_pct"),
        F.when(F.col("creator") > 0, percent("creator", "supply")).alias("creator_holder_pct"), percent(zero("held"), "supply").alias("covered_supply_pct"),
        F.when(F.col("complete"), F.try_divide(zero("squares"), F.col("supply") * F.col("supply"))).alias("hhi"),
    )


def trader_metrics(trades: DataFrame, by: Sequence[str] = ("token_id",)) -> DataFrame:
    """Counts, sizes and concentration of a token's trades: by, wallet, side (BUY, SELL), notional_usd.

    Counts of distinct wallets are null where a wallet is unknown. The 90th and 95th
    percentiles are nearest-rank, the median is between the middles."""
    known, amount = F.col("wallet").isNotNull(), F.col("notional_usd").cast("double")
    side = lambda s: F.col("side") == s
    counts = trades.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_trades"), F.count_if(side("BUY")).alias("buy_trades"), F.count_if(side("SELL")).alias("sell_trades"),
        F.count_if(known).alias("known"),
        F.count_if(side("BUY") & ~known).alias("dark_buys"), F.count_if(side("SELL") & ~known).alias("dark_sells"), F.sum(amount).alias("volume_usd"),
        F.median(amount).alias("median_trade_usd"),
        F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY CAST(notional_usd AS DOUBLE))").alias("p90_trade_usd"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY CAST(notional_usd AS DOUBLE))").alias("p95_trade_usd"), F.max(amount).alias("largest_trade_usd"),
    )
    wallets = trades.filter(known).groupBy(*by, "wallet").agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("v"),
        F.bool_or(side("BUY")).alias("bought"), F.bool_or(side("SELL")).alias("sold"))
    ranked = wallets.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(F.coalesce("v", F.lit(0.0)).desc(), "wallet")))
    sums = ranked.groupBy(*by).agg(
        F.count_if("bought").alias("buyers"), F.count_if("sold").alias("sellers"), F.count(F.lit(1)).alias("traders"),
        F.count_if(F.col("bought") & F.col("sold")).alias("both"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("repeated"),
        *[F.sum(F.when(F.col("k") <= n, F.col("v"))).alias(f"top{n}") for n in (1, 5, 10)],
    )
    out = counts.join(sums, list(by), "left").fillna(0, ["buyers", "sellers", "traders", "both", "repeated"])
    return out.select(
        *by, "total_trades", "buy_trades", "sell_trades", F.when(F.col("dark_buys") == 0, F.col("buyers")).alias("unique_buyers"),
        F.when(F.col("dark_sells") == 0, F.col("sellers")).alias("unique_sellers"),
        F.when(F.col("known") == F.col("total_trades"), F.col("traders")).alias("unique_traders"), "volume_usd", "median_trade_usd", "p90_trade_usd",
        "p95_trade_usd", "largest_trade_usd",
        *[F.when(F.col("volume_usd") > 0, percent(F.coalesce(f"top{n}", F.lit(0.0)), "volume_usd")).alias(f"top_{n}_trader_volume_share") for n in (1, 5, 10)],
        F.when(F.col("known") > 0, ratio("repeated", "known")).alias("repeat_trader_ratio"),
        ratio("both", F.col("buyers") + F.col("sellers") - F.col("both")).alias("buy_sell_wallet_overlap"),
    )


def wallet_clusters(edges: DataFrame) -> DataFrame:
    """Components of factual edges (wallet_a, wallet_b, relationship_type): cluster, its size, members' digest and why.

    A row for each cluster; members are counted and digested, not listed, as a cluster may be any size.
    The order and direction of edges make no difference."""
    members = connected_components(edges, "wallet_a", "wallet_b")
    digest = F.sum(F.conv(F.substring(F.sha2("node", 256), 1, 12), 16, 10).cast("decimal(38,0)"))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), digest.cast("string").alias("members_digest"))
    why = edges.join(members, F.col("wallet_a") == F.col("node")).groupBy("component").agg(F.array_sort(F.collect_set("relationship_type")).alias("explanation"))
    return sizes.join(why, "component").select(F.col("component").alias("cluster"), "size", "members_digest", "explanation")


def bounded_edges(edges: DataFrame, by: Sequence[str], order: str, most_edges: int, most_wallets: int) -> DataFrame:
    """The first edges of each key, and of these the ones between its first wallets by name, with whether anything was left out.

    The bounds are the feature: what a key may ask of a provider. Clusters themselves go over all edges."""
    w = Window.partitionBy(*by).orderBy(order)
    numbered = spread(edges, *by).withColumn("_k", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    first = numbered.filter(F.col("_k") <= most_edges)
    wallets = first.select(*by, F.explode(F.array("wallet_a", "wallet_b")).alias("_wallet")).distinct()
    ranked = wallets.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_wallet"))).withColumn("_all",
        F.count(F.lit(1)).over(Window.partitionBy(*by)))
    allowed = ranked.filter(F.col("_r") <= most_wallets)
    out = first
    for side in ("wallet_a", "wallet_b"):
        out = out.join(allowed.select(*by, F.col("_wallet").alias(side), F.col("_all").alias(f"_{side}")), [*by, side])
    partial = (F.col("_n") > most_edges) | (F.col("_wallet_a") > most_wallets)
    return out.select(*edges.columns, partial.alias("partial"))


def common_funder_share(funding: DataFrame, by: Sequence[str] = ("token_id",)) -> DataFrame:
    """Percent of a token's funding facts that come from its most common source."""
    n = funding.groupBy(*by, "source_wallet").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*by).agg(percent(F.max("n"), F.sum("n")).alias("common_funder_share"))


def collapse_rate(history: DataFrame, by: Sequence[str] = ("creator",)) -> DataFrame:
    """Percent of a creator's earlier launches that collapsed."""
    return history.groupBy(*by).agg(percent(F.count_if("collapsed"), F.count(F.lit(1))).alias("creator_prior_collapse_rate"))


def recent(facts: DataFrame, probes: DataFrame, by: Sequence[str], at: str, received: str, minutes: int, value: Column, name: str) -> DataFrame:
    """For each probe an aggregate over the facts of the last minutes before it, e.g. the strength of
    synchronized trades or the largest removal of liquidity; null without any."""
    from tidemark.operators.asof import path_join

    found = path_join(probes, facts, list(by), at, received, -60 * minutes, 0, closed_start=True)
    return probes.join(found.groupBy(*by, at).agg(value.alias(name)), [*by, at], "left")


# Name and version of the security feature set, and features that are taken as they come.
FEATURE_SET, FEATURE_VERSION = "security_features", "v1"
GIVEN = {
    "creator_hold_pct": "double", "creator_prior_collapse_rate": "double", "wallet_cluster_count": "long", "largest_cluster_trade_share": "double",
    "common_funder_share": "double", "synchronized_trade_score": "double",
    "liquidity_removal_recent_pct": "double", "liquidity_change_velocity": "double", "creator_transfer_activity": "long",
    "security_snapshot_age_seconds": "double",
}


def security_features(probes: DataFrame, holders: DataFrame, traders: DataFrame, given: Sequence[DataFrame] = (), by: Sequence[str] = ("token_id",),
    at: str = "generated_at") -> DataFrame:
    """The security feature row of each probe (by, at, and input_fact_ids, an array of the facts used).

    holders and traders are what holder_metrics and trader_metrics return, given are tables of by and
    any of GIVEN; a key or a feature without facts is null. The digest of the inputs is the same for any order of their ids."""
    out = probes.join(holders.select(*by, "top_10_pct", "hhi"), list(by), "left")
    out = out.join(traders.select(*by, "unique_traders", "total_trades", "top_10_trader_volume_share", "repeat_trader_ratio"), list(by), "left")
    for table in given:
        out = out.join(table.select(*by, *[c for c in GIVEN if c in table.columns]), list(by), "left")
    have = set(out.columns)
    return out.select(
        *by, F.lit(FEATURE_SET).alias("feature_set"), F.lit(FEATURE_VERSION).alias("feature_version"), at,
        F.col("top_10_pct").alias("holder_top10_pct"), F.col("hhi").alias("holder_hhi"),
        F.col("unique_traders").alias("unique_trader_count"), ratio("total_trades", "unique_traders").alias("trades_per_unique_trader"),
        F.col("top_10_trader_volume_share").alias("top10_trader_volume_share"),
        F.col("repeat_trader_ratio").alias("repeat_trade_ratio"), *[(F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in GIVEN.items()],
        F.sha2(F.to_json(F.array_sort("input_fact_ids")), 256).alias("input_sha256"),
    )


def largest_cluster_share(trades: DataFrame, members: DataFrame, by: Sequence[str] = ("token_id",)) -> DataFrame:
    """wallet_cluster_count and largest_cluster_trade_share of each token: clusters (by, wallet, cluster) with trades, and the percent
    of the token's traded volume that the busiest of them moves; a wallet in no cluster counts in the volume only."""
    moved = trades.groupBy(*by, "wallet").agg(F.sum(F.col("notional_usd").cast("double")).alias("v"))
    parts = moved.join(members.select(*by, "wallet", "cluster"), [*by, "wallet"], "left").groupBy(*by, "cluster").agg(F.sum("v").alias("v"))
    clustered = F.col("cluster").isNotNull()
    return parts.groupBy(*by).agg(F.count_if(clustered).alias("wallet_cluster_count"),
        percent(F.max(F.when(clustered, F.col("v"))), F.sum("v")).alias("largest_cluster_trade_share"))


def candidate_decision(current: Column, e: dict[str, Column], policy: dict[str, float]) -> Column:
    """Target tier and reason of a candidate from evidence that was there at its evaluation.

    e: liquidity, volume_m5, buys, sells, lifecycle, security_age (seconds), boosted, resurrected, holder_top10,
    unique_traders, total_trades, common_funder, liquidity_removal. Unknown evidence meets no rule."""
    sure = lambda c: F.coalesce(c, F.lit(False))
    trades, turnover = e["buys"] + e["sells"], ratio(e["volume_m5"], e["liquidity"])

    def market(prefix: str) -> Column:
        return sure((e["liquidity"] >= policy[f"{prefix}liquidity"]) & (trades >= policy[f"{prefix}transactions"]) & (turnover >= policy[f"{prefix}turnover"]))

    deep = sure(e["holder_top10"] >= policy["deep_holder_top10"]) | sure((e["total_trades"] >= policy["deep_trades"]) & (e["unique_traders"] <= policy["deep_traders"]))
    deep = deep | sure(e["common_funder"] >= policy["deep_common_funder"]) | sure(e["liquidity_removal"] >= policy["deep_liquidity_removal"])
    reason = (
        F.when(sure(e["boosted"]), "BOOST_ACTIVITY").when(sure(e["resurrected"]),
        "COVERAGE_RESURRECTION").when(market("") & sure(e["lifecycle"] == "WATCH"), "WATCH_STATE").when(market(""), "MARKET_ACTIVITY")
    )
    second = current.isin("TIER_1", "TIER_2") & market("second_") & sure(e["security_age"] <= policy["security_freshness"])
    tier = lambda t, r: F.struct(F.lit(t).alias("tier"), r.alias("reason"))
    return (
        F.when(current.isin("TIER_2", "TIER_3") & deep, tier("TIER_3", F.lit("SECURITY_CHANGE")))
        .when(reason.isNotNull() & second, tier("TIER_2", reason)).when(reason.isNotNull(), tier("TIER_1", reason))
        .otherwise(tier("TIER_0", F.when(current != "TIER_0", "EVIDENCE_STALE").otherwise("ACTIVITY_COOLING")))
    )
