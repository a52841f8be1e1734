"""Feature and outcome datasets over normalized fact families, one DataFrame plan for all tokens.

Families are DataFrames keyed by token_id; candidates are (token_id, decision_at). Every family takes
one as-of pass; lookbacks of all horizons share one; outcomes of all horizons
come from one join of candidates with what follows. Nothing is read per token.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS, buy_ratio, change, imbalance, micros, ratio, row_digest, slope, tri_state
from tidemark.operators import pathtree
from tidemark.operators.asof import asof_join, asof_largest, lookbacks, path_join
from tidemark.operators.paths import DENSE, fullest_span
from tidemark.operators.stats import quantiles, value_counts
from tidemark.work import durable

KEY = ["token_id", "decision_at"]

# Lookback horizons and tolerances, label horizons and forward tolerances, in seconds.
LOOKBACK = {"5s": (5, 5), "15s": (15, 10), "30s": (30, 15), "1m": (60, 30), "2m": (120, 60), "5m": (300, 120), "15m": (900, 300)}
HORIZONS = {"30s": (30, 15), "1m": (60, 30), "5m": (300, 120), "15m": (900, 300), "1h": (3600, 900), "6h": (21600, 3600), "24h": (86400, 10800),
    "7d": (604800, 43200)}
# Price multiples of the crossing labels, the ordered labels and the times to a crossing.
UPSIDE = {"plus_25pct": 1.25, "plus_50pct": 1.5, "plus_100pct": 2.0, "plus_200pct": 3.0, "plus_500pct": 6.0, "2x": 2.0, "5x": 5.0, "10x": 10.0, "50x": 50.0}
DOWNSIDE = {"minus_20pct": 0.8, "minus_30pct": 0.7, "minus_50pct": 0.5, "minus_80pct": 0.2, "minus_95pct": 0.05}
ORDERED = {"plus_50_before_minus_25": (1.5, 0.75), "plus_100_before_minus_30": (2.0, 0.7), "plus_200_before_minus_40": (3.0, 0.6),
    "5x_before_minus_50": (5.0, 0.5)}
TIMES = {"time_to_plus_50_seconds": 1.5, "time_to_2x_seconds": 2.0, "time_to_5x_seconds": 5.0, "time_to_minus_50_seconds": 0.5, "time_to_minus_80_seconds": 0.2}
NOTIONALS = (100, 1000, 5000)
MARKET = ("price_usd", "price_native", "liquidity_usd", "market_cap_usd", "fully_diluted_valuation_usd", "volume_m5_usd", "volume_h1_usd",
    "volume_h6_usd", "volume_h24_usd")
FLOWS = ("m5", "h1", "h6", "h24")
COUNTS = tuple(f"{side}_{s}" for s in FLOWS for side in ("buys", "sells"))
# Families of deep security facts. Of snapshots the latest one matters, events are counted too.
SNAPSHOTS = ("holder_snapshots", "trader_distribution_snapshots", "creator_history_snapshots", "security_feature_snapshots")
EVENTS = ("liquidity_event_evidence", "wallet_relationship_edges", "wallet_cluster_snapshots", "funding_relationship_evidence")
# What is known of a market as a whole, and what identifies a token.
CONTEXT = {"sol_usd_price": "double", "sol_return_5m": "double", "sol_realized_volatility_1h": "double", "admitted_tokens": "long",
    "mature_cohort_active_fraction": "double", "aggregate_volume_m5_usd": "double", "aggregate_buys_m5": "long", "aggregate_sells_m5": "long"}
#: All candidates share the line of the context; it is sorted in chunks of so many seconds.
CONTEXT_SPLIT = 3600
IDENTITY = {"token_address": "string", "epoch_id": "string", "epoch_number": "long"}


def doubles(observations: DataFrame) -> DataFrame:
    """Measures as doubles: a quotient of two decimals of scale 18 would keep six digits only."""
    have = set(observations.columns)
    return observations.withColumns({c: (F.col(c) if c in have else F.lit(None)).cast("double") for c in MARKET} | {c: (F.col(c) if c in have else F.lit(None)).cast("long") for c in COUNTS})


def selected_pairs(candidates: DataFrame, observations: DataFrame) -> DataFrame:
    """The pair of each candidate: of the latest known observation of each of its token's pairs, the one with most
    liquidity, known before unknown, later before earlier, then by id; null before any observation."""
    pairs = observations.select("token_id", "pair_id").distinct()
    latest = asof_join(candidates.join(pairs, "token_id"), observations, ["token_id", "pair_id"], "decision_at", "received_at",
        ["liquidity_usd", "received_at"], tie="id", prefix="l_")
    rank = F.struct(F.col("l_liquidity_usd").isNotNull(), F.coalesce("l_liquidity_usd", F.lit(-1.0)), F.col("l_received_at"), F.col("pair_id"))
    best = latest.filter("l_received_at IS NOT NULL").groupBy(*KEY).agg(F.max_by("pair_id", rank).alias("selected_pair_id"))
    return candidates.join(best, KEY, "left")


def with_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """df with the named columns cast to their kinds; nulls for those that it lacks."""
    have = set(df.columns)
    return df.withColumns({c: (F.col(c) if c in have else F.lit(None)).cast(k) for c, k in kinds.items()})


def security_events(candidates: DataFrame, families: Mapping[str, DataFrame], family: str) -> DataFrame:
    """A row for each candidate and each deep security fact of a family that was known at its decision."""
    facts = families["selective_security"].filter((F.col("acquisition_mode") == "historically_available") & (F.col("family") == family))
    return candidates.select(*KEY).distinct().join(facts, "token_id").filter(F.col("received_at") <= F.col("decision_at"))


def check_epochs(candidates: DataFrame, families: Mapping[str, DataFrame]) -> None:
    """Raises if a candidate's token is of an epoch whose data are not valid (tokens.epoch_data_valid)."""
    if "tokens" in families and "epoch_data_valid" in families["tokens"].columns:
        if not candidates.join(families["tokens"].filter("NOT epoch_data_valid"), "token_id", "left_semi").isEmpty():
            raise ValueError("a token of an invalid epoch is excluded from datasets")


def check_facts(families: Mapping[str, DataFrame]) -> None:
    """Raises if a derived fact looked ahead of its own decision, or context came before its bucket closed."""
    rules = {
        "lifecycle": F.col("input_watermark") > F.col("decided_at"), "candidates": F.col("input_watermark") > F.col("candidate_at"),
        "candidate_tiers": F.col("input_watermark") > F.col("decided_at"),
        "context": F.col("received_at") < F.col("bucket_end"),
        "selective_security": ~F.col("acquisition_mode").isin("historically_available", "retrospectively_reconstructed"),
    }
    for name, broken in rules.items():
        if name in families and not families[name].filter(broken).isEmpty():
            raise ValueError(f"{name}: a fact breaks its time contract")


def state_as_of(candidates: DataFrame, families: Mapping[str, DataFrame]) -> DataFrame:
    """What was known of each candidate at its decision: selected pair, current observation, and the latest fact of each family.

    A family that is missing is one without facts. Columns carry their family as prefix."""
    obs = doubles(families["observations"])
    out = selected_pairs(candidates.select(*KEY).distinct(), obs)
    current = asof_join(out, obs.withColumnRenamed("pair_id", "selected_pair_id"), ["token_id", "selected_pair_id"], "decision_at", "received_at",
        ["id", "received_at", *MARKET, *COUNTS], tie="id", prefix="obs_")
    out, at = current, dict(candidates.dtypes)["decision_at"]

    def latest(name: str, at: str, payload: Sequence[str], prefix: str, keep: Column | None = None) -> None:
        nonlocal out
        if name not in families:
            out = out.withColumns({prefix + c: F.lit(None) for c in payload})
            return
        facts = families[name] if keep is None else families[name].filter(keep)
        found = asof_join(candidates.select(*KEY).distinct(), facts, ["token_id"], "decision_at", at, payload, tie="id", prefix=prefix)
        out = out.join(found, KEY)

    if "tokens" in families:
        out = out.join(with_columns(families["tokens"], IDENTITY).select("token_id", *IDENTITY), "token_id", "left")
    else:
        out = out.withColumns({c: F.lit(None).cast(k) for c, k in IDENTITY.items()})
    if "pair_facts" in families:
        found = asof_join(
            current.select(*KEY, "selected_pair_id").filter("selected_pair_id IS NOT NULL"),
            families["pair_facts"].withColumnRenamed("pair_id", "selected_pair_id"),
            ["token_id", "selected_pair_id"], "decision_at", "received_at", ["received_at", "pair_created_at"], tie="id", prefix="pair_",
        )
        out = out.join(found.drop("selected_pair_id").withColumnRenamed("pair_pair_created_at", "pair_created_at"), KEY, "left")
    else:
        out = out.withColumns({c: F.lit(None).cast(at) for c in ("pair_received_at", "pair_created_at")})
    latest("discoveries", "received_at", ["received_at"], "discovery_")
    latest("candidates", "candidate_at", ["id", "candidate_at"], "candidate_", F.col("input_watermark") <= F.col("candidate_at"))
    latest("lifecycle", "decided_at", ["new_state", "decided_at"], "lifecycle_", F.col("input_watermark") <= F.col("decided_at"))
    latest("metadata", "received_at", ["received_at", "name"], "metadata_")
    latest("security", "received_at", ["received_at", "status", "token_program", "mint_authority", "freeze_authority"], "security_")
    latest("candidate_tiers", "decided_at", ["new_tier", "decided_at"], "tier_", F.col("input_watermark") <= F.col("decided_at"))
    if "boosts" in families:
        w = Window.partitionBy("token_id").orderBy("received_at", "id")
        seen = families["boosts"].withColumns({"amount": F.col("amount").cast("double"), "total_amount": F.col("total_amount").cast("double")})
        seen = seen.withColumns({"previous_amount": F.lag("amount").over(w), "previous_total_amount": F.lag("total_amount").over(w),
            "first_received_at": F.min("received_at").over(w)})
        found = asof_join(candidates.select(*KEY).distinct(), seen, ["token_id"], "decision_at", "received_at",
            ["received_at", "active_boost_count", "amount", "total_amount", "previous_amount", "previous_total_amount", "first_received_at"],
            tie="id", prefix="boost_")
        out = out.join(found, KEY)
    else:
        out = out.withColumns({f"boost_{c}": F.lit(None) for c in ("received_at", "active_boost_count", "amount", "total_amount", "previous_amount",
            "previous_total_amount", "first_received_at")})
    if "lifecycle" in families:
        admitted = families["lifecycle"].filter("new_state = 'NEW' AND input_watermark <= decided_at").groupBy("token_id").agg(F.min("decided_at").alias("_new"))
        out = out.join(admitted, "token_id", "left").withColumn("admission_at", F.when(F.col("_new") <= F.col("decision_at"), F.col("_new"))).drop("_new")
    else:
        out = out.withColumn("admission_at", F.lit(None).cast(dict(candidates.dtypes)["decision_at"]))
    if "coverage" in families:
        found = asof_largest(candidates.select(*KEY).distinct(), families["coverage"], ["token_id"], "decision_at", ["decided_at", "effective_at"],
            ["effective_at", "decided_at", "id"], ["coverage_class"], prefix="")
        out = out.join(found, KEY)
    else:
        out = out.withColumn("coverage_class", F.lit(None).cast("string"))
    payload = ["received_at", "bucket_start", "bucket_end", *CONTEXT]
    if "context" in families:  # one line for all tokens (of an epoch), so it is cut into days
        source = candidates if "epoch_id" in candidates.columns else out
        key = "epoch_id" if "epoch_id" in families["context"].columns and ("epoch_id" in candidates.columns or "tokens" in families) else None
        probes = source.select(*KEY, *([key] if key else [])).distinct().withColumn("_all", F.lit(0))
        facts = with_columns(families["context"], CONTEXT).withColumn("_all", F.lit(0))
        found = asof_largest(probes, facts, [key or "_all"], "decision_at", ["received_at", "bucket_end"], ["received_at", "bucket_end", "id"],
            payload, prefix="context_", split_seconds=CONTEXT_SPLIT)
        out = out.join(found.drop("_all", "epoch_id"), KEY)
    else:
        out = out.withColumns({f"context_{c}": F.lit(None) for c in payload})
    if "selective_security" in families:
        deep = families["selective_security"].filter("acquisition_mode = 'historically_available'")
        along = Window.partitionBy("token_id", "family").orderBy("received_at", "id")
        deep = deep.withColumn("count", F.row_number().over(along).cast("long"))
        asked = candidates.select(*KEY).distinct().withColumn("family", F.explode(F.array(*[F.lit(k) for k in (*SNAPSHOTS, *EVENTS)])))
        found = asof_join(asked, deep, ["token_id", "family"], "decision_at", "received_at", ["id", "values", "count", "received_at"], tie="id", prefix="d_")
        of = lambda k, c: F.first(F.when(F.col("family") == k, F.col(f"d_{c}")), ignorenulls=True)
        wide = [of(k, c).alias(f"{k}_{c}") for k in SNAPSHOTS for c in ("id", "values")]
        wide += [F.coalesce(of(k, "count"), F.lit(0)).alias(f"{k}_count") for k in EVENTS] + [of(k, "id").alias(f"{k}_id") for k in EVENTS]
        out = out.join(found.groupBy(*KEY).agg(*wide, F.max("d_received_at").alias("deep_received_at")), KEY)
    else:
        out = out.withColumn("deep_received_at", F.lit(None).cast(at))
    known = ["discovery_received_at", "obs_received_at", "lifecycle_decided_at", "candidate_candidate_at", "tier_decided_at"]
    seen = F.greatest(*[F.col(c).cast(at) for c in (*known, "pair_received_at", "boost_received_at", "metadata_received_at", "security_received_at",
        "context_received_at", "deep_received_at")])
    return out.withColumns({"identity_known": F.coalesce(*[F.col(c).cast(at) for c in known]).isNotNull(), "availability_watermark": seen})


def _elapsed(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / MICROS


def market_features(candidates: DataFrame, families: Mapping[str, DataFrame], returns: Callable[[str, str], Column] = change) -> DataFrame:
    """The feature row of each candidate. returns: what return_<span> is of a price and the one before; by default null over a price that is not positive."""
    state = state_as_of(candidates, families)
    obs = doubles(families["observations"]).withColumnRenamed("pair_id", "selected_pair_id")
    spans = LOOKBACK | {"prior": (120, 30)}
    fields = ["price_usd", "liquidity_usd", "market_cap_usd", "volume_m5_usd", "buys_m5", "sells_m5", "received_at"]
    probes = state.filter("selected_pair_id IS NOT NULL").select("token_id", "selected_pair_id", "decision_at")
    back = lookbacks(probes, obs, ["token_id", "selected_pair_id"], ["decision_at"], "decision_at", "received_at", fields, spans, tie="id")
    s = state.join(back.drop("selected_pair_id"), KEY, "left")
    path = path_join(probes, obs.select("token_id", "selected_pair_id", "received_at", "id", "price_usd").filter("price_usd > 0"),
        ["token_id", "selected_pair_id"], "decision_at", "received_at", -300, 0, closed_start=True)
    prices = F.transform(F.array_sort(F.collect_list(F.struct("received_at", "id", "price_usd"))), lambda x: x["price_usd"])
    s = s.join(path.groupBy(*KEY).agg(prices.alias("_prices")), KEY, "left").withColumn("_prices", F.coalesce("_prices", F.array().cast("array<double>")))
    n = F.size("_prices")
    logs = F.when(n > 1, F.zip_with(F.slice("_prices", 2, n), F.slice(F.col("_prices"), F.lit(1), n - 1), lambda b,
        a: F.log(b / a))).otherwise(F.array().cast("array<double>"))
    s = s.withColumn("_r", logs)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    k, mean = F.size("_r"), F.try_divide(total(F.col("_r")), F.size("_r"))
    spread = F.sqrt(F.try_divide(F.aggregate("_r", F.lit(0.0), lambda x, y: x + y * y), k) - mean * mean)
    rms = F.sqrt(F.try_divide(F.aggregate("_r", F.lit(0.0), lambda x, y: x + y * y), k))
    signs = F.filter(F.transform("_r", lambda x: F.signum(x)), lambda x: x != 0)
    last = F.try_element_at("_prices", F.lit(-1))

    def run(sign: int) -> Column:
        return F.aggregate("_r", F.lit(0), lambda x, y: F.when(F.signum(y) == sign, x + 1).otherwise(F.lit(0)))

    age = _elapsed(F.col("received_at_1m"), F.col("obs_received_at"))
    prior_age = _elapsed(F.col("received_at_prior"), F.col("received_at_1m"))
    velocity = F.when(age > 0, change("obs_price_usd", "price_usd_1m") / age)
    prior_velocity = F.when(prior_age > 0, change("price_usd_1m", "price_usd_prior") / prior_age)
    out: dict[str, Column] = {
        **{c: F.col(c) for c in IDENTITY}, "identity_known": F.col("identity_known"), "availability_watermark": F.col("availability_watermark"),
        "admission_at": F.col("admission_at"), "token_age_seconds": _elapsed(F.col("admission_at"), F.col("decision_at")),
        "lifecycle_state": F.col("lifecycle_new_state"), "coverage_class": F.col("coverage_class"),
        "selected_pair_id": F.col("selected_pair_id"), "observation_received_at": F.col("obs_received_at"),
        "observation_age_seconds": _elapsed(F.col("obs_received_at"), F.col("decision_at")),
        "fdv_usd": F.col("obs_fully_diluted_valuation_usd"), **{c: F.col(f"obs_{c}") for c in MARKET if c != "fully_diluted_valuation_usd"},
        "liquidity_market_cap_ratio": ratio("obs_liquidity_usd", "obs_market_cap_usd"),
        "volume_m5_liquidity_ratio": ratio("obs_volume_m5_usd", "obs_liquidity_usd"),
        "liquidity_volume_m5_ratio": ratio("obs_liquidity_usd", "obs_volume_m5_usd"),
    }
    for h in LOOKBACK:
        out[f"return_{h}"] = returns("obs_price_usd", f"price_usd_{h}")
        out[f"return_{h}_actual_seconds"] = _elapsed(F.col(f"received_at_{h}"), F.col("obs_received_at"))
        out[f"liquidity_change_{h}"] = change("obs_liquidity_usd", f"liquidity_usd_{h}")
    out |= {"return_velocity_1m_per_second": velocity, "return_acceleration_1m": velocity - prior_velocity}
    for c, name in (("market_cap_usd", "market_cap"), ("volume_m5_usd", "volume_m5"), ("liquidity_usd", "liquidity")):
        now, before = slope(f"obs_{c}", f"{c}_1m", age), slope(f"{c}_1m", f"{c}_prior", prior_age)
        out |= {f"{name}_velocity_1m": now, f"{name}_acceleration_1m": now - before}
    for f in FLOWS:
        b, sl = f"obs_buys_{f}", f"obs_sells_{f}"
        out |= {f"buys_{f}": F.col(b), f"sells_{f}": F.col(sl), f"buy_ratio_{f}": buy_ratio(b, sl), f"buy_sell_imbalance_{f}": imbalance(b, sl)}
    known = lambda c: F.col(c).isNotNull()
    authority = lambda c: F.when(~known("security_received_at") | (F.col("security_status") != "available"), "unknown").when(known(c),
        "present").otherwise("none")
    out |= {
        "buy_sell_imbalance_m5_change_1m": imbalance("obs_buys_m5", "obs_sells_m5") - imbalance("buys_m5_1m", "sells_m5_1m"),
        "transactions_m5": F.col("obs_buys_m5") + F.col("obs_sells_m5"),
        "transaction_acceleration_1m": F.col("obs_buys_m5") + F.col("obs_sells_m5") - F.col("buys_m5_1m") - F.col("sells_m5_1m"),
        "path_observation_count_5m": n, "realized_volatility_5m": F.when(k >= 2, F.coalesce(F.nanvl(spread, F.lit(0.0)), F.lit(0.0))),
        "drawdown_from_local_peak_5m": F.try_divide(last, F.array_max("_prices")) - 1,
        "recovery_from_local_low_5m": F.try_divide(last, F.array_min("_prices")) - 1, "consecutive_positive_observations": run(1),
        "consecutive_negative_observations": run(-1),
        "path_monotonicity_5m": F.when(F.size(signs) > 0, F.abs(total(signs)) / F.size(signs)),
        "path_smoothness_5m": F.when(rms > 0, F.aggregate("_r", F.lit(0.0), lambda x, y: x + F.abs(y)) / k / rms),
        "abrupt_liquidity_decline_1m": change("obs_liquidity_usd", "liquidity_usd_1m") < -0.5,
        "boost_known": known("boost_received_at"), "boost_active": F.col("boost_active_boost_count") > 0,
        "boost_active_count": F.col("boost_active_boost_count"), "boost_amount": F.col("boost_amount"), "boost_total_amount": F.col("boost_total_amount"),
        "boost_freshness_seconds": _elapsed(F.col("boost_received_at"), F.col("decision_at")),
        "time_since_first_boost_seconds": _elapsed(F.col("boost_first_received_at"), F.col("decision_at")),
        "boost_amount_change": F.col("boost_amount") - F.col("boost_previous_amount"),
        "boost_total_amount_change": F.col("boost_total_amount") - F.col("boost_previous_total_amount"),
        "security_known": known("security_received_at"), "security_status": F.coalesce("security_status", F.lit("unknown")),
        "security_snapshot_freshness_seconds": _elapsed(F.col("security_received_at"), F.col("decision_at")),
        "token_program": F.when(known("security_received_at"), F.col("security_token_program")).otherwise("unknown"),
        "mint_authority_state": authority("security_mint_authority"), "freeze_authority_state": authority("security_freeze_authority"),
        "context_known": known("context_received_at"), "context_freshness_seconds": _elapsed(F.col("context_received_at"), F.col("decision_at")),
        "sol_usd_price": F.col("context_sol_usd_price").cast("double"),
        "tracked_admission_rate_per_minute": F.col("context_admitted_tokens") / F.greatest(_elapsed(F.col("context_bucket_start"),
        F.col("context_bucket_end")), F.lit(1.0)) * 60, "metadata_known": known("metadata_received_at"),
        "sol_return_5m": F.col("context_sol_return_5m"), "sol_realized_volatility_1h": F.col("context_sol_realized_volatility_1h"),
        "recent_active_conversion_fraction": F.col("context_mature_cohort_active_fraction"),
        "aggregate_tracked_volume_m5_usd": F.col("context_aggregate_volume_m5_usd"),
        "aggregate_tracked_buy_ratio_m5": buy_ratio("context_aggregate_buys_m5", "context_aggregate_sells_m5"),
        "pair_created_at_known": known("pair_created_at"),
    }
    return s.select(*KEY, *[c.alias(name) for name, c in out.items()])


def outcome_labels(candidates: DataFrame, families: Mapping[str, DataFrame], horizons: Mapping[str, tuple[int, int]] = HORIZONS, dense: bool | None = None,
    zeros: bool = False) -> DataFrame:
    """The outcome row of each candidate, from observations of its selected pair behind the decision.

    Thresholds are compared in doubles. dense: whether spans are put together of the nodes of a tree or of single facts; by default it is measured.
    zeros: prices of 0 cross bounds like others, those of an entry of 0 too; by default an entry of 0 has no crossings, and crossed_<name> looks at no price of 0."""
    obs = doubles(families["observations"]).withColumnRenamed("pair_id", "selected_pair_id")
    picked = selected_pairs(candidates.select(*KEY).distinct(), doubles(families["observations"]))
    entry = asof_join(picked, obs, ["token_id", "selected_pair_id"], "decision_at", "received_at", ["received_at", "price_usd", "liquidity_usd"],
        tie="id", prefix="e_")
    longest = max(h + t for h, t in horizons.values())
    facts = obs.select("token_id", "selected_pair_id", F.col("received_at").alias("at"), F.col("id").alias("fact"), F.col("price_usd").alias("p"),
        F.col("liquidity_usd").alias("l"))
    by, base = ["token_id", "selected_pair_id"], F.col("e_price_usd")
    limits = sorted({h + t for h, t in horizons.values()})
    asked = entry.filter("selected_pair_id IS NOT NULL")
    dense = fullest_span(facts, by, "at", longest) > DENSE if dense is None else dense
    told = facts.filter("at IS NOT NULL").withColumn("at", micros("at"))
    asked = asked.withColumn("_t0", micros("decision_at"))
    ms = sorted({*UPSIDE.values(), *DOWNSIDE.values(), *(m for up_down in ORDERED.values() for m in up_down), *TIMES.values()})
    tag = lambda m: f"c{str(m).replace('.', '_')}"
    allowed_base = base.isNotNull() if zeros else base > 0
    cross = {m: (pathtree.crosses(base * m, F.lit(m > 1)) & allowed_base, pathtree.crosses(base * m, F.lit(m > 1), nonzero=not zeros) & allowed_base) for m in ms}
    if dense:
        # Each span from what the blocks at its ends and those between have.
        bounds = [(n, h * MICROS, (h + t) * MICROS) for n, (h, t) in horizons.items()]
        width = gcd(*(x for _, h, end in bounds for x in (h, end)))
        nodes = durable(pathtree.build(told, by, width), "path-nodes")
        last = max(range(len(bounds)), key=lambda k: bounds[k][1])
        spans = [(1, end // width - 1) for _, _, end in bounds] + [(h // width + 1, end // width - 1) for _, h, end in bounds]
        blocks = asked.select(*by, F.floor(F.col("_t0") / width).alias("block"))
        between = durable(pathtree.between(blocks, nodes, by, spans, last), "path-between")
        narrow = asked.select(*by, "_t0", "decision_at", micros("e_received_at").alias("since"), "e_price_usd", "e_liquidity_usd")
        cut = pathtree.pieces(narrow, told, by, "_t0", [end for _, _, end in bounds], [h for _, h, _ in bounds], width).join(between.drop("cover"), [*by, "block"], "left")
        piece, sums = (lambda i: F.col("pieces")[i]["x"]), (lambda i: F.try_element_at("sums", F.lit(i)))
        each = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(horizons[n][0]).alias("h"), F.lit(h).alias("begin"), F.lit(end).alias("until"), piece(0).alias("s"), sums(k).alias("b"), piece(1 + k).alias("p"),
            F.coalesce(piece(1 + len(bounds) + k)["first"], sums(len(bounds) + k)["first"], piece(1 + k)["first"]).alias("end")) for k, (n, h, end) in enumerate(bounds)])
        agg = cut.select("token_id", "_t0", "e.*", F.explode(each).alias("x")).select("token_id", "decision_at", "_t0", "since", "e_price_usd", "e_liquidity_usd", "x.*")
        x = pathtree.joined(F.col("s"), F.col("b"), F.col("p"), F.col("since"))
        after = F.col("end.at") - F.col("_t0")
        end = F.struct(F.timestamp_micros("end.at").cast("timestamp_ntz").alias("at"), F.col("end.fact").alias("fact"), (after / MICROS).alias("s"), F.col("end.p").alias("p"), F.col("end.l").alias("l"))
        agg = agg.select(*KEY, "name", "h", "e_price_usd", "e_liquidity_usd", F.when((after >= F.col("begin")) & (after <= F.col("until")), end).alias("end"), (x["gap"] / MICROS).alias("gap"),
            ((x["peak"]["at"] - F.col("_t0")) / MICROS).alias("peak_s"), *[x[c].alias(c) for c in ("high", "low", "low_nonzero", "thin", "jump", "last")])
        agg = agg.withColumns({f"n{tag(m)}": c for m, (_, c) in cross.items()})
    else:
        # Thin facts: each candidate meets those of its longest span.
        named = path_join(asked.withColumn("_at0", F.timestamp_micros("_t0")), facts, by, "_at0", "at", 0, longest).drop("_at0").withColumn("at", micros("at"))
        items = pathtree.as_items(named, [*asked.columns])
        items = pathtree.with_neighbours(items, KEY, micros("e_received_at")).withColumn("s", (F.col("first.at") - F.col("_t0")) / MICROS)
        # An item is summed up once, in the ring between two limits that it falls in; what a horizon sees is the sum of its rings, of which there are as many as horizons.
        ring = F.size(F.filter(F.array(*map(F.lit, limits)), lambda x: x < F.col("s")))
        fact = F.struct(F.timestamp_micros("first.at").cast("timestamp_ntz").alias("at"), "first.fact", "s", "first.p", "first.l")
        ends = {n: F.min(F.when((F.col("s") >= h) & (F.col("s") <= h + t), fact)) for n, (h, t) in horizons.items()}
        where = F.struct("s")
        rings = items.withColumn("ring", ring).groupBy(*KEY, "ring").agg(
            F.struct(*[e.alias(n) for n, e in ends.items()]).alias("ends"), (F.max("gap") / MICROS).alias("gap"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.min("thin").alias("thin"), F.max("jump").alias("jump"), F.max(F.struct("last.at", "last.fact", "last.l")).alias("last"),
            F.min(F.when(F.col("peak").isNotNull(), F.struct("peak.down", ((F.col("peak.at") - F.col("_t0")) / MICROS).alias("s"), "peak.fact"))).alias("peak"),
            *[F.min(F.when(c, where)).alias(tag(m)) for m, (c, _) in cross.items()], *[F.max(c).alias(f"n{tag(m)}") for m, (_, c) in cross.items()],
        )
        seen = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(h).alias("h"), F.lit(limits.index(h + t)).alias("ring"), F.col(f"ends.{n}").alias("end")) for n, (h, t) in horizons.items()])
        each = rings.withColumn("x", F.explode(F.filter(seen, lambda x: F.col("ring") <= x["ring"])))
        agg = each.groupBy(*KEY, F.col("x.name").alias("name"), F.col("x.h").alias("h")).agg(
            F.min("x.end").alias("end"), F.max("gap").alias("gap"), F.max("high").alias("high"), F.min("low").alias("low"), F.min("thin").alias("thin"),
            F.max("jump").alias("jump"), F.max("last").alias("last"), F.min("peak").getField("s").alias("peak_s"),
            *[F.min(tag(m)).alias(tag(m)) for m in ms], *[F.max(f"n{tag(m)}").alias(f"n{tag(m)}") for m in ms],
        )
        agg = agg.join(entry.select(*KEY, "e_price_usd", "e_liquidity_usd"), KEY)
    allowed = F.least(F.greatest(F.lit(60.0), F.col("h") * 0.1), F.lit(1800.0))
    agg = agg.withColumn("complete", F.col("end").isNotNull() & (F.col("gap") <= allowed))
    entry_liquid = F.col("e_liquidity_usd") > 0
    done = F.col("complete")
    per = {
        "horizon_{}_available": F.col("end").isNotNull(), "horizon_{}_path_complete": done, "horizon_{}_actual_seconds": F.col("end.s"),
        "theoretical_market_return_{}": change("end.p", "e_price_usd"), "exit_liquidity_usd_{}": F.col("end.l"),
        **{f"exit_notional_{k}_liquidity_ratio_{{}}": F.when(F.col("end.l") > 0, k / F.col("end.l")) for k in NOTIONALS},
        "maximum_favorable_excursion_{}": F.when(done, change("high", "e_price_usd")),
        "maximum_adverse_excursion_{}": F.when(done, change("low", "e_price_usd")),
        **{f"crossed_{n}_{{}}": tri_state(F.col(f"n{tag(m)}"), done) for n, m in (UPSIDE | DOWNSIDE).items()},
        "minimum_future_liquidity_usd_{}": F.when(done, F.col("thin")),
        "major_liquidity_collapse_{}": tri_state(entry_liquid & (F.col("thin") <= F.col("e_liquidity_usd") * 0.2), done),
        "liquidity_survival_{}": tri_state(entry_liquid & (F.col("last.l") >= F.col("e_liquidity_usd") * 0.5), done),
        "maximum_observed_price_discontinuity_{}": F.when(done, F.col("jump")), "extreme_gap_or_rug_proxy_{}": tri_state(F.col("jump") >= 0.95, done),
    }
    if "lifecycle" in families:
        known = families["lifecycle"].filter("input_watermark <= decided_at")
        states = asof_join(agg.filter("end IS NOT NULL").select(*KEY, "name", F.col("end.at").alias("end_at")), known, ["token_id"], "end_at",
            "decided_at", ["new_state"], tie="id", prefix="end_")
        agg = agg.join(states.drop("end_at"), [*KEY, "name"], "left")
        per["future_lifecycle_state_{}"] = F.col("end_new_state")
    firsts = [] if dense else [tag(m) for m in ms]
    named = agg.select(*KEY, "name", "h", *firsts, "complete", "peak_s",
        F.struct(*[c.alias(k.format("h")) for k, c in per.items()]).alias("v"))
    wide = named.groupBy(*KEY).agg(
        F.max_by(F.struct("complete", "peak_s", *firsts), "h").alias("far"),
        *[F.max(F.when(F.col("name") == n, F.col("v"))).alias(f"_{n}") for n in horizons],
    )
    out = entry.join(wide, KEY, "left")
    far = lambda m: F.col(f"far.{tag(m)}.s")
    if dense:
        times = sorted({*(m for up_down in ORDERED.values() for m in up_down), *TIMES.values(), 0.2})
        first = pathtree.first_crossings(asked, between, nodes, told, by, "_t0", F.when(allowed_base, base), bounds[last][2], times, width)
        first = first.select("token_id", F.timestamp_micros("_t0").cast(dict(candidates.dtypes)["decision_at"]).alias("decision_at"),
            *[((F.col(f"x{k}") - F.col("_t0")) / MICROS).alias(f"x{tag(m)}") for k, m in enumerate(times)])
        out = out.join(first, KEY, "left")
        far = lambda m: F.col(f"x{tag(m)}")
    unseen = {"crossed": "UNKNOWN", "major_liquidity_collapse": "UNKNOWN", "liquidity_survival": "UNKNOWN", "extreme_gap": "UNKNOWN", "horizon": False}

    def column(template: str, n: str) -> Column:
        c = F.col(f"_{n}.{template.format('h')}")
        for start, value in unseen.items():
            if template.startswith(start) and "actual" not in template:
                c = F.coalesce(c, F.lit(value))
        return c.alias(template.format(n))

    far_done = F.coalesce(F.col("far.complete"), F.lit(False))
    ordered = {n: F.when(far(u).isNotNull(),
        F.when(far(d).isNull() | (far(u) < far(d)), "TRUE").otherwise("FALSE")).when(far(d).isNotNull() | far_done,
        "FALSE").otherwise("UNKNOWN") for n, (u, d) in ORDERED.items()}
    return out.select(
        *KEY, F.col("e_price_usd").alias("theoretical_entry_price_usd"), F.col("e_liquidity_usd").alias("entry_liquidity_usd"),
        F.lit(None).cast("double").alias("execution_adjusted_return"),
        *[F.when(F.col("e_liquidity_usd") > 0, k / F.col("e_liquidity_usd")).alias(f"entry_notional_{k}_liquidity_ratio") for k in NOTIONALS],
        *[column(t, n) for n in horizons for t in per], *[c.alias(n) for n, c in ordered.items()], *[far(m).alias(n) for n, m in TIMES.items()],
        F.when(far_done, F.col("far.peak_s")).alias("time_to_peak_seconds"), far(0.2).alias("time_to_collapse_seconds"),
    )


def build(candidates: DataFrame, families: Mapping[str, DataFrame], split: Column | None = None, allow_invalid_epoch: bool = False) -> DataFrame:
    """Features, labels and split of each candidate. Fails on facts that break their time contract and, unless allowed, on
    tokens of invalid epochs; candidates outside all splits are dropped."""
    check_facts(families)
    if not allow_invalid_epoch:
        check_epochs(candidates, families)
    rows = market_features(candidates, families).join(outcome_labels(candidates, families), KEY)
    return rows if split is None else rows.withColumn("split", split).filter("split IS NOT NULL")


def publish(rows: DataFrame, path: str, identity: Mapping[str, object]) -> dict:
    """Write a dataset under the digest of its identity; one that is there already is left as it is.

    The content digest is a sum of row digests, the same for any order and partitioning."""
    import hashlib

    from tidemark.sources.archive import read_text, write_text

    spark = rows.sparkSession
    name = hashlib.sha256(json.dumps(identity, sort_keys=True, default=str).encode()).hexdigest()[:32]
    root = f"{path.rstrip('/')}/dataset={name}"
    try:
        return json.loads(read_text(spark, f"{root}/manifest.json"))
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/rows")
    manifest = {"identity": dict(identity), "path": root, **content(spark.read.parquet(f"{root}/rows"))}
    write_text(spark, f"{root}/manifest.json", json.dumps(manifest, sort_keys=True, default=str))
    return manifest


def content(rows: DataFrame) -> dict:
    digest = F.conv(F.substring(row_digest(*rows.columns), 1, 12), 16, 10).cast("decimal(38,0)")
    r = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("digest"), F.count_distinct(*KEY).alias("keys")).first()
    if r["rows"] != r["keys"]:
        raise ValueError("a candidate is there twice")
    return {"rows": r["rows"], "digest": str(r["digest"]), "columns": len(rows.columns)}


def verify(spark, manifest: Mapping[str, object]) -> bool:
    found = content(spark.read.parquet(f"{manifest['path']}/rows"))
    return all(manifest[k] == v for k, v in found.items())


def quality_report(rows: DataFrame) -> DataFrame:
    """name, measure and value: null rates of all columns and the distribution of the tri-state labels, in one pass."""
    measures = [F.count_if(F.col(c).isNull()).alias(f"nulls:{c}") for c in rows.columns]
    tri = [c for c in rows.columns if c.startswith(("crossed_", "major_", "liquidity_survival", "extreme_", *ORDERED))]
    measures += [F.count_if(F.col(c) == v).alias(f"{v}:{c}") for c in tri for v in ("TRUE", "FALSE", "UNKNOWN")]
    one = rows.agg(F.count(F.lit(1)).alias("n"), *measures)
    pairs = F.array(*[F.struct(F.lit(m).alias("k"), F.col(f"`{m}`").alias("v")) for m in one.columns if m != "n"])
    long = one.select("n", F.explode(pairs).alias("x"))
    return long.select(F.split_part("x.k", F.lit(":"), F.lit(2)).alias("name"), F.split_part("x.k", F.lit(":"), F.lit(1)).alias("measure"),
        F.round(ratio("x.v", "n"), 6).alias("value"))


def distributions(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """name, n, minimum, p50, p99 and maximum of numeric columns (by default all), nulls and NaN left out; percentiles by the lower index. Columns without a value have no row.

    All columns are counted by value in one pass and their ranks selected together."""
    numeric = [f.name for f in rows.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]
    wide = rows.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in (columns or numeric)])
    long = wide.unpivot([], wide.columns, "name", "value").filter("value IS NOT NULL AND NOT isnan(value)")
    counts = value_counts(long, ["name"], "value")
    ends = counts.groupBy("name").agg(F.sum("_n").alias("n"), F.min("_v").alias("minimum"), F.max("_v").alias("maximum"))
    return ends.join(quantiles(counts, ["name"], {"p50": ("lower", 0.5), "p99": ("lower", 0.99)}), "name").select("name", "n", "minimum", "p50", "p99", "maximum")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
