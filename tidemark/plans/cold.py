"""Questions to an archive, over its families as open_verified hands them out, for all tokens at once.

Families: tokens (id, address, first_discovered_at), pairs (id, token_id), observations (id, pair_id, received_at, measures),
lifecycle (id, token_id, decided_at, new_state), boosts, security (id, token_id, received_at, values), context (id, received_at, values).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import ratio
from tidemark.operators.asof import asof_join
from tidemark.sources.tables import time_range

#: The line of the context is common to all tokens; it is sorted in chunks of so many seconds.
CONTEXT_SPLIT = 3600
_PAYLOAD = {"boosts": ("amount", "total_amount", "active_boost_count"),
    "security": ("status", "mint_authority", "freeze_authority", "raw_supply", "token_program")}
_CONTEXT = ("id", "bucket_start", "bucket_end", "sol_usd_price", "sol_return_5m", "sol_realized_volatility_1h")


def observed(families: Mapping[str, DataFrame], start: str | None = None, end: str | None = None) -> DataFrame:
    """Observations of [start, end) with token_id and address; a bound reaches the files."""
    pairs = families["pairs"].select(F.col("id").alias("pair_id"), "token_id")
    tokens = families["tokens"].select(F.col("id").alias("token_id"), "address")
    return time_range(families["observations"], "received_at", start, end).join(pairs, "pair_id").join(tokens, "token_id")


def chronology(families: Mapping[str, DataFrame]) -> DataFrame:
    """Every change of state with the address and its place in the token's history."""
    from pyspark.sql import Window

    w = Window.partitionBy("token_id").orderBy("decided_at", "id")
    tokens = families["tokens"].select(F.col("id").alias("token_id"), "address")
    return families["lifecycle"].withColumns({"step": F.row_number().over(w), "previous_state": F.lag("new_state").over(w)}).join(tokens, "token_id")


def first_and_peak(families: Mapping[str, DataFrame], measure: str) -> DataFrame:
    """Of each token the measure when it was first seen, and its highest."""
    return observed(families).groupBy("address").agg(F.min_by(measure, F.struct("received_at", "id")).alias("first"), F.max(measure).alias("peak"))


def enrichment_as_of(families: Mapping[str, DataFrame], probes: DataFrame) -> DataFrame:
    """probes (token_id, as_of) with the latest boost, security snapshot and market context known then; a family that the archive lacks gives nulls."""
    out = probes.select("token_id", "as_of")
    for name, payload in _PAYLOAD.items():
        if name not in families:
            out = out.withColumns({f"{name}_{c}": F.lit(None) for c in (*payload, "received_at")})
            continue
        have = [c for c in payload if c in families[name].columns]
        out = asof_join(out, families[name], ["token_id"], "as_of", "received_at", [*have, "received_at"], tie="id", prefix=f"{name}_")
    if "context" in families:
        have = [c for c in _CONTEXT if c in families["context"].columns]
        line = families["context"].withColumn("_all", F.lit(0))
        return asof_join(out.withColumn("_all", F.lit(0)), line, ["_all"], "as_of", "received_at", [*have, "received_at"], tie="id",
            prefix="context_", split_seconds=CONTEXT_SPLIT).drop("_all")
    return out.withColumns({f"context_{c}": F.lit(None) for c in (*_CONTEXT, "received_at")})


def overview(families: Mapping[str, DataFrame], start: str, end: str) -> DataFrame:
    """measure and value: rows, tokens, joins and ratios that tell whether an archive is fit for research."""
    obs = families["observations"]
    inside = (F.col("received_at") >= F.lit(start).cast("timestamp_ntz")) & (F.col("received_at") < F.lit(end).cast("timestamp_ntz"))
    bought = F.avg(F.when(F.col("sells_m5") > 0, ratio("buys_m5", "sells_m5")))
    parts = [
        obs.agg(F.count(F.lit(1)).cast("double").alias("observations"), F.count_if(inside).cast("double").alias("observations_in_window"),
        bought.alias("buy_sell_ratio")),
        observed(families).agg(F.count(F.lit(1)).cast("double").alias("joined_rows"), F.count_distinct("token_id").cast("double").alias("unique_tokens")),
        families["lifecycle"].agg(F.count(F.lit(1)).cast("double").alias("lifecycle_rows")),
    ]
    long = [p.unpivot([], p.columns, "measure", "value") for p in parts]
    return long[0].unionByName(long[1]).unionByName(long[2])
