"""Summary of a collection window: section, name, measure and value, a row for each figure.

Every section is one aggregation of its own family, unpivoted; nothing is joined that would multiply
facts. A section whose family is not given is left out.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import ratio, seconds_between
from tidemark.operators.stats import interpolated

PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
CAPACITY = ("requested_observations_per_minute", "available_observations_per_minute", "adapted_observations_per_minute",
    "adapted_requests_per_minute", "degraded_schedule_pct")


def of_epoch(families: Mapping[str, DataFrame], runs: DataFrame, epoch: str) -> dict[str, DataFrame]:
    """The families with only the facts of the runs (run_id, epoch_id) of an epoch; those without a run_id stay whole."""
    mine = runs.filter(F.col("epoch_id") == epoch).select("run_id")
    return {n: f.join(mine, "run_id", "left_semi") if "run_id" in f.columns else f for n, f in families.items()}


def _figures(section: str, df: DataFrame) -> DataFrame:
    """Rows of one aggregation as figures; a column `name` tells the groups apart where there are any."""
    measures = [c for c in df.columns if c != "name"]
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]))
    label = F.coalesce(F.col("name").cast("string"), F.lit("unknown")) if "name" in df.columns else F.lit("all")
    return df.select(F.lit(section).alias("section"), label.alias("name"), each.alias("x")).select("section", "name", "x.*")


def _percentiles(value: Column | str, unit: str) -> list[Column]:
    return [interpolated(value, p).alias(f"{n}_{unit}") for n, p in PERCENTILES.items()]


def requests(df: DataFrame) -> list[DataFrame]:
    """requested_at, received_at, status, outcome, attempts."""
    status = F.col("status")
    ms = F.when(F.col("received_at").isNotNull(), seconds_between("requested_at", "received_at") * 1000)
    whole = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(status == 200).alias("http_200"), F.count_if(status == 429).alias("http_429"),
        F.count_if(status.between(400, 499) & (status != 429)).alias("http_other_4xx"),
        F.count_if(status >= 500).alias("http_5xx"), F.sum(F.greatest(F.coalesce("attempts", F.lit(1)) - 1, F.lit(0))).alias("retries"),
        *_percentiles(ms, "latency_ms"),
    )
    busiest = df.groupBy(F.date_trunc("minute", "requested_at").alias("minute")).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"),
        F.lit(0)).alias("peak_per_minute"))
    return [_figures("requests", whole), _figures("requests", busiest),
        _figures("request_outcomes", df.groupBy(F.col("outcome").alias("name")).agg(F.count(F.lit(1)).alias("requests")))]


def lifecycle(df: DataFrame) -> list[DataFrame]:
    """id, token_id, decided_at, previous_state, new_state: how often each change came, and the median time in each state.

    The time is up to the token's next change in the window; a state it is still in has none yet."""
    changes = df.groupBy(F.concat_ws(">", F.coalesce("previous_state", F.lit("")), "new_state").alias("name")).agg(F.count(F.lit(1)).alias("changes"))
    stay = df.withColumn("s", seconds_between("decided_at",
        F.lead("decided_at").over(Window.partitionBy("token_id").orderBy("decided_at", "id")))).filter("s IS NOT NULL")
    return [_figures("lifecycle_changes", changes),
        _figures("lifecycle_residence", stay.groupBy(F.col("new_state").alias("name")).agg(interpolated("s", 0.5).alias("median_seconds")))]


def observations(df: DataFrame) -> list[DataFrame]:
    """token_id, pair_id: rows, tokens, rows of a token, tokens of several pairs. Pairs are counted before tokens, so that a hot token is many rows in no task."""
    pairs = df.groupBy("token_id", "pair_id").agg(F.count(F.lit(1)).alias("n"))
    tokens = pairs.groupBy("token_id").agg(F.sum("n").alias("n"), F.count("pair_id").alias("pairs"))
    return [_figures("observations", tokens.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("tokens"), interpolated("n", 0.5).alias("per_token_p50"),
        interpolated("n", 0.95).alias("per_token_p95"), F.count_if(F.col("pairs") > 1).alias("multi_pair_tokens")
    ))]


def lateness(df: DataFrame) -> list[DataFrame]:
    """Claims: lifecycle_state, claim_lateness_ms, target_interval_seconds, effective_interval_seconds."""
    late = F.col("effective_interval_seconds") > F.col("target_interval_seconds")
    return [_figures("claims", df.groupBy(F.col("lifecycle_state").alias("name")).agg(
        F.count(F.lit(1)).alias("claims"), *_percentiles("claim_lateness_ms", "ms"), F.max("claim_lateness_ms").alias("max_ms"),
        F.avg("target_interval_seconds").alias("target_interval_seconds"),
        F.avg("effective_interval_seconds").alias("effective_interval_seconds"), (ratio(F.count_if(late), F.count(F.lit(1))) * 100).alias("degraded_pct"),
    ))]


def capacity(df: DataFrame) -> list[DataFrame]:
    return [_figures("capacity", df.groupBy(F.col("capacity_mode").alias("name")).agg(F.count(F.lit(1)).alias("samples"),
        *[F.avg(c).alias(c) for c in CAPACITY if c in df.columns]))]


def connectivity(df: DataFrame, start: Column, end: Column) -> list[DataFrame]:
    """gap_id, event_type, observed_at: seconds without connection, within the window. A gap that is still open lasts to its end."""
    at = lambda kind, f: f(F.when(F.col("event_type") == kind, F.col("observed_at")))
    gaps = df.groupBy("gap_id").agg(at("disconnected", F.min).alias("down"), at("reconnected", F.max).alias("up")).filter("down IS NOT NULL")
    length = seconds_between(F.greatest("down", start), F.least(F.coalesce("up", end), end))
    return [_figures("connectivity", gaps.agg(F.count(F.lit(1)).alias("gaps"), F.coalesce(F.sum(length), F.lit(0.0)).alias("gap_seconds")))]


def storage(samples: DataFrame, relations: DataFrame | None) -> list[DataFrame]:
    """samples: sample_id, sampled_at, database_bytes. relations: sample_id, relation_family, total_bytes; growth by family between the
    window's first and last sample."""
    size = F.col("database_bytes")
    out = [_figures("storage", samples.agg(F.min(size).alias("first_bytes"), F.max(size).alias("last_bytes"),
        (F.max(size) - F.min(size)).alias("growth_bytes")))]
    if relations is not None:
        ends = samples.agg(F.min_by("sample_id", "sampled_at").alias("first"), F.max_by("sample_id", "sampled_at").alias("last"))  # one row
        signed = relations.join(F.broadcast(ends), F.col("sample_id").isin(F.col("first"), F.col("last")))
        change = F.when(F.col("first") == F.col("last"), 0).when(F.col("sample_id") == F.col("last"), F.col("total_bytes")).otherwise(-F.col("total_bytes"))
        out.append(_figures("storage_growth", signed.groupBy(F.col("relation_family").alias("name")).agg(F.sum(change).alias("growth_bytes"))))
    return out


def unclaimed(schedules: DataFrame, claims: DataFrame) -> list[DataFrame]:
    """Schedules (token_id) without a claim in the window."""
    return [_figures("schedules", schedules.join(claims.select("token_id").distinct(), "token_id", "left_anti").agg(F.count(F.lit(1)).alias("without_claim")))]


def summary(families: Mapping[str, DataFrame], end_at: str, hours: int = 24) -> DataFrame:
    """All sections whose families are given: requests, lifecycle, observations, batch_members (claims), schedules, capacity_decisions,
    connectivity, storage_samples, storage_relations, discoveries, runs. The window is [end - hours, end)."""
    end = F.lit(end_at).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {hours} HOUR")
    times = {"requests": "requested_at", "lifecycle": "decided_at", "observations": "received_at", "batch_members": "claimed_at",
        "capacity_decisions": "decided_at", "connectivity": "observed_at", "storage_samples": "sampled_at", "discoveries": "received_at"}
    f = {n: df.filter((F.col(times[n]) >= start) & (F.col(times[n]) < end)) if n in times else df for n, df in families.items()}
    sections = {
        "requests": requests, "lifecycle": lifecycle, "observations": observations, "batch_members": lateness, "capacity_decisions": capacity,
        "connectivity": lambda df: connectivity(df, start, end),
        "storage_samples": lambda df: storage(df, f.get("storage_relations")), "schedules": lambda df: unclaimed(df, f["batch_members"]),
        "discoveries": lambda df: [_figures("discoveries", df.agg(F.count_distinct("token_id").alias("tokens")))],
        "runs": lambda df: [_figures("runs",
        df.filter((F.col("collection_started_at") < end) & (F.coalesce("finished_at", end) >= start)).agg(F.count(F.lit(1)).alias("starts")))],
    }
    parts = [p for n, section in sections.items() if n in f for p in section(f[n])]
    return reduce(DataFrame.unionByName, parts)
