"""Hourly collection report and status, from fact families to one row for each hour of a window.

Every measure is aggregated by hour on its own and joined to a spine of hours, so hours without
facts are there with zeros, and no facts are multiplied by joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS, col, micros, ratio, seconds_between
from tidemark.operators.stats import interpolated, null_rate, quantiles, value_counts

OBSERVED = ("price_usd", "liquidity_usd", "market_cap_usd", "volume_m5_usd", "volume_h1_usd", "buys_m5", "sells_m5")


def check_hour(end_at: str) -> None:
    if not end_at.endswith(":00:00"):
        raise ValueError("a report ends on a full hour")


def hour_spine(spark: SparkSession, end_at: str, hours: int = 24) -> DataFrame:
    stamp = f"timestamp_ntz'{end_at}'"
    return spark.sql(f"SELECT explode(sequence({stamp} - INTERVAL {hours} HOUR, {stamp} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour")


def hour_of(c: Column | str) -> Column:
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def _window(df: DataFrame, at: str, end_at: str, hours: int) -> DataFrame:
    stamp = F.lit(end_at).cast("timestamp_ntz")
    return df.filter((F.col(at) >= stamp - F.expr(f"INTERVAL {hours} HOUR")) & (F.col(at) < stamp)).withColumn("hour", hour_of(at))


def pending_by_hour(events: DataFrame, spine: DataFrame, key: str, at: str, state: str, pending: str) -> DataFrame:
    """How many keys are in the pending state at the end of each hour.

    A key that enters adds one and one that leaves takes one off, summed by hour and then along the hours."""
    w = Window.partitionBy(key).orderBy(at, "id")
    now, before = (F.col(state) == pending).cast("int"), F.coalesce((F.lag(state).over(w) == pending).cast("int"), F.lit(0))
    steps = events.withColumn("d", now - before).filter("d <> 0").groupBy(hour_of(at).alias("hour")).agg(F.sum("d").alias("d"))
    line = steps.unionByName(spine.withColumn("d", F.lit(0).cast("long"))).groupBy("hour").agg(F.sum("d").alias("d"))
    total = F.sum("d").over(Window.orderBy("hour").rowsBetween(Window.unboundedPreceding, 0))  # a row for each hour
    return line.withColumn("pending", total).join(spine, "hour", "left_semi").select("hour", "pending")


def gaps_between(claims: DataFrame, key: str, at: str, end_at: str, hours: int) -> DataFrame:
    """Claims of the window with the seconds since the key's claim before, be it before the window."""
    inside = _window(claims, at, end_at, hours)
    start = F.lit(end_at).cast("timestamp_ntz") - F.expr(f"INTERVAL {hours} HOUR")
    earlier = claims.filter(F.col(at) < start).join(inside.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.max(at).alias(at))
    line = inside.select(key, at, "hour").unionByName(earlier.withColumn("hour", F.lit(None).cast("timestamp_ntz")))
    return line.withColumn("gap", seconds_between(F.lag(at).over(Window.partitionBy(key).orderBy(at)), at)).filter("hour IS NOT NULL AND gap IS NOT NULL")


def hourly_report(spark: SparkSession, families: Mapping[str, DataFrame], end_at: str, hours: int = 24) -> DataFrame:
    """One row for each hour: counts by family, request latencies and outcomes, null rates, batch occupancy, cadence, pending keys, duplicates."""
    check_hour(end_at)
    spine = hour_spine(spark, end_at, hours)
    inside = lambda name, at: _window(families[name], at, end_at, hours)
    latency = (F.when(F.col("received_at") >= F.col("requested_at"), seconds_between("requested_at", "received_at"))) * 1000
    requests = inside("requests", "requested_at").withColumn("ms", latency).groupBy("hour").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("status") == 429).alias("http_429s"), F.avg("ms").alias("latency_mean_ms"),
        interpolated("ms", 0.5).alias("latency_p50_ms"), interpolated("ms", 0.95).alias("latency_p95_ms")
    )
    observed = inside("observations", "received_at")
    have = [c for c in OBSERVED if c in observed.columns]
    seen = observed.groupBy("hour").agg(F.count(F.lit(1)).alias("observations"), *[null_rate(c).alias(f"null_rate_{c}") for c in have])
    states = inside("lifecycle", "decided_at").groupBy("hour").agg(F.count_if(F.col("new_state") == "NEW").alias("reaching_dex"),
        F.count_if(F.col("new_state") == "RESURRECTED").alias("resurrections"))
    found = inside("discoveries", "received_at").groupBy("hour").agg(F.count_distinct("token_id").alias("discovered"))
    repeats = inside("conflicts", "occurred_at").groupBy("hour").agg(F.count(F.lit(1)).alias("duplicates"))
    members = families["batch_members"].groupBy("batch_id").agg(F.count(F.lit(1)).alias("members"))
    batches = inside("batches", "claimed_at").join(members, "batch_id", "left")
    filled = batches.groupBy("hour").agg((ratio(F.sum(F.coalesce("members", F.lit(0))), F.sum("batch_size")) * 100).alias("occupancy_pct"))
    cadence = gaps_between(families["batch_members"], "token_id", "claimed_at", end_at,
        hours).groupBy("hour").agg(F.avg("gap").alias("mean_cadence_seconds"), F.max("gap").alias("longest_gap_seconds"))
    waiting = pending_by_hour(families["lifecycle"], spine, "token_id", "decided_at", "new_state", "PENDING_DEX")
    rows = reduce(lambda a, b: a.join(b, "hour", "left"), [requests, seen, states, found, repeats, filled, cadence, waiting], spine)
    counts = ["requests", "http_429s", "observations", "reaching_dex", "resurrections", "discovered", "duplicates", "pending"]
    written = F.col("observations") + F.col("discovered") + F.col("reaching_dex") + F.col("resurrections")
    return rows.fillna(0, counts).withColumn("duplicate_rate", F.round(ratio("duplicates", written + F.col("duplicates")), 6))


def write_report(rows: DataFrame, path: str) -> None:
    """The report as JSON and CSV, a file each; a report has one row for each hour."""
    one = rows.orderBy("hour").coalesce(1)
    one.write.mode("errorifexists").json(f"{path}/json")
    one.write.mode("errorifexists").option("header", True).csv(f"{path}/csv")


def markdown(rows: DataFrame, columns: Sequence[str]) -> str:
    lines = ["| " + " | ".join(columns) + " |", "|" + "-|" * len(columns)]
    for r in rows.orderBy("hour").select(*columns).collect():  # a row for each hour
        lines.append("| " + " | ".join("" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v) for v in r) + " |")
    return "\n".join(lines)


def storage_deltas(samples: DataFrame, by: str, at: str, rows: str, size: str) -> DataFrame:
    """Samples with rows a minute and bytes a row since the sample before."""
    w = Window.partitionBy(by).orderBy(at)
    more, bytes_, minutes = F.col(rows) - F.lag(rows).over(w), F.col(size) - F.lag(size).over(w), seconds_between(F.lag(at).over(w), at) / 60
    return samples.withColumns({"rows_per_minute": ratio(more, minutes), "bytes_per_row": F.when(more > 0, ratio(bytes_, more))})


def growth(first: int, last: int, seconds: float) -> dict[str, float | None]:
    """Bytes between two samples carried on to a day, 30, 90 and 365 days, in GiB."""
    day = (last - first) / seconds * 86400 / 2**30 if seconds > 0 else None
    return {f"gib_{d}d": None if day is None else day * d for d in (1, 30, 90, 365)}


def growth_columns(first: Column | str, last: Column | str, seconds: Column | str) -> dict[str, Column]:
    """The same for columns: null where no time passed."""
    day = F.when(col(seconds) > 0, (col(last) - col(first)) / col(seconds) * 86400 / float(2**30))
    return {f"gib_{d}d": day * d for d in (1, 30, 90, 365)}


def top_growth(samples: DataFrame, by: str, at: str, size: str, n: int = 10) -> DataFrame:
    """The n keys that grew most between their first and their last sample, then by key."""
    ends = samples.groupBy(by).agg((F.max_by(size, at) - F.min_by(size, at)).alias("growth"))
    return ends.filter("growth IS NOT NULL").orderBy(F.col("growth").desc(), by).limit(n)


def live_seconds(runs: DataFrame, epoch: str, end: str) -> DataFrame:
    """For each epoch the seconds in which some run was live, by the union of [live start, finish) of its runs.

    A run whose live start is not known makes its epoch unknown: null, not zero."""
    from tidemark.operators.windows import interval_union

    known = runs.groupBy(epoch).agg(F.bool_and(F.col("collection_started_at").isNotNull()).alias("ok"))
    spans = runs.filter("collection_started_at IS NOT NULL").select(epoch, micros("collection_started_at").alias("a"),
        micros(F.coalesce("finished_at", F.lit(end).cast("timestamp_ntz"))).alias("b"))
    merged = interval_union(spans, [epoch], "a",
        "b").groupBy(epoch).agg((F.sum(F.col("island_end") - F.col("island_start")) / MICROS).alias("live_seconds"), F.count(F.lit(1)).alias("intervals"))
    return known.join(merged, epoch, "left").select(epoch, F.when(F.col("ok"), F.col("live_seconds")).alias("live_seconds"),
        F.when(F.col("ok"), F.col("intervals")).alias("intervals"))


def component_status(heartbeats: DataFrame, now: str, stale_after: int) -> DataFrame:
    """component and status: STOPPED, FAILED, STALE or HEALTHY, from its latest heartbeat."""
    from tidemark.operators.windows import latest_per

    last = latest_per(heartbeats, ["component"], "at", "state")
    age = seconds_between("at", F.lit(now).cast("timestamp_ntz"))
    return last.select("component", F.when(F.col("state").isin("STOPPED", "FAILED"), F.col("state")).when(age > stale_after,
        "STALE").otherwise("HEALTHY").alias("status"), age.alias("age_seconds"))


#: What a family of stored facts says of itself, by its column: when, in which state and coverage class, whether it failed, until when it is due, and its figure (a lateness, a latency, a share).
STATUS_COLUMNS = {"at": "timestamp", "state": "string", "coverage_class": "string", "failed": "boolean", "due_at": "timestamp", "figure": "double"}


def status_facts(families: dict[str, DataFrame]) -> DataFrame:
    """All families under each other with the columns of STATUS_COLUMNS, null where a family has none, and its name."""
    out = None
    for name, df in families.items():
        one = df.select(F.lit(name).alias("family"), *[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in STATUS_COLUMNS.items()])
        out = one if out is None else out.unionByName(one)
    return out


def collector_figures(families: dict[str, DataFrame], now: str) -> DataFrame:
    """The figures of a collector as of now, a row for each family (level all), each of its states and each of its coverage classes.

    All grouped figures come from one pass over all families with grouping sets, summed up in each task before anything is shuffled; only the 95th
    percentile of a family is found apart, by counts of its values. Facts later than now or without a time are left out; a
    state or class that is null has a row of its own if the family has it anywhere. Columns: rows, last_minute, last_hour, failed_last_hour, overdue (due before now), most_overdue_seconds, mean_figure, largest_figure,
    p95_figure (level all), idle_seconds since the newest fact, rows_per_minute over the last hour."""
    t = F.lit(now).cast("timestamp")
    facts = status_facts(families).filter(F.col("at") <= t)
    late = F.when(F.col("due_at") < t, seconds_between("due_at", t))
    recent = lambda seconds: F.col("at") > t - F.expr(f"INTERVAL {seconds} SECOND")
    sets = [[F.col("family")], [F.col("family"), F.col("state")], [F.col("family"), F.col("coverage_class")]]
    grouped = facts.groupingSets(sets, "family", "state", "coverage_class").agg(
        F.grouping("state").alias("_no_state"), F.grouping("coverage_class").alias("_no_class"), F.count(F.lit(1)).alias("rows"),
        F.count_if(recent(60)).alias("last_minute"), F.count_if(recent(3600)).alias("last_hour"), F.count_if(recent(3600) & F.col("failed")).alias("failed_last_hour"),
        F.count(late).alias("overdue"), F.max(late).alias("most_overdue_seconds"), F.avg("figure").alias("mean_figure"), F.max("figure").alias("largest_figure"),
        seconds_between(F.max("at"), t).alias("idle_seconds"), (F.count_if(recent(3600)) / 60.0).alias("rows_per_minute"))
    level = F.when(F.col("_no_state") + F.col("_no_class") == 2, "all").when(F.col("_no_class") == 1, "state").otherwise("coverage_class")
    p95 = quantiles(value_counts(facts, ["family"], "figure"), ["family"], {"p95_figure": ("interpolated", 0.95)}).withColumn("level", F.lit("all"))
    has = {"state": [n for n, df in families.items() if "state" in df.columns], "coverage_class": [n for n, df in families.items() if "coverage_class" in df.columns]}
    told = grouped.withColumn("level", level).filter((F.col("level") == "all") | ((F.col("level") == "state") & F.col("family").isin(has["state"]))
        | ((F.col("level") == "coverage_class") & F.col("family").isin(has["coverage_class"])))
    return told.drop("_no_state", "_no_class").join(F.broadcast(p95), ["family", "level"], "left")  # a row a family
