"""Rule tables as column expressions, and folds of them over a key's history."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cuts import any_hot, hot_cuts, same, with_chunks
from tidemark.work import durable


@dataclass(frozen=True)
class LifecycleRule:
    """From one state to another when each measure is at least or at most a bound; a null measure meets no bound."""

    source: str
    target: str
    at_least: tuple[tuple[str, float], ...] = ()
    at_most: tuple[tuple[str, float], ...] = ()


# Default thresholds of the lifecycle, in the order in which they are tried.
LIFECYCLE = (
    LifecycleRule("NEW", "ACTIVE", at_least=(("volume_m5", 100.0),)),
    LifecycleRule("NEW", "WATCH", at_least=(("volume_m5", -math.inf), ("liquidity", 1000.0))),
    LifecycleRule("ACTIVE", "FADING", at_most=(("volume_m5", 25.0),)),
    LifecycleRule("WATCH", "FADING", at_most=(("volume_m5", 10.0),)),
    LifecycleRule("FADING", "DORMANT", at_most=(("volume_h1", 10.0), ("liquidity", 100.0))),
    LifecycleRule("DORMANT", "RESURRECTED", at_least=(("volume_m5", 100.0), ("liquidity", 500.0))),
)


def next_state(state: Column, measures: dict[str, Column], rules: tuple[LifecycleRule, ...] = LIFECYCLE) -> Column:
    """The state after one observation: the first rule that fires, else the state as it was."""
    out = None
    for r in rules:
        met = state == r.source
        for m, bound in r.at_least:
            met = met & measures[m].isNotNull() & ((measures[m] >= bound) if bound > -math.inf else F.lit(True))
        for m, bound in r.at_most:
            met = met & measures[m].isNotNull() & (measures[m] <= bound)
        out = F.when(met, r.target) if out is None else out.when(met, r.target)
    return out.otherwise(state)


def replay_lifecycle(observations: DataFrame, by: list[str], order: list[str], measures: dict[str, str], start: str = "NEW",
    chunk: Column | None = None) -> DataFrame:
    """State of each key after its whole history, and how often it changed.

    Each observation says, for every state, where it leads from there; those that lead nowhere are left out. What is left of a key
    is folded by chunks (of time, so that chunks follow each other; by
    default one for each day of the first order column), for all states that a chunk may start in at once, and a key's chunks are then chained. No row
    ever holds more than a chunk's observations or a key's chunks."""
    states = sorted({start, *(r.source for r in LIFECYCLE), *(r.target for r in LIFECYCLE)})
    values = {n: F.col(c).cast("double") for n, c in measures.items()}
    place = F.create_map(*[F.lit(x) for pair in zip(states, range(len(states)), strict=True) for x in pair])
    to = F.array(*[place[next_state(F.lit(s), values)] for s in states])
    moves = F.exists(F.zip_with("_to", F.sequence(F.lit(0), F.lit(len(states) - 1)), lambda a, b: a != b), lambda x: x)
    cut = chunk if chunk is not None else F.date_trunc("day", order[0])
    rows = observations.select(*by, cut.alias("_chunk"), *[c for c in order if c not in by], to.alias("_to"))
    packed = rows.groupBy(*by, "_chunk").agg(F.array_sort(F.collect_list(F.when(moves, F.struct(*order, "_to")))).alias("_h"))

    def step(acc: Column, x: Column) -> Column:
        changed = F.zip_with(acc["n"], acc["s"], lambda n, i: n + (x["_to"][i] != i).cast("long"))
        return F.struct(F.transform(acc["s"], lambda i: x["_to"][i]).alias("s"), changed.alias("n"))

    unmoved = F.struct(F.array(*[F.lit(i) for i in range(len(states))]).alias("s"), F.array(*[F.lit(0).cast("long") for _ in states]).alias("n"))
    led = packed.select(*by, "_chunk", F.aggregate("_h", unmoved, step).alias("_f"))
    chained = led.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_chunk", "_f"))).alias("_c"))

    def chain(acc: Column, x: Column) -> Column:
        return F.struct(x["_f"]["s"][acc["s"]].alias("s"), (acc["n"] + x["_f"]["n"][acc["s"]]).alias("n"))

    whole = F.aggregate("_c", F.struct(F.lit(states.index(start)).alias("s"), F.lit(0).cast("long").alias("n")), chain)
    return chained.select(*by, whole.alias("_s")).select(*by, F.array(*[F.lit(s) for s in states])[F.col("_s.s")].alias("state"),
        F.col("_s.n").alias("changes"))


# Coverage classes by age in seconds since admission (class, from age on, interval in seconds).
COVERAGE = (("INITIAL", 0, 15), ("EARLY", 120, 30), ("MATURE", 600, 300), ("COOLED", 3600, 1800), ("LONG_TAIL_DAY", 21600, 7200),
    ("LONG_TAIL_WEEK", 86400, 43200), ("RETIRED", 604800, None))


def coverage_class(age_seconds: Column) -> Column:
    out = F.when(age_seconds >= COVERAGE[-1][1], COVERAGE[-1][0])
    for name, start, _ in reversed(COVERAGE[:-1]):
        out = out.when(age_seconds >= start, name)
    return out


def coverage_interval(age_seconds: Column) -> Column:
    out = F.when(age_seconds >= COVERAGE[-1][1], F.lit(None).cast("int"))
    for _, start, interval in reversed(COVERAGE[:-1]):
        out = out.when(age_seconds >= start, interval)
    return out


# Classes of the states that do not depend on age, the boundaries of the fading tail in seconds, and the intervals of all these.
BY_STATE = {"ACTIVE": "PROTECTED_ACTIVE", "RESURRECTED": "PROTECTED_RESURRECTED", "WATCH": "PROTECTED_WATCH", "DORMANT": "RETIRED_CONTROL"}
FADING = (("FADING_TAIL", 1800), ("FADING_COOL", 21600))
STATE_INTERVALS = {"PROTECTED_ACTIVE": 5, "PROTECTED_RESURRECTED": 5, "PROTECTED_WATCH": 15, "FADING_TAIL": 120, "FADING_COOL": 1800}


def coverage_for(state: Column, age_seconds: Column, state_age_seconds: Column) -> Column:
    """Coverage of a key in a lifecycle state: by the state where that protects or retires it, by the time since it began
    to fade, else by the age since admission. A time before the admission or the fading gives null."""
    fading = F.when(state_age_seconds < 0, F.lit(None).cast("string"))
    for name, end in FADING:
        fading = fading.when(state_age_seconds < end, name)
    young = F.when(coverage_class(age_seconds) == COVERAGE[-1][0], "RETIRED_CONTROL").otherwise(coverage_class(age_seconds))
    out = F.when(age_seconds.isNull() | (age_seconds < 0), F.lit(None).cast("string")).when(state == "FADING",
        F.when(state_age_seconds.isNotNull(), fading.otherwise("RETIRED_CONTROL")))
    for name, coverage in BY_STATE.items():
        out = out.when(state == name, coverage)
    return out.otherwise(young)


def interval_for(coverage: Column) -> Column:
    """Seconds between observations of a class; null for one that is retired."""
    every = STATE_INTERVALS | {name: interval for name, _, interval in COVERAGE if interval}
    return F.create_map(*[F.lit(x) for pair in every.items() for x in pair])[coverage]


def seconds_to_transition(coverage: Column, age_seconds: Column, state_age_seconds: Column) -> Column:
    """How long until the class changes by itself; null for classes that only a new state ends."""
    ends = {name: COVERAGE[i + 1][1] for i, (name, _, _) in enumerate(COVERAGE[:-1])}
    out = None
    for name, end in FADING:
        out = (F.when if out is None else out.when)(coverage == name, end - state_age_seconds)
    return out.otherwise(F.create_map(*[F.lit(x) for pair in ends.items() for x in pair])[coverage] - age_seconds)


@dataclass(frozen=True)
class TierPolicy:
    """A key is promoted by an eligible observation, held while observations renew it, and demoted once `ttl` seconds passed without one."""

    least_value: float
    ttl: int


def simulate_tiers(observations: DataFrame, key: str, t: Column, value: str, policy: TierPolicy) -> DataFrame:
    """Spans of every key under the policy: key, started, ended and renewals.

    Only eligible observations move the state: one within `ttl` of the last renews the span, a later one begins
    a new one. So the machine is a matter of gaps between eligible observations."""
    seen = observations.select(F.col(key).alias("key"), t.cast("double").alias("t"),
        F.col(value).cast("double").alias("value")).filter(F.col("value") >= policy.least_value)
    along = Window.partitionBy("key").orderBy("t")
    new = F.coalesce((F.col("t") >= F.lag("t").over(along) + policy.ttl).cast("int"), F.lit(1))
    spans = seen.withColumn("_new", new).withColumn("_span", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("key", "_span").agg(F.min("t").alias("started"), (F.max("t") + policy.ttl).alias("ended"),
        (F.count(F.lit(1)) - 1).alias("renewals")).drop("_span")


TIERS = ("TIER_0", "TIER_1", "TIER_2", "TIER_3")

#: Decisions that one row holds while they are folded.
PIECE = 256

_STATE = "struct<tier: int, seen: double, until: double>"


def _moved(state: Column, r: Column) -> tuple[Column, Column]:
    """The tier after a decision, and whether the decision makes a change: to another tier, or of coverage that has ended."""
    tier, seen, until = state["tier"], state["seen"], state["until"]
    old = F.coalesce((r["watermark"] < seen) | ((r["watermark"] == seen) & (r["want"] < tier)), F.lit(False))
    target = F.when(~r["eligible"] & F.coalesce(r["t"] < until, F.lit(False)), tier).otherwise(r["want"])
    renewed = (target == tier) & (tier > 0) & r["eligible"] & F.coalesce(until <= r["t"], F.lit(False))
    return target, ~old & ((target != tier) | renewed)


def _fold(given: Column, rows: Column, id_type: str) -> Column:
    """state, after the decisions of one piece, and moves, the changes they make to the state given."""
    kind = f"array<struct<id: {id_type}, previous: int, tier: int, t: double, covered_until: double>>"

    def step(acc: Column, r: Column) -> Column:
        target, moved = _moved(acc["state"], r)
        until = F.when(target > 0, r["t"] + r["ttl"])
        after = F.struct(target.alias("tier"), r["watermark"].alias("seen"), until.alias("until")).cast(_STATE)
        move = F.struct(r["id"].alias("id"), acc["state"]["tier"].alias("previous"), target.alias("tier"), r["t"].alias("t"), until.alias("covered_until"))
        longer = F.concat(acc["moves"], F.array(move).cast(kind))
        return F.struct(F.when(moved, after).otherwise(acc["state"]).alias("state"), F.when(moved, longer).otherwise(acc["moves"]).alias("moves"))

    return F.aggregate(rows, F.struct(given.alias("state"), F.array().cast(kind).alias("moves")), step)


def tier_transitions(decisions: DataFrame) -> DataFrame:
    """The changes that a stream of decisions makes to each token's tier.

    decisions: token_id, id, t (seconds of the evaluation), watermark, tier, eligible, ttl. Rules: evidence older than
    what was used already is ignored; evidence of the same time never demotes; a token that is not eligible
    any more keeps its tier until its coverage ends. A change sets the coverage to t + ttl, or to nothing in
    tier 0. Decisions without a time, a watermark or a known tier are left out; a null eligible is false. Tokens start in tier 0.

    A token's decisions, sorted by (t, id), are cut into pieces, which are folded apart, each from a guess of what it starts with: nothing. What a change leaves depends on its
    decision alone, so pieces end alike from nearly any start. A piece that makes a change hands its end to the next, one that makes none hands on what it was
    given; pieces that were given something else than they guessed are folded again, until none is. That is exact however many rounds it takes, and
    in each the first wrong piece of every token is set right. The line of a hot token is cut first, so no task sorts all of it."""
    rows = decisions.select("token_id", "id", F.col("t").cast("double").alias("t"), F.col("watermark").cast("double").alias("watermark"),
        (F.array_position(F.array(*map(F.lit, TIERS)), F.col("tier")) - 1).cast("int").alias("want"), F.coalesce("eligible", F.lit(False)).alias("eligible"),
        F.col("ttl").cast("double").alias("ttl")).filter("t IS NOT NULL AND watermark IS NOT NULL AND want >= 0")
    by, place = ["token_id"], ["token_id", "_chunk", "_part"]
    cut = with_chunks(rows, hot_cuts(rows, by, "t"), by, "t") if any_hot(rows.select("token_id", "t"), by, "t") else rows.withColumn("_chunk", F.lit(0))
    numbered = cut.withColumn("_part", F.floor((F.row_number().over(Window.partitionBy("token_id", "_chunk").orderBy("t", "id")) - 1) / PIECE))
    packed = numbered.groupBy(*place).agg(F.array_sort(F.collect_list(F.struct("t", "id", "watermark", "want", "eligible", "ttl"))).alias("_rows"))
    pieces = durable(packed, "decisions")
    start = F.struct(F.lit(0).alias("tier"), F.lit(None).alias("seen"), F.lit(None).alias("until")).cast(_STATE)
    id_type = dict(rows.dtypes)["id"]
    folded = durable(pieces.withColumn("_given", start).withColumn("_f", _fold(F.col("_given"), F.col("_rows"), id_type)).drop("_rows"), "folded")
    before = Window.partitionBy("token_id").orderBy("_chunk", "_part").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        handed = F.coalesce(F.last(F.when(F.size("_f.moves") > 0, F.col("_f.state")), ignorenulls=True).over(before), start)
        ends = durable(folded.select(*place, "_given", handed.alias("_handed")), "handed")
        wrong = ends.filter(~F.col("_handed").eqNullSafe(F.col("_given"))).select(*place, "_handed")
        if wrong.isEmpty():
            break
        again = pieces.alias("p").join(wrong.alias("w"), same("p", "w", place)).select("p.*", F.col("w._handed").alias("_given"))
        again = again.withColumn("_f", _fold(F.col("_given"), F.col("_rows"), id_type)).drop("_rows")
        right = folded.alias("f").join(wrong.alias("w"), same("f", "w", place), "left_anti")
        folded = durable(right.unionByName(again), "folded")
    name = F.array(*map(F.lit, TIERS))
    return folded.select("token_id", F.explode("_f.moves").alias("m")).select("token_id", "m.id", name[F.col("m.previous")].alias("previous"),
        name[F.col("m.tier")].alias("tier"), "m.t", "m.covered_until")


def plan_capacity(counts: dict[str, int], intervals: dict[str, int], weights: dict[str, float], per_minute: float, floor_share: float = 0.05) -> dict:
    """How often each class can be polled within a budget of observations a minute.

    NORMAL: all wishes fit. DEGRADED: the budget is shared by weighted max-min fairness, no class below
    its floor share. CRITICAL: not even the floors fit, and they are scaled down."""
    demand = {k: 60.0 * counts[k] / intervals[k] for k in counts if counts[k] > 0}
    if sum(demand.values()) <= per_minute:
        return {"mode": "NORMAL", "granted": demand, "intervals": {k: intervals[k] for k in demand}}
    floors = {k: min(d, floor_share * d) for k, d in demand.items()}
    need = sum(floors.values())
    if need >= per_minute:
        granted, mode = {k: f * per_minute / need for k, f in floors.items()}, "CRITICAL"
    else:
        low, high = 0.0, per_minute
        level = lambda x: {k: min(demand[k], max(floors[k], x * weights[k])) for k in demand}
        while sum(level(high).values()) < per_minute:
            high *= 2
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if sum(level(middle).values()) <= per_minute else (low, middle)
        granted, mode = level(low), "DEGRADED"
    return {"mode": mode, "granted": granted, "intervals": {k: math.ceil(60 * counts[k] / g) if g else None for k, g in granted.items()}}
