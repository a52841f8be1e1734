"""As-of joins: what was known at a time, by one union and one window.

Facts and probes of a key are laid along one time line and each probe takes the
last fact before it. That is one shuffle by key and one sort, whatever the
number of probes, where a join on inequalities would compare all pairs of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS, micros
from tidemark.operators.cuts import any_hot, every_chunk, hot_cuts, same, with_chunks

_FACT, _PROBE = 0, 1


def _timeline(probes: DataFrame, facts: DataFrame, by: Sequence[str], probe_at: Column, fact_at: Column, rank: Column, payload: Sequence[str]) -> DataFrame:
    left = facts.select(*by, fact_at.alias("_t"), F.lit(_FACT).alias("_side"), rank.alias("_rank"), F.struct(*payload).alias("_fact"))
    right = probes.select(*by, probe_at.alias("_t"), F.lit(_PROBE).alias("_side"), F.struct(*probes.columns).alias("_probe"))
    return left.unionByName(right, allowMissingColumns=True)


def _carried(line: DataFrame, by: Sequence[str], order: Sequence[Column], forward: bool, split_seconds: int | None, largest: bool = False) -> DataFrame:
    """Probes with the last fact before them (largest: with the largest).

    The time line of a hot key is cut into chunks (with split_seconds that of every key, at equal lengths). Rows are sorted within their chunk
    only; one fact is kept of each chunk, and what it hands on to later ones is found among those few."""
    over = (lambda c, w: F.max(c).over(w)) if largest else (lambda c, w: F.last(c, ignorenulls=True).over(w))
    probe = F.col("_side") == _PROBE
    if split_seconds is None and not any_hot(line.select(*by, "_t"), by, "_t"):
        w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return line.withColumn("_last", over("_fact", w)).filter(probe)
    pick = F.max("_fact") if largest else (F.min_by if forward else F.max_by)("_fact", F.struct("_t", "_rank"))
    along = Window.partitionBy(*by).orderBy(F.col("_chunk").desc() if forward else F.col("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    w = Window.partitionBy(*by, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if split_seconds is None:
        cuts = hot_cuts(line, by, "_t")
        cut = with_chunks(line, cuts, by, "_t")
        left = with_chunks(line.filter(F.col("_side") == _FACT), cuts, by, "_t", only_hot=True).groupBy(*by, "_chunk").agg(pick.alias("_own"))
        every = every_chunk(cuts, by)
    else:
        cut = line.withColumn("_chunk", F.floor(F.col("_t") / (split_seconds * MICROS)))
        left = cut.filter(F.col("_side") == _FACT).groupBy(*by, "_chunk").agg(pick.alias("_own"))
        every = cut.select(*by, "_chunk").distinct()
    chunks = every.alias("c").join(left.alias("l"), same("c", "l", (*by, "_chunk")), "left").select(*[F.col(f"c.{c}") for c in (*by, "_chunk")], "l._own")
    handed = chunks.select(*by, "_chunk", over("_own", along).alias("_handed")).filter("_handed IS NOT NULL")
    own = cut.withColumn("_last", over("_fact", w)).filter(probe)
    # Of hot keys alone: some hundred rows for a million.
    handed = F.broadcast(handed.alias("h")) if split_seconds is None else handed.alias("h")
    joined = own.alias("o").join(handed, same("o", "h", (*by, "_chunk")), "left").select("o.*", "h._handed")
    return joined.withColumn("_last", (F.greatest if largest else F.coalesce)("_last", "_handed")).drop("_handed", "_chunk")


def hot_split(facts: DataFrame, by: Sequence[str], at: str, most_rows: int = 2_000_000) -> int | None:
    """A split_seconds with which no chunk of the fullest key has much more than most_rows facts, for a caller who wants chunks of equal length; None if none has more as it is."""
    n = facts.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), ((F.max(micros(at)) - F.min(micros(at))) / MICROS).alias("s"))
    hot = n.agg(F.max("n").alias("n"), F.max(F.when(F.col("n") > most_rows, F.struct("n", "s"))).alias("x")).first()
    return None if hot is None or hot["x"] is None else max(1, int(hot["x"]["s"] * most_rows / hot["x"]["n"]))


def _out(line: DataFrame, probes: DataFrame, prefix: str, found: Column, payload: Sequence[str], keep: Column) -> DataFrame:
    line = line.withColumn("_found", F.when(keep, found))
    return line.select(*[F.col(f"_probe.{c}").alias(c) for c in probes.columns], *[F.col(f"_found.{c}").alias(prefix + c) for c in payload])


def asof_join(
    probes: DataFrame, facts: DataFrame, by: Sequence[str], probe_time: str, fact_time: str, payload: Sequence[str], tie: str | None = None,
    lookback: int = 0, tolerance: int | None = None, forward: bool = False, strict: bool = False, prefix: str = "asof_", split_seconds: int | None = None,
) -> DataFrame:
    """Each probe with the payload of one fact of its key, or nulls.

    Backward: the latest fact at or before probe time - lookback; forward: the
    earliest at or after probe time + lookback (seconds). strict leaves out the very
    time. A fact further off than tolerance seconds gives nulls. Facts of one time are ordered
    by `tie`; backward takes the largest, forward the smallest. Empty keys and
    probes without facts keep their row.

    A key that holds a large part of all rows has its time line cut into chunks, which are sorted apart, and each chunk starts with what the
    chunks before it left. split_seconds cuts every line, at this length. The result is the same.
    """
    shift = F.lit(lookback * MICROS)
    probe_at, fact_at = micros(probe_time) + (shift if forward else -shift), micros(fact_time)
    line = _timeline(probes, facts.filter(F.col(fact_time).isNotNull()), by, probe_at, fact_at, F.col(tie) if tie else F.lit(0),
        [*payload, fact_time] if fact_time not in payload else list(payload))
    first_side = F.col("_side") if not strict else -F.col("_side")
    order = [F.col("_t"), first_side, F.col("_rank")] if not forward else [F.col("_t").desc(), first_side, F.col("_rank").desc()]
    line = _carried(line, by, order, forward, split_seconds)
    apart = F.abs(F.col("_t") - micros(F.col(f"_last.{fact_time}")))
    return _out(line, probes, prefix, F.col("_last"), payload, apart <= tolerance * MICROS if tolerance is not None else F.lit(True))


def asof_largest(probes: DataFrame, facts: DataFrame, by: Sequence[str], probe_time: str, times: Sequence[str], order: Sequence[str],
    payload: Sequence[str], prefix: str = "asof_", split_seconds: int | None = None) -> DataFrame:
    """Of the facts whose every time is at or before the probe's, the one that is largest by `order`.

    The winner need not be the one that became visible last, so a running
    maximum takes the place of the last value. split_seconds as in asof_join."""
    visible = F.greatest(*[micros(t) for t in times]) if len(times) > 1 else micros(times[0])
    known = facts
    for t in times:
        known = known.filter(F.col(t).isNotNull())
    line = _timeline(probes, known.withColumn("_order", F.struct(*order)), by, micros(probe_time), visible, F.lit(0), ["_order", *payload])
    line = _carried(line, by, [F.col("_t"), F.col("_side")], False, split_seconds, largest=True)
    return _out(line, probes, prefix, F.col("_last"), payload, F.lit(True))


def lookbacks(probes: DataFrame, facts: DataFrame, by: Sequence[str], probe_key: Sequence[str], probe_time: str, fact_time: str,
    payload: Sequence[str], horizons: dict[str, tuple[int, int]], tie: str | None = None, split_seconds: int | None = None) -> DataFrame:
    """All lookbacks in one pass: horizons maps a name to (seconds back, tolerance). Each
    probe row gets <payload>_<name> and actual_seconds_<name>, the true distance. split_seconds as in asof_join."""
    spans = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(h * MICROS).alias("back"), F.lit(t * MICROS).alias("off")) for n, (h, t) in horizons.items()])
    asked = probes.select(*by, *[c for c in probe_key if c not in by], micros(probe_time).alias("_now"),
        F.explode(spans).alias("_h")).withColumn("_at", F.col("_now") - F.col("_h.back"))
    known = facts.filter(F.col(fact_time).isNotNull()).select(*by, micros(fact_time).alias("_t"), (F.col(tie) if tie else F.lit(0)).alias("_rank"),
        F.struct(micros(fact_time).alias("_ft"), *payload).alias("_fact"))
    line = known.withColumn("_side", F.lit(_FACT)).unionByName(asked.withColumnRenamed("_at", "_t").withColumn("_side", F.lit(_PROBE)),
        allowMissingColumns=True)
    line = _carried(line, by, [F.col("_t"), F.col("_side"), F.col("_rank")], False, split_seconds)
    near = F.col("_t") - F.col("_last._ft") <= F.col("_h.off")
    aggs = []
    for n in horizons:
        mine = (F.col("_h.name") == n) & near
        aggs += [F.max(F.when(mine, F.col(f"_last.{p}"))).alias(f"{p}_{n}") for p in payload]
        aggs.append(F.max(F.when(mine, (F.col("_now") - F.col("_last._ft")) / MICROS)).alias(f"actual_seconds_{n}"))
    keys = list(dict.fromkeys([*by, *probe_key]))
    return line.groupBy(*keys).agg(*aggs)


def path_join(probes: DataFrame, facts: DataFrame, by: Sequence[str], probe_time: str, fact_time: str, after: int, until: int,
    closed_start: bool = False) -> DataFrame:
    """Pairs of a probe and each fact of its key with time in (t + after, t + until] seconds; closed_start takes t + after too.

    Both sides are cut into buckets as long as the span, a probe goes to the two
    or three buckets it can reach, and the join is an equality on key and bucket. Columns of facts
    that probes have too are prefixed with fact_."""
    size = max(1, until - after) * MICROS
    low, high = micros(probe_time) + after * MICROS, micros(probe_time) + until * MICROS
    reach = F.sequence(F.floor(low / size), F.floor(high / size))
    p = probes.withColumns({"_low": low, "_high": high}).withColumn("_bucket", F.explode(reach))
    renamed = {c: f"fact_{c}" for c in facts.columns if c in probes.columns and c not in by}
    f = facts.withColumn("_ft", micros(fact_time)).withColumn("_bucket", F.floor(F.col("_ft") / size)).withColumnsRenamed(renamed)
    inside = (F.col("_ft") >= F.col("_low") if closed_start else F.col("_ft") > F.col("_low")) & (F.col("_ft") <= F.col("_high"))
    return p.join(f, [*by, "_bucket"]).filter(inside).drop("_low", "_high", "_bucket", "_ft")
