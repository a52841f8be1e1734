"""Leak-free datasets: decision times, features known then, outcomes after, and splits.

Observations: key, id, at (timestamp) and value, plus whatever else features use. A feature looks at
facts at or before its decision, a label only behind it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS, change, micros, plain_change, tri_state
from tidemark.operators.asof import asof_join, lookbacks
from tidemark.operators.paths import path_summary

HOUR = 3600
LOOKBACKS = {"6h": (6 * HOUR, 3 * HOUR), "24h": (24 * HOUR, 12 * HOUR), "72h": (72 * HOUR, 36 * HOUR)}
#: Gap that still counts as complete: a tenth of the horizon within these bounds, in seconds.
GAP_SHARE, LEAST_GAP, MOST_GAP = 0.1, 60, 1800


def candidate_times(observations: DataFrame, admissions: DataFrame, key: str, at: str, offsets: Sequence[int],
    transitions: DataFrame | None = None) -> DataFrame:
    """key, decision_at and the reasons: fixed ages after admission, observations from
    admission on, and given transitions. Each time once; keys never admitted have none."""
    by_age = admissions.select(key, F.explode(F.array(*[F.col("admitted_at") + F.expr(f"INTERVAL {o} SECOND") for o in offsets])).alias("decision_at"), F.lit("fixed_age").alias("reason"))
    seen = observations.join(admissions, key).filter(F.col(at) >= F.col("admitted_at")).select(key, F.col(at).alias("decision_at"),
        F.lit("observation").alias("reason"))
    every = by_age.unionByName(seen)
    if transitions is not None:
        moved = transitions.join(admissions, key).filter(F.col(at) >= F.col("admitted_at"))
        every = every.unionByName(moved.select(key, F.col(at).alias("decision_at"), F.lit("lifecycle").alias("reason")))
    return every.groupBy(key, "decision_at").agg(F.array_join(F.array_sort(F.collect_set("reason")), "+").alias("reasons"))


def lookback_features(probes: DataFrame, observations: DataFrame, key: str, probe_id: str, probe_at: str, at: str, value: str,
    horizons: dict[str, tuple[int, int]] = LOOKBACKS) -> DataFrame:
    """Returns over each lookback against the value at the probe itself, and the true distances."""
    found = lookbacks(probes, observations, [key], [probe_id], probe_at, at, [value], horizons)
    now = asof_join(probes, observations, [key], probe_at, at, [value], prefix="current_").select(key, probe_id, f"current_{value}")
    out = now.join(found, [key, probe_id])
    return out.select(
        key, probe_id, *[F.round(change(f"current_{value}", f"{value}_{h}"), 6).alias(f"return_{h}") for h in horizons],
        *[F.col(f"actual_seconds_{h}").alias(f"actual_seconds_{h}") for h in horizons]
    )


def rolling_path(observations: DataFrame, key: str, at: str, value: str, span: int) -> DataFrame:
    """For each observation over its path (t - span, t], in one window pass: count, volatility
    of log returns (population), drawdown, recovery, monotonicity and smoothness.

    A return belongs to the path only if both its ends do, so the first one of each path is taken off. Values of 0 are divided by as doubles are: a return
    from or to 0 is infinite, one between two of them NaN, and neither volatility nor smoothness is a number then. Negative values have no return."""
    order = Window.partitionBy(key).orderBy("_t")
    path = order.rangeBetween(-(span * MICROS - 1), 0)
    r = observations.withColumn("_t", micros(at)).withColumn("_before", F.lag(value).over(order))
    r = r.withColumn("_r", F.when((F.col(value) > 0) & (F.col("_before") > 0), F.log(F.col(value) / F.col("_before"))))
    # Returns from or to 0 are counted beside the sums, which could not take an infinite one off again.
    r = r.withColumn("_odd", ((F.least(value, "_before") == 0) & F.col(value).isNotNull() & F.col("_before").isNotNull()).cast("int"))
    odd = F.col("_odd") == 1
    r = r.withColumns({"_sq": F.col("_r") * F.col("_r"), "_ab": F.abs("_r"), "_sg": F.when(odd, F.signum(F.col(value) - F.col("_before"))).otherwise(F.signum("_r")),
        "_nz": F.when(odd, 1).otherwise((F.col("_r") != 0).cast("int")), "_one": (F.col("_r").isNotNull() | F.coalesce(odd, F.lit(False))).cast("int")})
    inner = {c: F.coalesce(F.sum(c).over(path), F.lit(0)) - F.coalesce(F.first(c).over(path), F.lit(0)) for c in ("_r", "_sq", "_ab", "_sg", "_nz", "_one", "_odd")}
    r = r.withColumns({"n": F.count(F.lit(1)).over(path), "high": F.max(value).over(path), "low": F.min(value).over(path)} | {f"i{c}": e for c,
        e in inner.items()})
    n = F.col("i_one")
    variance = F.greatest(F.col("i_sq") / n - (F.col("i_r") / n) * (F.col("i_r") / n), F.lit(0.0))
    rms, nan = F.sqrt(F.greatest(F.col("i_sq"), F.lit(0.0)) / n), F.lit(float("nan"))
    return r.withColumns(
        {
            "path_count": F.col("n"), "realized_volatility": F.when(n >= 2, F.when(F.col("i_odd") > 0, nan).otherwise(F.sqrt(variance))),
            "drawdown": plain_change(value, "high"), "recovery": plain_change(value, "low"),
            "monotonicity": F.when(F.col("i_nz") > 0, F.abs(F.col("i_sg")) / F.col("i_nz")), "smoothness": F.when((n > 0) & (F.col("i_odd") > 0), nan).when((n > 0) & (rms > 0), F.col("i_ab") / n / rms),
        }
    ).drop("_t", "_r", "_before", "_odd", "_sq", "_ab", "_sg", "_nz", "_one", "n", "high", "low", *[f"i{c}" for c in inner])


@dataclass(frozen=True)
class Horizon:
    seconds: int
    tolerance: int
    #: None: by rule from the horizon.
    gap: int | None = None

    @property
    def most_gap(self) -> float:
        return self.gap if self.gap is not None else min(max(GAP_SHARE * self.seconds, LEAST_GAP), MOST_GAP)


def path_labels(entries: DataFrame, observations: DataFrame, key: str, entry_id: str, entry_at: str, entry_value: str, at: str, value: str,
    horizon: Horizon, ups: dict[str, float], downs: dict[str, float], dense: bool | None = None) -> DataFrame:
    """Outcomes over (t, t + horizon + tolerance] of each entry.

    path_complete: there is an observation from the horizon's end on, and no gap, the one after the entry
    included, is longer than allowed. best/worst: extreme returns, only of complete paths, over an entry of 0 infinite or NaN. crossed_<name>: tri-state.
    seconds_to_<name>: until the first crossing. Entries without a path keep their row. dense as in path_summary."""
    plain = entries.select(key, F.col(entry_id).alias("_entry"), F.col(entry_at).alias("_t0"), F.col(entry_value).cast("double").alias("_v0"))
    bounds = {n: (F.col("_v0") * m, True) for n, m in ups.items()} | {n: (F.col("_v0") * m, False) for n, m in downs.items()}
    path = path_summary(plain, observations, [key], "_entry", "_t0", at, value, horizon.seconds + horizon.tolerance, bounds, dense)
    out = plain.join(path, "_entry", "left")
    complete = F.coalesce((F.col("reach") >= horizon.seconds) & (F.col("gap") <= horizon.most_gap), F.lit(False))
    return out.select(
        F.col("_entry").alias(entry_id), F.coalesce("n", F.lit(0)).alias("path_count"), F.col("gap").alias("longest_gap"), complete.alias("path_complete"),
        F.when(complete, plain_change("high", "_v0")).alias("best_return"), F.when(complete, plain_change("low", "_v0")).alias("worst_return"),
        *[tri_state(F.col(f"s_{n}").isNotNull(), complete).alias(f"crossed_{n}") for n in bounds], *[F.col(f"s_{n}").alias(f"seconds_to_{n}") for n in bounds],
    )


def ordered_label(first: str, second: str, complete: Column) -> Column:
    """Whether the first time comes before the second: TRUE, FALSE, or UNKNOWN while it may still turn out."""
    return (
        F.when(F.col(first).isNotNull() & (F.col(second).isNull() | (F.col(first) < F.col(second))), "TRUE")
        .when(F.col(second).isNotNull() | F.coalesce(complete, F.lit(False)), "FALSE").otherwise("UNKNOWN")
    )


@dataclass(frozen=True)
class SplitWindow:
    name: str
    start: str
    end: str
    label_end: str


def check_windows(windows: Sequence[SplitWindow], longest_label: int, purge: int) -> None:
    for a, b in zip(windows, windows[1:], strict=False):
        if not (a.start < a.end <= b.start < b.end):
            raise ValueError(f"windows {a.name} and {b.name} overlap or are out of order")
    if purge < longest_label:
        raise ValueError("the purge is shorter than the longest label")


def assign_split(admitted_at: Column, decided_at: Column, windows: Sequence[SplitWindow], longest_label: int) -> Column:
    """The window of the admission, if the decision falls in it too and its labels end in time; else null."""
    out = None
    for w in windows:
        stamp = lambda s: F.lit(s).cast("timestamp_ntz")
        inside = lambda c: (c >= stamp(w.start)) & (c < stamp(w.end))  # noqa: B023, E731
        ok = inside(admitted_at) & inside(decided_at) & (decided_at + F.expr(f"INTERVAL {longest_label} SECOND") <= stamp(w.label_end))
        out = F.when(ok, w.name) if out is None else out.when(ok, w.name)
    return out


def assert_no_leak(rows: DataFrame, decided_at: str, *known_at: str) -> DataFrame:
    """rows; evaluating them raises if any used time lies behind the decision."""
    late = F.lit(False)
    for k in known_at:
        late = late | F.coalesce(F.col(k) > F.col(decided_at), F.lit(False))
    return rows.withColumn("_ok", F.when(late,
        F.raise_error(F.lit("a fact behind its decision was used")).cast("boolean")).otherwise(F.lit(True))).filter("_ok").drop("_ok")
