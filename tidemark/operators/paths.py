"""What happened to a value behind each of many entries: extremes, gaps and first crossings over a span.

Two plans with the same result. Where facts are thin, each entry meets every fact of its span. Where they are
dense, facts are summed up in pieces of the span; an entry takes whole pieces, and meets facts only at the two edges of its span and
in the piece where a bound is first crossed. Rows of an entry then grow with the root of what its span holds, not with all of it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS, micros
from tidemark.operators.asof import path_join

#: Facts that some key has in one span beyond which facts are summed up in pieces.
DENSE = 2_000


def fullest_span(facts: DataFrame, by: Sequence[str], at: str, seconds: int) -> int:
    """The most facts that any key has in a bucket as long as the span."""
    n = facts.groupBy(*by, F.floor(micros(at) / (seconds * MICROS)).alias("_b")).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.max("n")).first()[0] or 0


def path_summary(entries: DataFrame, facts: DataFrame, by: Sequence[str], entry: str, entry_at: str, at: str, value: str, seconds: int,
    bounds: Mapping[str, tuple[Column, bool]], dense: bool | None = None) -> DataFrame:
    """For each entry with any fact of its key in (t, t + seconds]: n, gap (the longest, the one after the entry included) and reach (of the
    last fact) in seconds, high, low, and for each bound s_<name>, the seconds until the value is first at or beyond it.

    bounds: name to (column of entries, whether it lies above). Facts without a value count for n, gap and reach. dense: which plan; by default it is measured."""
    named = entries.select(*by, F.col(entry).alias("_entry"), micros(entry_at).alias("_t0"),
        *[c.cast("double").alias(f"_b_{n}") for n, (c, _) in bounds.items()]).filter("_t0 IS NOT NULL")
    told = facts.select(*by, F.col(at).alias("_at"), F.col(value).cast("double").alias("_v")).filter("_at IS NOT NULL")
    most = fullest_span(told, by, "_at", seconds) if dense is None else 0
    if dense or most > DENSE:
        # The root of what a span holds balances pieces and edges.
        pieces = max(16, min(1024, math.isqrt(most)))
        return _by_pieces(named, told.select(*by, micros("_at").alias("_t"), "_v"), by, seconds * MICROS, bounds, pieces).withColumnRenamed("_entry", entry)
    path = path_join(named.withColumn("_t0_", F.timestamp_micros("_t0")), told, by, "_t0_", "_at", 0, seconds).withColumn("_t", micros("_at"))
    items = path.select("_entry", "_t0", *[f"_b_{n}" for n in bounds], F.lit(1).alias("n"), F.col("_v").alias("high"), F.col("_v").alias("low"),
        F.col("_t").alias("first"), F.col("_t").alias("last"), F.lit(0).cast("long").alias("gap"), F.lit(None).cast("long").alias("piece"))
    return _summed(items, bounds).select("_entry", "n", "gap", "reach", "high", "low",
        *[F.col(f"s_{n}.s").alias(f"s_{n}") for n in bounds]).withColumnRenamed("_entry", entry)


def _summed(items: DataFrame, bounds: Mapping[str, tuple[Column, bool]]) -> DataFrame:
    """One row for each entry of its items in order of time; s_<name>: seconds and piece of the first item at or beyond the bound."""
    w = Window.partitionBy("_entry").orderBy("first", "last")
    items = items.withColumn("between", F.col("first") - F.coalesce(F.lag("last").over(w), F.col("_t0")))
    crossed = {n: F.col("high") >= F.col(f"_b_{n}") if above else F.col("low") <= F.col(f"_b_{n}") for n, (_, above) in bounds.items()}
    since = lambda t: (F.col(t) - F.col("_t0")) / MICROS
    return items.groupBy("_entry").agg(
        F.sum("n").alias("n"), (F.max(F.greatest("gap", "between")) / MICROS).alias("gap"), F.max(since("last")).alias("reach"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        *[F.min(F.when(c, F.struct(since("first").alias("s"), "piece"))).alias(f"s_{n}") for n, c in crossed.items()],
    )


def _by_pieces(entries: DataFrame, facts: DataFrame, by: Sequence[str], span: int, bounds: Mapping[str, tuple[Column, bool]], pieces: int) -> DataFrame:
    step = -(-span // pieces)
    piece, block = F.floor(F.col("_t") / step), F.floor(F.col("_t") / (step * pieces))
    facts = facts.withColumns({"_piece": piece, "_block": block})
    along = Window.partitionBy(*by, "_block").orderBy("_t")
    inside = F.when(F.lag("_piece").over(along) == F.col("_piece"), F.col("_t") - F.lag("_t").over(along)).otherwise(F.lit(0))
    summed = facts.withColumn("_gap", inside).groupBy(*by, "_block", "_piece").agg(
        F.count(F.lit(1)).alias("n"), F.max("_v").alias("high"), F.min("_v").alias("low"), F.min("_t").alias("first"), F.max("_t").alias("last"),
        F.max("_gap").alias("gap")
    )
    whole = summed.groupBy(*by, "_block").agg(F.collect_list(F.struct("_piece", "n", "high", "low", "first", "last",
        "gap")).alias("_pieces"))  # at most `pieces` of them
    start, end = F.floor((F.col("_t0") + 1) / step), F.floor((F.col("_t0") + span) / step)
    entries = entries.withColumns({"_start": start, "_end": end})
    own = ["_entry", "_t0", *[f"_b_{n}" for n in bounds]]
    blocks = entries.withColumn("_block",
        F.explode(F.sequence(F.floor((F.col("_t0") + 1) / (step * pieces)), F.floor((F.col("_t0") + span) / (step * pieces)))))
    inner = blocks.join(whole, [*by, "_block"]).select(*own,
        F.explode(F.filter("_pieces", lambda x: (x["_piece"] > F.col("_start")) & (x["_piece"] < F.col("_end")))).alias("x"))
    inner = inner.select(*own, "x.n", "x.high", "x.low", "x.first", "x.last", "x.gap", F.col("x._piece").alias("piece"))
    edges = entries.withColumn("_piece", F.explode(F.array_distinct(F.array("_start", "_end")))).join(facts.select(*by, "_piece", "_t", "_v"), [*by, "_piece"])
    edges = edges.filter((F.col("_t") > F.col("_t0")) & (F.col("_t") <= F.col("_t0") + span))
    edges = edges.select(*own, F.lit(1).cast("long").alias("n"), F.col("_v").alias("high"), F.col("_v").alias("low"), F.col("_t").alias("first"),
        F.col("_t").alias("last"), F.lit(0).cast("long").alias("gap"), F.lit(None).cast("long").alias("piece"))
    found = _summed(inner.unionByName(edges), bounds)
    if not bounds:
        return found
    # In the piece where a bound is first crossed, the fact that does so.
    asked = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(above).alias("above"), F.col(f"s_{n}.piece").alias("_piece"),
        F.col(f"_b_{n}").alias("bound")) for n, (_, above) in bounds.items()])
    open_ = found.join(entries, "_entry").select("_entry", "_t0", *by,
        F.explode(F.filter(asked, lambda x: x["_piece"].isNotNull())).alias("x")).select("_entry", "_t0", *by, "x.*")
    beyond = F.when(F.col("above"), F.col("_v") >= F.col("bound")).otherwise(F.col("_v") <= F.col("bound"))
    first = open_.join(facts.select(*by, "_piece", "_t", "_v"), [*by, "_piece"]).filter(beyond).groupBy("_entry",
        "name").agg((F.min(F.col("_t") - F.col("_t0")) / MICROS).alias("s"))
    first = first.groupBy("_entry").agg(*[F.max(F.when(F.col("name") == n, F.col("s"))).alias(f"_s_{n}") for n in bounds])
    out = found.join(first, "_entry", "left")
    return out.select("_entry", "n", "gap", "reach", "high", "low",
        *[F.when(F.col(f"s_{n}.piece").isNull(), F.col(f"s_{n}.s")).otherwise(F.col(f"_s_{n}")).alias(f"s_{n}") for n in bounds])
