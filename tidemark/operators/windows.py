"""Window and interval operators: latest per key, gaps, runs, unions and concurrency of intervals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cuts import any_hot, can_cut, hot_cuts, same, with_chunks, with_previous


def latest_per(df: DataFrame, by: Sequence[str], *order: str) -> DataFrame:
    """One row for each key, the largest by the order columns. A max of structs, so the
    shuffle carries one row for each key and task."""
    rest = [c for c in df.columns if c not in by and c not in order]
    return df.groupBy(*by).agg(F.max(F.struct(*order, *rest)).alias("_top")).select(*by, "_top.*").select(*df.columns)


def changed_only(df: DataFrame, scope: Sequence[str], content: Column, *order: str) -> DataFrame:
    """Rows whose content differs from that of the row before in their scope; first rows stay."""
    return with_previous(df.withColumn("_c", content), scope, order, "_c", "_p").filter(F.col("_p").isNull() | (F.col("_p") != F.col("_c"))).drop("_c", "_p")


def threshold_crossings(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str], thresholds: Sequence[float]) -> DataFrame:
    """A row for each threshold passed between consecutive values: up if prev < T <= now, down if prev >= T > now."""
    steps = with_previous(df, by, order, value, "_prev").filter(F.col("_prev").isNotNull())
    each = steps.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    up = (F.col("_prev") < F.col("threshold")) & (F.col("threshold") <= F.col(value))
    down = (F.col("_prev") >= F.col("threshold")) & (F.col("threshold") > F.col(value))
    return each.withColumn("direction", F.when(up, "up").when(down, "down")).filter("direction IS NOT NULL").drop("_prev")


def trailing_run(df: DataFrame, by: Sequence[str], sign: Column, *order: str) -> DataFrame:
    """For each row: how many rows up to it have its sign without a break; 0 for sign 0 or null.

    The line of a hot key is cut: runs are counted within chunks, and one that reaches to the start of its chunk adds what the chunks before it end with."""
    signed = df.withColumn("_s", F.coalesce(sign.cast("int"), F.lit(0)))
    hot = can_cut(df, order[0]) and any_hot(signed.select(*by, order[0]), by, order[0])
    cuts = hot_cuts(signed, by, order[0]) if hot else None
    cut = with_chunks(signed, cuts, by, order[0]) if hot else signed.withColumn("_chunk", F.lit(0))
    keys = [*by, "_chunk"]
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = cut.withColumn("_new", (F.col("_s") != F.lag("_s").over(w)).cast("int"))
    islands = changed.withColumn("_island", F.coalesce(F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    counted = islands.withColumn("_run", F.row_number().over(Window.partitionBy(*keys, "_island").orderBy(*order)))
    if hot:
        top = F.max(F.struct("_island", "_run", "_s"))
        ends = counted.join(F.broadcast(cuts.select(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(by)])), reduce(lambda x, y: x & y,
            [F.col(b).eqNullSafe(F.col(f"_k{i}")) for i, b in enumerate(by)]), "left_semi").groupBy(*keys).agg(top.alias("_e"))  # a row for each chunk of hot keys
        along = Window.partitionBy(*by).orderBy("_chunk")
        broken = (F.col("_e._island") > 0) | F.coalesce(F.lag("_e._s").over(along) != F.col("_e._s"), F.lit(True))
        group = ends.withColumn("_broken", broken.cast("int")).withColumn("_group", F.sum("_broken").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        tails = group.withColumn("_tail", F.sum("_e._run").over(Window.partitionBy(*by, "_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)))
        handed = tails.select(*keys, F.lag(F.struct("_e._s", "_tail")).over(along).alias("_h"))
        counted = counted.alias("c").join(F.broadcast(handed.alias("h")), same("c", "h", keys), "left").select("c.*", "h._h")
        more = F.when((F.col("_island") == 0) & (F.col("_h._s") == F.col("_s")), F.col("_h._tail")).otherwise(0)
        counted = counted.withColumn("_run", (F.col("_run") + more).cast("int")).drop("_h")
    return counted.withColumn("run_length", F.when(F.col("_s") == 0, 0).otherwise(F.col("_run"))).drop("_s", "_new", "_island", "_run", "_chunk")


def interval_union(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Merged intervals of each key: island start and end. Empty and backward intervals are left out.

    The line of a hot key is swept in chunks: each starts with how far the chunks before it reach and how many islands these begin."""
    known = df.filter(F.col(end) > F.col(start)).select(*by, F.col(start).alias("_s"), F.col(end).alias("_e"))
    if not any_hot(known.select(*by, "_s"), by, "_s"):
        w = Window.partitionBy(*by).orderBy("_s", "_e")
        flagged = known.withColumn("_new", F.coalesce((F.col("_s") > F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1)))
        islands = flagged.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return islands.groupBy(*by, "_island").agg(F.min("_s").alias("island_start"), F.max("_e").alias("island_end")).drop("_island")
    cuts = hot_cuts(known, by, "_s")
    cut = with_chunks(known, cuts, by, "_s")
    own = Window.partitionBy(*by, "_chunk").orderBy("_s", "_e")
    along = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = lambda table, alias, c: F.broadcast(table.filter("_chunk > 0").select(*by, "_chunk", c).alias(alias))
    reach = with_chunks(known, cuts, by, "_s", only_hot=True).groupBy(*by, "_chunk").agg(F.max("_e").alias("_m")).withColumn("_reach", F.max("_m").over(along))
    swept = cut.alias("c").join(first(reach, "r", "_reach"), same("c", "r", [*by, "_chunk"]), "left").select("c.*", "r._reach")
    before = F.greatest(F.max("_e").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reach"))
    flagged = swept.withColumn("_new", F.coalesce((F.col("_s") > before).cast("int"), F.lit(1)))
    begun = flagged.filter("_chunk > 0 OR _reach IS NOT NULL").groupBy(*by, "_chunk").agg(F.sum("_new").alias("_k"))
    zero = flagged.filter("_chunk = 0").groupBy(*by, "_chunk").agg(F.sum("_new").alias("_k")).alias("z").join(F.broadcast(cuts.alias("k")), same("z", "k", by), "left_semi")
    counted = begun.filter("_chunk > 0").unionByName(zero.select(*by, "_chunk", "_k")).withColumn("_islands", F.sum("_k").over(along))
    placed = flagged.alias("c").join(first(counted, "i", "_islands"), same("c", "i", [*by, "_chunk"]), "left").select("c.*", "i._islands")
    placed = placed.withColumn("_island", F.coalesce("_islands", F.lit(0)) + F.sum("_new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.groupBy(*by, "_island").agg(F.min("_s").alias("island_start"), F.max("_e").alias("island_end")).drop("_island")


def peak_concurrency(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Largest number of [start, end) intervals open at once, for each key; an end frees before a start of the same time.

    Steps of one time and direction are summed before the sweep, and that of a hot key goes in chunks, each from what is open where it starts."""
    steps = df.select(*by, F.col(start).alias("_t"), F.lit(1).alias("_d")).unionByName(df.select(*by, F.col(end).alias("_t"), F.lit(-1).alias("_d")))
    steps = steps.groupBy(*by, "_t", "_d").agg(F.sum("_d").alias("_n"))  # many intervals, few times
    if not any_hot(steps.select(*by, "_t"), by, "_t"):
        w = Window.partitionBy(*by).orderBy("_t", "_d").rowsBetween(Window.unboundedPreceding, 0)
        return steps.withColumn("_open", F.sum("_n").over(w)).groupBy(*by).agg(F.max("_open").cast("long").alias("peak"))
    cuts = hot_cuts(steps, by, "_t")
    cut = with_chunks(steps, cuts, by, "_t")
    along = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    left = with_chunks(steps, cuts, by, "_t", only_hot=True).groupBy(*by, "_chunk").agg(F.sum("_n").alias("_sum")).withColumn("_from", F.sum("_sum").over(along))
    begun = F.broadcast(left.select(*by, "_chunk", "_from").alias("b"))
    w = Window.partitionBy(*by, "_chunk").orderBy("_t", "_d").rowsBetween(Window.unboundedPreceding, 0)
    open_ = cut.withColumn("_open", F.sum("_n").over(w)).groupBy(*by, "_chunk").agg(F.max("_open").alias("_open"))
    joined = open_.alias("c").join(begun, same("c", "b", [*by, "_chunk"]), "left").select("c.*", (F.col("_open") + F.coalesce("_from", F.lit(0))).alias("_most"))
    return joined.groupBy(*by).agg(F.max("_most").cast("long").alias("peak"))


#: Spans that a chunk of a rolling sum is long: the share of rows that go to two chunks is one in so many.
CHUNK_SPANS = 8


def rolling_sum(df: DataFrame, by: Sequence[str], at_micros: str, value: Column, span_micros: int, name: str) -> DataFrame:
    """Sum over (t - span, t]: the lower end does not count.

    Keys are cut into chunks of CHUNK_SPANS spans; a row that a span of the next chunk reaches back to goes there too, to be summed only. A row
    without a time sums up those without one."""
    size = CHUNK_SPANS * span_micros
    chunk = lambda shift: F.floor((F.col(at_micros) + shift) / size)
    given = df.withColumn("_value", value)
    places = F.when(F.col(at_micros).isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.array_distinct(F.array(chunk(0), chunk(span_micros - 1))))
    each = given.withColumn("_own", chunk(0)).withColumn("_chunk", F.explode(places))
    w = Window.partitionBy(*by, "_chunk").orderBy(at_micros).rangeBetween(-(span_micros - 1), 0)
    return each.withColumn(name, F.sum("_value").over(w)).filter(F.col("_chunk").eqNullSafe(F.col("_own"))).drop("_value", "_own", "_chunk")
