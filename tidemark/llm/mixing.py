"""Mixing sources to target weights, with built-in functions only.

Sizes are summed by source. The sources share the total by weight, no source
above CAP times its own size, and what a capped source can't take is shared
among the rest by weight. A source's repetition rate is its target over its
size; each document is taken floor(rate) times, and once more with a probability equal to the fraction.

The extra copies are drawn systematically. A source's documents stand in order of size; where the running
number of documents times the fraction, moved by an offset that a hash of the source gives, passes a whole number, a copy is due. Among
documents of one size the smallest hashes of their keys get the copies due there. So every document has the
probability, and the words that a source gives miss its target by no more than its largest document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, small

WEIGHTS = (5, 2, 1)
CAP = 3
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def hashed(key: Column, seed: str, digits: int) -> Column:
    """A number of so many hexadecimal digits that only the key and the seed decide."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), key.cast("string")).cast("binary")), 1, digits), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size and target of a table of source and size; a row for each source.

    A source takes min(cap * size, level * weight), where one level makes the
    targets add up to the whole. Ordered by cap * size / weight, the capped
    sources come first; the level follows from sums before and after each place.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    by = by.withColumn("weight", weight)
    up = Window.partitionBy(F.lit(0)).orderBy((F.col("source_size") * cap / F.col("weight")), F.col("source").asc_nulls_last())
    before, here_on = up.rowsBetween(Window.unboundedPreceding, -1), up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    # Level if this source and all after it are not capped; the right one is the first that caps none of these.
    by = by.withColumn("level", (F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(here_on))
    by = by.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= cap * F.col("source_size"), F.struct(F.col("source_size") * cap / F.col("weight"), F.col("level")))).over(whole)["level"])
    return by.select("source", "source_size", F.least(F.col("level") * F.col("weight"), (cap * F.col("source_size")).cast("double")).alias("target"))


def _extra_copies(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """For each source and size of the rows (source, size, hash): source_size, target, copies of each document (base),
    documents (n), extra copies due (due) and, where only some get one, the largest hash that does (last)."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    fraction = F.col("rate") - F.floor("rate")
    offset = hashed(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")), seed, 8).cast("double") / float(1 << 32)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    groups = groups.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).withColumns({"rate": rate, "start": before})
    passed = lambda n: F.floor(fraction * n + offset)
    groups = durable(
        groups.select("source", "size", "source_size", "target", F.floor("rate").alias("base"), "n", (passed(F.col("start") + F.col("n")) - passed(F.col("start"))).alias("due")), "sizes"
    )
    some = groups.filter("due > 0 AND due < n").select(F.col("source").alias("s"), F.col("size").alias("z"), "due")
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    part = F.shiftright("hash", 48)
    open_ = durable(rows.join(small(some, some.count()), same).select("s", "z", "due", "hash", part.alias("part")), "open-sizes")
    parts = open_.groupBy("s", "z", "due", "part").agg(F.count(F.lit(1)).alias("n"))
    lower = F.coalesce(F.sum("n").over(Window.partitionBy("s", "z").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = parts.withColumn("left", F.col("due") - lower).filter((F.col("left") > 0) & (F.col("left") <= F.col("n"))).select(F.col("s").alias("s2"), F.col("z").alias("z2"), F.col("part").alias("part2"), "left")
    inside = open_.join(small(cut, some.count()), F.col("s").eqNullSafe(F.col("s2")) & (F.col("z") == F.col("z2")) & (F.col("part") == F.col("part2")))
    ranked = inside.withColumn("rank", F.rank().over(Window.partitionBy("s", "z", "part").orderBy("hash"))).filter("rank <= left")
    last = ranked.groupBy("s", "z").agg(F.max("hash").alias("last"))
    return durable(groups.join(last, same, "left").drop("s", "z"), "mix")


def mixing_plan(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = "mix") -> DataFrame:
    """docs with size, source_size, target and copies.

    A document without words has size 0 and is taken as often as its source's
    rate says; sources of size 0 have target 0 and give no copies. The null source
    is a source like others. Rows without a key share one draw for each source and size.
    Rows that repeat a key and a size share its draw; each such row counts, so a source may then stray by as many. An
    empty table gives an empty result. Columns of docs by the added names are replaced.
    """
    docs = docs.drop("size", "source_size", "target", "copies").withColumn("size", words(text))
    identity = F.coalesce(F.col(key).cast("string"), F.concat_ws(":", F.lit("none"), F.col(source), F.col("size")))
    rows = durable(docs.select(F.col(source).alias("source"), "size", hashed(identity, seed, 15).alias("hash")), "sizes-of-documents")
    targets = durable(source_targets(rows, weights, cap), "targets")
    plan = _extra_copies(rows, small(targets, targets.count()), seed).withColumnsRenamed({"source": "_source", "size": "_size"})
    planned = docs.join(small(plan, plan.count()), F.col(source).eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
    extra = F.when(F.col("due") == 0, 0).when(F.col("due") == F.col("n"), 1).when(hashed(identity, seed, 15) <= F.col("last"), 1).otherwise(0)
    return planned.withColumn("_copies", (F.col("base") + extra).cast("int")).select(*[F.col(f"`{c}`") for c in docs.columns], "source_size", "target", F.col("_copies").alias("copies"))


def mix_sources(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix itself: every document as many times as the plan says, its own columns unchanged, also
    those that bear names of the plan. Nulls, repeated keys and empty tables as in mixing_plan."""
    named = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), F.col(source).alias("_from"), F.col(text).alias("_text"))
    plan = mixing_plan(named, "_key", "_from", "_text", **options).filter("copies > 0")
    return plan.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
