"""A tree of summaries over each key's facts, from which a span between any two times is put together of few nodes.

Nodes of level 0 are WIDTH microseconds long, those of a level FAN times as long as those below. A node has the first and last fact, extremes, the longest
gap and the largest jump between neighbours in it. A span is cut at the times that matter (its start, its end, and where one of several nested
spans ends); a node in which no cut falls is taken whole, and facts are met only in the level-0 nodes around the cuts. An entry then meets a number of rows that
grows with the logarithm of its span, and all nested spans share them. Where a bound is first crossed is found by descent, a level a join.

Where entries are many too, spans of fixed lengths are put together of three summaries each: of the start's block (a node of level 0) behind the start, of the end's block up to
the end, and of the blocks between, which is the same for all entries of a block. Running sums give the first two, so an entry costs a few rows however dense the facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import MICROS
from tidemark.work import durable

WIDTH, FAN, LEVELS = 10 * MICROS, 8, 6


def _wide(level: int, width: int = WIDTH) -> int:
    return width * FAN**level


def _step(previous: Column, p: Column) -> Column:
    """The relative jump from one price to the next; null where it has none."""
    return F.when((previous > 0) & (p != 0), F.abs(p / previous - 1))


def as_items(facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Facts (by, at in microseconds, fact, p, l) as items: what a node has, of one fact."""
    one = F.struct("at", "fact", "p", "l")
    return facts.select(*by, one.alias("first"), one.alias("last"), F.lit(None).cast("long").alias("gap"), F.lit(None).cast("double").alias("jump"), F.col("p").alias("high"), F.col("p").alias("low"),
        F.when(F.col("p") != 0, F.col("p")).alias("low_nonzero"), F.col("l").alias("thin"), F.when(F.col("p").isNotNull(), F.struct((-F.col("p")).alias("down"), "at", "fact")).alias("peak"))


def with_neighbours(items: DataFrame, along: Sequence[str], before: Column | None = None) -> DataFrame:
    """items with the gap and jump from the item before in the same `along` taken in; before: the time, in microseconds, that the first one's gap is from."""
    w = Window.partitionBy(*along).orderBy("first.at", "first.fact")
    since = F.lag("last.at").over(w) if before is None else F.coalesce(F.lag("last.at").over(w), before)
    return items.withColumns({"gap": F.greatest("gap", F.col("first.at") - since), "jump": F.greatest("jump", _step(F.lag("last.p").over(w), F.col("first.p")))})


def summed() -> list[Column]:
    return [F.min("first").alias("first"), F.max("last").alias("last"), F.max("gap").alias("gap"), F.max("jump").alias("jump"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.min("low_nonzero").alias("low_nonzero"), F.min("thin").alias("thin"), F.min("peak").alias("peak")]


def build(facts: DataFrame, by: Sequence[str], width: int = WIDTH) -> DataFrame:
    """by, level, node and the summary of every node that has facts, all levels. To be written before it is used more than once."""
    items, out = as_items(facts, by), None
    for level in range(LEVELS):
        placed = items.withColumn("node", F.floor(F.col("first.at") / _wide(level, width)))
        items = with_neighbours(placed, [*by, "node"]).groupBy(*by, "node").agg(*summed())
        named = items.withColumn("level", F.lit(level))
        out = named if out is None else out.unionByName(named)
        items = items.drop("node")
    return out


def cover(entries: DataFrame, nodes: DataFrame, facts: DataFrame, by: Sequence[str], start: str, cuts: Column) -> DataFrame:
    """entries with the items of (start, last of cuts], nodes and facts, with level (-1 for a fact) and node. No cut lies within a node.

    start and cuts are in microseconds; cuts are bounded in number."""
    points = F.array_sort(F.array_distinct(F.concat(F.array(F.col(start)), cuts)))
    e = entries.withColumn("_points", points).withColumn("_end", F.element_at("_points", -1))
    at = lambda level: F.array_distinct(F.transform("_points", lambda x: F.floor(x / _wide(level))))
    first, last = (lambda level: F.floor(F.col(start) / _wide(level))), (lambda level: F.floor(F.col("_end") / _wide(level)))
    top = LEVELS - 1
    inside = lambda xs, level: F.filter(xs, lambda x: (x > first(level)) & (x < last(level)))
    named = lambda xs, level: F.transform(inside(F.array_except(xs, at(level)), level), lambda x: F.struct(F.lit(level).alias("level"), x.alias("node")))
    parts = [named(F.sequence(first(top), last(top)), top)]
    for level in range(top):
        below = F.flatten(F.transform(at(level + 1), lambda x: F.sequence(x * FAN, x * FAN + FAN - 1)))
        parts.append(named(below, level))
    whole = e.withColumn("_n", F.explode(F.concat(*parts))).select("*", F.col("_n.level").alias("level"), F.col("_n.node").alias("node")).drop("_n")
    whole = whole.join(nodes, [*by, "level", "node"])
    own = as_items(facts, by).withColumn("node", F.floor(F.col("first.at") / WIDTH))
    single = e.withColumn("node", F.explode(at(0))).join(own, [*by, "node"]).filter((F.col("first.at") > F.col(start)) & (F.col("first.at") <= F.col("_end"))).withColumn("level", F.lit(-1))
    return whole.unionByName(single).drop("_points", "_end")


def crosses(bound: Column, above: Column, nonzero: bool = False) -> Column:
    return F.when(above, F.col("high") >= bound).otherwise(F.col("low_nonzero" if nonzero else "low") <= bound)


def descend(asked: DataFrame, nodes: DataFrame, facts: DataFrame, by: Sequence[str], width: int = WIDTH) -> DataFrame:
    """asked without level and node, with at: the time of the first fact of the node that crosses the bound.

    asked: by, bound, above, level (not -1), node, and columns that tell its rows apart."""
    keep = [c for c in asked.columns if c not in ("level", "node")]
    for level in range(LEVELS - 1, 0, -1):
        here = asked.filter(F.col("level") == level).withColumn("child", F.explode(F.sequence(F.col("node") * FAN, F.col("node") * FAN + FAN - 1))).drop("node", "level")
        lower = nodes.filter(F.col("level") == level - 1).select(*by, F.col("node").alias("child"), "high", "low", "low_nonzero")
        found = here.join(lower, [*by, "child"]).filter(crosses(F.col("bound"), F.col("above"))).groupBy(*keep).agg(F.min("child").alias("node")).withColumn("level", F.lit(level - 1))
        asked = asked.filter(F.col("level") < level).unionByName(found)
    own = facts.select(*by, "at", "fact", F.col("p").alias("high"), F.col("p").alias("low"), F.floor(F.col("at") / width).alias("node"))
    return asked.join(own, [*by, "node"]).filter(crosses(F.col("bound"), F.col("above"))).groupBy(*keep).agg(F.min("at").alias("at"))


def pieces(entries: DataFrame, facts: DataFrame, by: Sequence[str], start: str, limits: Sequence[int], begins: Sequence[int], width: int) -> DataFrame:
    """by, start, block, e (a struct of the other columns of entries) and pieces: a struct (i, x) for each mark in order, x the summary of facts, null for none.

    Mark 0: facts of the start's block after it. Marks 1 and on: of the block in which start + limit lies, up to there. The rest: of that in which start + begin lies, from there on.
    start is in microseconds and told apart by it in a key; limits and begins are in microseconds, multiples of width. Facts are moved back by each mark, so that all that an entry
    needs is in one block, and running sums along it serve all entries of the block."""
    marks = [(0, True, -1), *((x, False, 1) for x in limits), *((x, True, 1) for x in begins)]
    mark = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(x).cast("long").alias("off"), F.lit(back).alias("back"), F.lit(tie).alias("tie")) for i, (x, back, tie) in enumerate(marks)]))
    others = [c for c in entries.columns if c not in (*by, start)]
    f = facts.select(*by, "at", "fact", "p", "l", mark.alias("m")).select(*by, "m.i", "m.back", F.lit(0).alias("tie"), (F.col("at") - F.col("m.off")).alias("t"), "at", "fact", "p", "l")
    e = entries.select(*by, F.col(start).alias("t"), F.struct(*others).alias("e"), mark.alias("m")).select(*by, "m.i", "m.back", "m.tie", "t", F.when(F.col("m.i") == 0, F.col("e")).alias("e"))
    rows = f.unionByName(e, allowMissingColumns=True).withColumn("block", F.floor(F.col("t") / width)).repartition(*by, "block")
    back, told = F.col("back"), F.col("tie") == 0
    rows = rows.withColumn("one", F.when(told, F.struct("at", "fact", "p", "l")))
    w = Window.partitionBy(*by, "block", "i").orderBy(F.when(back, -F.col("t")).otherwise(F.col("t")), "tie", F.when(~back, F.col("fact")).asc(), F.when(back, F.col("fact")).desc())
    along = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("near", F.last("one", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumns({"gap": F.abs(F.col("at") - F.col("near.at")), "jump": F.when(back, _step(F.col("p"), F.col("near.p"))).otherwise(_step(F.col("near.p"), F.col("p")))})
    p, lo, hi = F.col("p"), F.first("one", ignorenulls=True).over(along), F.last("one", ignorenulls=True).over(along)
    peak = F.when(p.isNotNull(), F.struct((-p).alias("down"), "at", "fact"))
    rows = rows.withColumns({"_lo": lo, "_hi": hi, "_gap": F.max("gap").over(along), "_jump": F.max("jump").over(along), "_high": F.max("p").over(along), "_low": F.min("p").over(along),
        "_low_nonzero": F.min(F.when(p != 0, p)).over(along), "_thin": F.min("l").over(along), "_peak": F.min(peak).over(along)}).filter(~told)
    x = F.struct(F.when(back, F.col("_hi")).otherwise(F.col("_lo")).alias("first"), F.when(back, F.col("_lo")).otherwise(F.col("_hi")).alias("last"),
        *[F.col(f"_{c}").alias(c) for c in ("gap", "jump", "high", "low", "low_nonzero", "thin", "peak")])
    each = rows.select(*by, "block", F.col("t").alias(start), "e", F.struct("i", F.when(F.col("_lo").isNotNull(), x).alias("x")).alias("piece"))
    return each.groupBy(*by, "block", start).agg(F.first("e", ignorenulls=True).alias("e"), F.sort_array(F.collect_list("piece")).alias("pieces"))


def _within(a: Column, b: Column) -> Column:
    """The fewest nodes (level, node) that make up the blocks from a to b."""
    seq = lambda x, y: F.when(x <= y, F.sequence(x, y)).otherwise(F.array().cast("array<bigint>"))
    low, high = (lambda level: F.ceil(a / FAN**level)), (lambda level: F.floor((b + 1) / FAN**level) - 1)
    named = lambda xs, level: F.transform(xs, lambda x: F.struct(F.lit(level).alias("level"), x.alias("node")))
    parts = []
    for level in range(LEVELS):
        all_ = seq(low(level), high(level))
        if level < LEVELS - 1:
            sides = F.concat(seq(low(level), low(level + 1) * FAN - 1), seq((high(level + 1) + 1) * FAN, high(level)))
            all_ = F.when(low(level + 1) <= high(level + 1), sides).otherwise(all_)
        parts.append(named(all_, level))
    return F.concat(*parts)


def between(blocks: DataFrame, nodes: DataFrame, by: Sequence[str], spans: Sequence[tuple[int, int]], listed: int) -> DataFrame:
    """blocks (by, block) with sums, a map from the number of a span to the summary of its facts, and cover: the nodes of span `listed` in order.

    A span has the blocks from block + its first number to block + its second. Blocks are few beside entries where facts are dense, as each is asked for once. Blocks without any fact behind them are left out."""
    asked = F.array(*[F.struct(F.lit(i).alias("i"), (F.col("block") + a).alias("a"), (F.col("block") + b).alias("b")) for i, (a, b) in enumerate(spans) if a <= b])
    each = blocks.distinct().withColumn("_s", F.explode(asked)).select(*by, "block", F.col("_s.i").alias("i"), F.explode(_within(F.col("_s.a"), F.col("_s.b"))).alias("n"))
    met = each.select(*by, "block", "i", "n.level", "n.node").join(nodes, [*by, "level", "node"]).repartition(*by, "block")
    in_order = F.collect_list(F.when(F.col("i") == listed, F.struct(F.col("first.at").alias("start"), "level", "node", "high", "low")))
    one = with_neighbours(met, [*by, "block", "i"]).groupBy(*by, "block", "i").agg(*summed(), F.sort_array(in_order).alias("cover"))
    x = F.struct("first", "last", "gap", "jump", "high", "low", "low_nonzero", "thin", "peak")
    return one.groupBy(*by, "block").agg(F.map_from_entries(F.collect_list(F.struct("i", x.alias("x")))).alias("sums"), F.flatten(F.collect_list("cover")).alias("cover"))


def joined(s: Column, b: Column, p: Column, since: Column) -> dict[str, Column]:
    """What a span has of which s, b and p are the summaries, in order, each null if it has no fact; its first gap is from since."""
    has = lambda c: [x[c] for x in (s, b, p)]
    before = F.coalesce(b["last"], s["last"])
    return {
        "gap": F.greatest(F.coalesce(*has("first"))["at"] - since, b["first"]["at"] - s["last"]["at"], p["first"]["at"] - before["at"], *has("gap")),
        "jump": F.greatest(_step(s["last"]["p"], b["first"]["p"]), _step(before["p"], p["first"]["p"]), *has("jump")),
        "high": F.greatest(*has("high")), "low": F.least(*has("low")), "low_nonzero": F.least(*has("low_nonzero")), "thin": F.least(*has("thin")),
        "last": F.coalesce(*reversed(has("last"))), "peak": F.least(*has("peak")),
    }


def first_crossings(entries: DataFrame, cover: DataFrame, nodes: DataFrame, facts: DataFrame, by: Sequence[str], start: str, base: Column, limit: int, multiples: Sequence[float], width: int) -> DataFrame:
    """by, start and, for the k-th multiple, x<k>: the time of the first fact in (start, start + limit] that crosses base * multiple; entries without any may be left out.

    base: null where nothing counts as crossing. cover: of between(), for the blocks from the one after the start's to the one before that of the end."""
    e = entries.select(*by, start, base.alias("_base"), F.floor(F.col(start) / width).alias("block"))
    own = facts.select(*by, "at", F.col("p"), F.floor(F.col("at") / width).alias("node"))
    cuts = F.array(F.struct(F.lit(False).alias("end"), F.col("block").alias("node")), F.struct(F.lit(True).alias("end"), (F.col("block") + limit // width).alias("node")))
    at_cuts = e.select(*by, start, "_base", F.explode(cuts).alias("c")).select(*by, start, "_base", "c.end", "c.node").join(own, [*by, "node"])
    at_cuts = at_cuts.filter(F.when(F.col("end"), F.col("at") <= F.col(start) + limit).otherwise(F.col("at") > F.col(start)))
    hit = lambda m: (F.col("p") >= F.col("_base") * m) if m > 1 else (F.col("p") <= F.col("_base") * m)
    near = at_cuts.groupBy(*by, start).agg(*[F.min(F.when(hit(m) & (F.col("end") == end), F.col("at"))).alias(f"{'p' if end else 's'}{k}") for k, m in enumerate(multiples) for end in (False, True)])
    met = e.join(near, [*by, start], "left").join(cover.select(*by, "block", "cover"), [*by, "block"], "left")
    crossing = lambda m: F.try_element_at(F.filter("cover", lambda n: (n["high"] >= F.col("_base") * m) if m > 1 else (n["low"] <= F.col("_base") * m)), F.lit(1))
    found = durable(met.select(*by, start, "_base", *[f"{x}{k}" for k in range(len(multiples)) for x in "sp"], *[F.when(F.col(f"s{k}").isNull(), crossing(m)).alias(f"n{k}") for k, m in enumerate(multiples)]), "path-crossings")
    each = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m > 1).alias("above"), (F.col("_base") * m).alias("bound"), F.col(f"n{k}.level").alias("level"), F.col(f"n{k}.node").alias("node")) for k, m in enumerate(multiples)])
    asked = found.select(*by, start, F.explode(F.filter(each, lambda x: x["level"].isNotNull())).alias("x")).select(*by, start, "x.*")
    deep = descend(asked, nodes, facts, by, width).groupBy(*by, start).agg(*[F.min(F.when(F.col("k") == k, F.col("at"))).alias(f"d{k}") for k in range(len(multiples))])
    return found.join(deep, [*by, start], "left").select(*by, start, *[F.coalesce(f"s{k}", f"d{k}", f"p{k}").alias(f"x{k}") for k in range(len(multiples))])
