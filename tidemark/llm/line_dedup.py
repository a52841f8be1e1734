"""Near-duplicate lines across documents by a deletion-neighbourhood join, with built-in functions only.

A line is dropped if an equal line stands earlier (by document key, then line number),
or, for lines of LEAST_CHARS characters or more, one within an edit distance of one. Two lines
are that close exactly if they agree after deleting at most one character from each. So each line emits a key
for every deletion, and equal keys join: (a) with the place of the deletion, lines that
differ by a substitution there; (b) without it, a line against whole lines
that are one character shorter. Either group is answered by its earliest member, so
keys are never paired with each other. Should unlike lines ever share a key, all earlier members
of that group are looked at instead, so no link is lost.

Keys are pairs of sums of 32-bit hashes of (character, place): running sums give those of all
deletions of a line in one pass, however long it is. Two exact filters come before: a
close line must share all of a line but one of 2, and then of 16, segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, small, text_or_empty

#: Shorter lines are only dropped for equal ones: an edit makes another line of them.
LEAST_CHARS = 24
#: Bits of each of the two hashes of a character that are summed up: no line is long enough for their sums to overflow.
_MASK = (1 << 32) - 1
_GROUP = ["size", "at", "key0", "key1"]
_LAST = (1 << 63) - 1
_WORD = r"[^\x20\x09-\x0D]"


def _segment_keys(line: Column, n: Column, segments: int) -> Column:
    """A key for each way to be one edit away within one segment, for the two lengths
    that the shorter one of a pair can have."""

    def keys(m: Column) -> Column:
        def one(j: Column) -> Column:
            a, b = F.floor(j * m / segments).cast("int"), F.floor((j + 1) * m / segments).cast("int")
            return F.xxhash64(m, j, F.left(line, a), F.right(line, m - b))

        return F.transform(F.sequence(F.lit(0), F.lit(segments - 1)), one)

    return F.concat(keys(n), keys(n - 1))


def _sharing(lines: DataFrame, name: str) -> DataFrame:
    """Ids of the lines (id, keys) that share a key with another one."""
    each = lines.select("id", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    return durable(each.join(shared, "key").select("id").distinct(), name)


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("doc"), text_or_empty(text).alias("_text")).withColumn("text_hash", F.xxhash64("_text"))
    each = rows.select("doc", "text_hash", F.posexplode(F.split("_text", "\n")).alias("number", "line")).withColumn("n", F.length("line"))
    return each.filter((F.col("n") >= LEAST_CHARS) | F.col("line").rlike(_WORD)).withColumn("id", F.unhex(F.md5(F.col("line").cast("binary"))))


def _variants(lines: DataFrame) -> DataFrame:
    """id, place, size, at, key0, key1 and whole: the keys of every deletion of each of the lines (id, line, n, place), with and without
    its place, and of the whole line."""
    chars = lines.select("id", "n", "place", F.posexplode(F.regexp_extract_all("line", F.lit("(?s)."), F.lit(0))).alias("i", "c"))
    along = Window.partitionBy("id").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = chars.select("id", "n", "place", "i", F.xxhash64("c", "i").alias("here"), F.xxhash64("c", F.col("i") - 1).alias("moved"))
    halves = {f"{c}{k}": F.shiftrightunsigned(c, 32 * k).bitwiseAND(F.lit(_MASK)) for c in ("here", "moved") for k in range(2)}
    sums = sums.select("id", "n", "place", "i", *[c.alias(name) for name, c in halves.items()])
    sums = sums.withColumns({f"{name}{k}": F.sum(f"{c}{k}").over(along) for name, c in (("before", "here"), ("after", "moved")) for k in range(2)})
    sums = sums.withColumns({f"all{k}": F.sum(f"moved{k}").over(Window.partitionBy("id")) for k in range(2)})
    without = [F.col(f"before{k}") - F.col(f"here{k}") + F.col(f"all{k}") - F.col(f"after{k}") for k in range(2)]

    def key(size: Column, at: Column, keys: list[Column], whole: bool) -> Column:
        return F.struct(size.alias("size"), at.alias("at"), keys[0].alias("key0"), keys[1].alias("key1"), F.lit(whole).alias("whole"))

    n, i = F.col("n"), F.col("i")
    each = F.array(key(n, i, without, False), key(n - 1, F.lit(-1), without, False), F.when(i == n - 1, key(n, F.lit(-1), [F.col("before0"), F.col("before1")], True)))
    return sums.select("id", "place", F.explode(F.filter(each, lambda v: v.isNotNull())).alias("v")).select("id", "place", "v.*")


def _close_pairs(lines: DataFrame) -> DataFrame:
    """(id, earlier) and their key: lines of distinct id, line, n and place of which the second is the earliest
    that has an equal key. To be verified."""
    group = Window.partitionBy(*_GROUP)
    own = F.struct("place", "id")
    keyed = _variants(lines).withColumns({"first_whole": F.min(F.when(F.col("whole"), own)).over(group), "first_part": F.min(F.when(~F.col("whole"), own)).over(group)})
    first = F.when((F.col("at") >= 0) | F.col("whole"), F.col("first_part")).otherwise(F.col("first_whole"))
    found = keyed.withColumn("first", first).filter((F.col("first.id") != F.col("id")) & (F.col("first.place") < F.col("place")))
    return found.select("id", F.col("first.id").alias("earlier"), *_GROUP)


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs, with close: whether they are within one edit."""
    left, right = lines.select("id", F.col("line").alias("a")), lines.select(F.col("id").alias("earlier"), F.col("line").alias("b"))
    return pairs.join(left, "id").join(right, "earlier").withColumn("close", F.levenshtein("a", "b", 1) >= 0).drop("a", "b")


def _close_lines(lines: DataFrame) -> DataFrame:
    """Ids of the lines (id, line, n, place) to which an earlier one is within one edit."""
    judged = durable(_verified(_close_pairs(lines), lines), "close-pairs")
    close = judged.filter("close").select("id").distinct()
    mixed = judged.filter("NOT close").select(*_GROUP).distinct()
    if mixed.isEmpty():
        return close
    members = durable(_variants(lines).join(mixed, _GROUP), "mixed-groups")
    other = members.select(*_GROUP, F.col("id").alias("earlier"), F.col("place").alias("sooner"), F.col("whole").alias("also_whole"))
    pairs = members.join(other, _GROUP).filter((F.col("sooner") < F.col("place")) & ((F.col("at") >= 0) | (F.col("whole") != F.col("also_whole"))))
    return close.union(_verified(pairs.select("id", "earlier").distinct(), lines).filter("close").select("id")).distinct()


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc (the key), text_hash and numbers, the sorted numbers (from 0) of the lines to
    drop, for each document that has any."""
    lines = _lines(docs, text, key)
    place = F.struct("doc", "number")
    keys = F.when(F.col("n") >= LEAST_CHARS, _segment_keys(F.col("line"), F.col("n"), 2))
    distinct = durable(
        lines.withColumn("keys", keys).groupBy("id").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("times"), F.first("n").alias("n"), F.first("keys").alias("keys")), "lines"
    )
    near = _sharing(distinct, "half-alike")
    texts = lines.join(small(near, near.count()), "id").groupBy("id").agg(F.first("line").alias("line"))
    texts = durable(texts.join(distinct.select("id", "n", "place"), "id"), "half-alike-lines")
    nearer = _sharing(texts.withColumn("keys", _segment_keys(F.col("line"), F.col("n"), 16)), "alike")
    alike = texts.join(small(nearer, nearer.count()), "id", "left_semi")
    close = _close_lines(alike)
    # Written, so that both sides of the last join come straight from a shuffle and a line of very many documents can be split.
    judged = distinct.select("id", "place", "times").join(close.withColumn("close", F.lit(True)), "id", "left")
    decided = durable(judged.filter("close OR times > 1").drop("times"), "decided-lines")
    drop = F.col("close").isNotNull() | (F.struct("doc", "number") != F.col("place"))
    dropped = lines.select("id", "doc", "text_hash", "number").join(decided, "id").filter(drop)
    return dropped.groupBy("doc", "text_hash").agg(F.array_sort(F.collect_set("number")).alias("numbers"))


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", clean: bool = True) -> DataFrame:
    """docs with n_lines and dropped_lines (numbers from 0); with clean, also clean_text
    without those lines.

    Lines are what newlines separate. Those under LEAST_CHARS characters are dropped for equal
    ones alone, and stay if they have no word. The
    earlier line need not stay itself, so a chain of close lines shrinks to its first. A null text is
    one empty line. Rows without a key come last; rows that repeat a key stand in the
    same place and drop no line of each other. An empty table gives an empty result. Columns of docs by
    the added names are replaced.
    """
    docs = docs.drop("n_lines", "dropped_lines", "clean_text")
    drops = repeated_lines(docs, text, key).select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"), "numbers")
    own = docs.columns if clean else [c for c in docs.columns if c != text]
    body = F.split(text_or_empty(text), "\n")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in own], F.size(body).cast("long").alias("n_lines"), F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("_at"), F.xxhash64(text_or_empty(text)).alias("_own")
    )
    out = rows.join(drops, (F.col("_at") == F.col("_doc")) & (F.col("_own") == F.col("_hash")), "left")
    out = out.withColumn("dropped_lines", F.coalesce("numbers", F.array().cast("array<int>")))
    if clean:
        kept = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(F.col("dropped_lines"), i))
        out = out.withColumn("clean_text", F.when(F.size("dropped_lines") > 0, F.array_join(kept, "\n")).otherwise(F.col(text)))
    return out.drop("_doc", "_hash", "_at", "_own", "numbers")
