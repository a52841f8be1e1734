"""Near duplicates by one-permutation MinHash, banded buckets and star-shaped edges.

A text is the set of its distinct hashed word shingles. One hash deals the
shingles into BINS bins, each bin keeps its minimum, and an empty bin copies the
minimum of the first non-empty bin in a probe order of its own (optimal
densification), so bins agree with the probability of the sets' similarity.
Runs of ROWS bins make a bucket key.

Texts with equal sets are one class and only classes go into buckets. A bucket
links its members to one hub, not to each other, so its pairs grow with its
size. Every edge is confirmed on the full sets. Where the members of a bucket do not
all end up in one component, each one outside its largest component becomes a
hub too: no pair of different components that shares a bucket is left out, but
for those whose odd sketches (parities of their hashed shingles) rule a link out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.graph import contract

from .common import durable, small, text_batches, text_or_empty
from .tokens import blocks, few_words, mix, portions, span_hashes, windows, word_bounds

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: 512 bins in 73 runs of 7: at a similarity of 0.75 a pair agrees in none once in 30,000,
#: and texts that only share a passage rarely meet.
BINS, ROWS = 512, 7
BANDS = BINS // ROWS
#: Bits of an odd sketch, and by how many standard deviations it must miss for a pair to be passed over.
SKETCH_BITS, DEVIATIONS = 4096, 6
_BITS = 9
_PROBES = np.random.Generator(np.random.PCG64(77)).integers(0, BINS, (4096, BINS), dtype=np.int16)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
_FOLD = mix(np.arange(1001, 1001 + ROWS, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array | pa.ChunkedArray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; one for all the words if
    they are fewer than `size`, none without words."""
    for _, data, offsets in blocks(column):
        starts, ends, first = word_bounds(data, offsets)
        words = span_hashes(data, starts, ends)
        runs, at = windows(words, first, size)
        for i in range(len(offsets) - 1):
            n = first[i + 1] - first[i]
            if n >= size:
                yield np.unique(runs[at[i] : at[i + 1]])
            elif n:
                yield np.array([few_words(words[first[i] : first[i + 1]])], dtype=np.uint64)
            else:
                yield np.zeros(0, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """BINS minima of a sorted, non-empty set."""
    dealt = np.sort(mix(shingles))
    bins = (dealt >> np.uint64(64 - _BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out, full = np.zeros(BINS, dtype=np.uint64), np.zeros(BINS, dtype=bool)
    out[bins[first]], full[bins[first]] = dealt[first], True
    open_ = np.flatnonzero(~full)
    for probe in _PROBES:
        if not len(open_):
            break
        source = probe[open_]
        hit = full[source]
        out[open_[hit]] = out[source[hit]]
        open_ = open_[~hit]
    if len(open_):
        out[open_] = dealt[0]
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    runs = minima[: BANDS * ROWS].reshape(BANDS, ROWS)
    return mix((runs * _FOLD).sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity bits: those of two sets differ where their symmetric difference falls an odd number of times."""
    odd = np.bincount((mix(shingles) >> np.uint64(20)).astype(np.int64) & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _differ(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))


def may_link(n: str, m: str, a: str, b: str) -> Column:
    """False only if the sizes or the sketches a and b of sets of n and m shingles rule a link out.

    A link allows a symmetric difference d of at most (n + m) (100 - PERCENT) / (100 + PERCENT). The
    bits that differ then have a known mean and variance, from d balls in that many bins."""
    bits = float(SKETCH_BITS)
    d = (F.col(n) + F.col(m)) * (100 - PERCENT) / float(100 + PERCENT)
    mean = bits / 2 * (1 - F.exp(-2 * d / bits))
    spread = F.sqrt(bits / 4 * (1 - F.exp(-4 * d / bits)) - d * F.exp(-4 * d / bits) + 0.1)
    return _close_enough(n, m) & (_differ(a, b) <= mean + DEVIATIONS * spread + 2)


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    for batch in portions(batches):
        sizes, keys, bands = [], [], []
        for s in shingle_sets(batch.column("text")):
            sizes.append(len(s))
            keys.append(_key(s))
            bands.append(band_keys(signature(s)) if len(s) else None)
        rows = pa.array(range(row, row + len(sizes)), pa.int64())
        row += len(sizes)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), rows, pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "digest", "row", "n", "set_key", "bands"])


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        sets = list(shingle_sets(batch.column("text")))
        keys, odd = pa.array([_key(s) for s in sets], pa.binary()), pa.array([odd_sketch(s) for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([keys, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), odd], ["set_key", "shingles", "odd"])


def confirm(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the edges (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("_b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    similar = 100 * shared >= PERCENT * (F.size("sa") + F.size("sb") - shared)
    return edges.join(left, "a").join(right, (F.col("b") == F.col("_b")) & similar).select("a", "b")


def _merge(pairs: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """roots (node, root), after the links among the pairs (a, b, ra, rb, far) have joined components; ra and rb
    are the different roots of a and b.

    Of the pairs between two components the least far one is confirmed first. The others
    are looked at only where that has not joined the two."""

    def over(rows: DataFrame) -> DataFrame:
        links = confirm(rows.select("a", "b"), sets).join(rows, ["a", "b"])
        return durable(contract(links.select(F.col("ra").alias("x"), F.col("rb").alias("y"))).select("node", F.col("root").alias("over")), "joined-roots")

    def moved(rows: DataFrame, by: DataFrame, c: str) -> DataFrame:
        return rows.join(by.withColumnRenamed("node", c), c, "left").withColumn(c, F.coalesce("over", c)).drop("over")

    first = durable(pairs.groupBy("ra", "rb").agg(F.min(F.struct("far", "a", "b")).alias("x")).select("ra", "rb", "x.a", "x.b"), "first-pairs")
    joined = over(first)
    apart = first.select("ra", "rb", F.col("ra").alias("r"), F.col("rb").alias("s"))
    apart = moved(moved(apart, joined, "r"), joined, "s").filter("r <> s").select("ra", "rb", F.col("r"), F.col("s"))
    rest = pairs.join(apart, ["ra", "rb"]).join(first.select("a", "b"), ["a", "b"], "left_anti")
    again = over(durable(rest.select("a", "b", F.col("r").alias("ra"), F.col("s").alias("rb")), "other-pairs"))
    return durable(moved(moved(roots, joined, "root"), again, "root").select("node", "root"), "roots")


def _close_enough(n: str, m: str) -> Column:
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _judged(docs: DataFrame, text: str, key: str, digest: Column) -> DataFrame:
    """doc_id, digest, n, component_id and kept for each row of docs, as near_duplicates says."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), digest.cast("binary").alias("digest"))
    sketches = durable(text_batches(rows).mapInArrow(_sketch, "doc_id long, digest binary, row long, n long, set_key binary, bands array<long>"), "sketches")
    full = sketches.filter("n > 0 AND doc_id IS NOT NULL")
    classes = durable(
        full.groupBy("set_key").agg(F.min("doc_id").alias("first_id"), F.min("row").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes"
    )
    members = classes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    hubs = members.groupBy("bucket").agg(F.min("node").alias("hub"), F.min_by("n", "node").alias("hub_n"), F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size")
    met = durable(members.join(hubs, "bucket").select("bucket", "band", "node", "n", "hub", "hub_n"), "met")
    # Buckets of the same members say the same: the one of the lowest band stands for all.
    whose = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"who{i}") for i in range(2)]
    alike = met.groupBy("bucket").agg(F.first("band").alias("band"), F.count(F.lit(1)).alias("size"), *whose).groupBy("size", "who0", "who1")
    stand = alike.agg(F.min_by("bucket", "band").alias("bucket"), F.count(F.lit(1)).alias("times"))
    crowded = durable(met.join(stand.select("bucket", "times"), "bucket"), "buckets")
    named = durable(classes.join(crowded.select("node").distinct(), "node", "left_semi").select("node", "set_key", "first_id", "bands"), "candidates")
    ids = named.select(F.col("first_id").alias("doc_id")).distinct()
    texts = rows.join(small(ids, ids.count()), "doc_id", "left_semi").select("text")
    sets = texts.mapInArrow(_sets, "set_key binary, shingles array<long>, odd array<long>").dropDuplicates(["set_key"]).join(named, "set_key")
    runs = F.transform("bands", lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"))
    sets = durable(sets.select("node", "shingles", "odd", runs.alias("runs")), "sets")
    roots = named.select("node", F.col("node").alias("root"))
    # A member's edge to the hub that it meets most often comes first; the others matter only where that has not joined them.
    stars = crowded.filter((F.col("node") != F.col("hub")) & _close_enough("n", "hub_n")).groupBy(F.col("hub").alias("a"), F.col("node").alias("b")).agg(F.sum("times").alias("times"))
    stars = durable(stars, "stars")
    most = durable(stars.groupBy("b").agg(F.max_by("a", F.struct("times", -F.col("a"))).alias("a")).select("a", "b"), "most-met")
    roots = _merge(most.select("a", "b", F.col("a").alias("ra"), F.col("b").alias("rb"), F.lit(0).alias("far")), sets, roots)
    rest, at = stars.join(most, ["a", "b"], "left_anti"), {c: roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"}
    rest = durable(rest.join(at["a"], "a").join(at["b"], "b").filter("ra <> rb").select("a", "b", "ra", "rb", (-F.col("times")).alias("far")), "other-stars")
    roots = _merge(rest, sets, roots)
    asked = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Where a bucket's members are still in several components, each outside of the largest meets all the others.
    placed = durable(crowded.select("bucket", "band", "node", "n").join(roots, "node"), "placed")
    parts = placed.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("size"))
    split = parts.groupBy("bucket").agg(F.max_by("root", F.struct("size", "root")).alias("major"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
    minor = placed.join(split, "bucket").filter("root <> major")
    sizes = minor.groupBy("bucket").agg(F.first("major").alias("major"), F.min("n").alias("least"), F.max("n").alias("greatest"))
    fits = (100 * F.col("n") >= PERCENT * F.col("least")) & (100 * F.col("greatest") >= PERCENT * F.col("n"))
    open_ = placed.join(sizes, "bucket").filter(fits).drop("least", "greatest")
    open_ = durable(open_.join(sets.select("node", "odd", "runs"), "node"), "open-buckets")
    hubs = open_.filter("root <> major").select("bucket", *[F.col(c).alias(f"hub_{c}") for c in ("node", "n", "root", "odd", "runs")])
    # A pair comes up once: in the first bucket that it shares, and there from its smaller node if both are hubs.
    before = F.slice(F.arrays_zip("runs", "hub_runs"), F.lit(1), F.col("band"))
    once = ((F.col("root") == F.col("major")) | (F.col("node") < F.col("hub_node"))) & ~F.exists(before, lambda x: x["runs"] == x["hub_runs"])
    apart = (F.col("o.bucket") == F.col("h.bucket")) & (F.col("root") != F.col("hub_root"))
    more = open_.alias("o").join(hubs.alias("h"), apart & may_link("n", "hub_n", "odd", "hub_odd") & once)
    swap = F.col("node") > F.col("hub_node")
    ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(c) for x, y, c in (("node", "hub_node", "a"), ("hub_node", "node", "b"), ("root", "hub_root", "ra"), ("hub_root", "root", "rb"))]
    more = more.select(*ends, _differ("odd", "hub_odd").alias("far")).dropDuplicates(["a", "b"])
    roots = _merge(durable(more.join(asked, ["a", "b"], "left_anti"), "more"), sets, roots)
    named_roots = classes.select("node", "set_key", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named_roots.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = named_roots.join(smallest, "root").select("set_key", "component_id")
    out = full.select("doc_id", "digest", "n", "set_key").join(found, "set_key", "left").select("doc_id", "digest", "n", "component_id")
    alone = sketches.filter("NOT (n > 0 AND doc_id IS NOT NULL)").select("doc_id", "digest", "n", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each row of docs: the key column, n_shingles, component_id and kept.

    Words are case-folded for A-Z only; a text of fewer than 5 words is one shingle, one
    without words (or null) has none and is alone. component_id is the smallest
    key that links lead to, its own included; kept tells the row with that key.
    Rows without a key take no part: component_id is null and kept is true. Rows
    that repeat a key are judged each by its own text. An empty table gives an
    empty result.
    """
    return _judged(docs, text, key, F.lit(None)).select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one document of each group of near duplicates, its own columns unchanged.

    Rows that repeat a key are dropped each by its own text."""
    digest = F.unhex(F.sha2(text_or_empty(text), 256))
    dropped = durable(_judged(docs, text, key, digest).filter("NOT kept").select(F.col("doc_id").alias("_dropped"), F.col("digest").alias("_digest")), "dropped")
    return docs.join(small(dropped, dropped.count()), (F.col(key) == F.col("_dropped")) & (digest == F.col("_digest")), "left_anti")
