"""Contiguous shards with the smallest largest shard.

Equal texts are one atomic group; groups are ordered by their digest. The
smallest capacity at which that many contiguous shards hold everything is found
by binary search, each try filling shards greedily. Only sums of buckets (runs
of digests by leading bits) reach the driver, and the groups of the few buckets
in which cuts can lie; both grow with the square root of the groups.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, running_start, small, text_or_empty

SHARDS = 8
MOST_BITS = 20


def bucket_bits(groups: int) -> int:
    return min(MOST_BITS, max(4, math.ceil(math.log2(groups + 1) / 2) + 3))


class Groups:
    """Running totals over ordered groups: by bucket on the driver, within a bucket fetched when asked for."""

    def __init__(self, table: DataFrame, bits: int):
        self.table = table
        sums = {r["bucket"]: (r["bytes"], r["most"]) for r in table.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).collect()}
        self.before = [0]
        for b in range(1 << bits):
            self.before.append(self.before[-1] + sums.get(b, (0, 0))[0])
        self.total, self.most = self.before[-1], max((m for _, m in sums.values()), default=0)
        self.ends: dict[int, list[int]] = {}
        self.digests: dict[int, list[bytes]] = {}

    def bucket_at(self, position: int) -> int:
        """The bucket of the group that begins or lies across this position."""
        return min(bisect_right(self.before, position) - 1, len(self.before) - 2)

    def fetch(self, buckets: set[int]) -> None:
        buckets = buckets - self.ends.keys()
        if not buckets:
            return
        for b in buckets:
            self.ends[b], self.digests[b] = [], []
        for r in self.table.filter(F.col("bucket").isin(*buckets)).orderBy("digest").select("bucket", "digest", "bytes").collect():
            own = self.ends[r["bucket"]]
            own.append((own[-1] if own else self.before[r["bucket"]]) + r["bytes"])
            self.digests[r["bucket"]].append(bytes(r["digest"]))

    def last_end(self, limit: int) -> tuple[int, tuple[int, int]]:
        """The largest end of a group that is at most limit, and its bucket and place in it
        (place -1: all groups before the bucket)."""
        if limit >= self.total:
            return self.total, (len(self.before) - 1, -1)
        b = self.bucket_at(limit)
        self.fetch({b})
        i = bisect_right(self.ends[b], limit) - 1
        return (self.ends[b][i] if i >= 0 else self.before[b]), (b, i)

    def fill(self, capacity: int, shards: int) -> list[tuple[int, tuple[int, int]]]:
        out, at = [], 0
        for _ in range(shards):
            out.append(self.last_end(at + capacity))
            at = out[-1][0]
        return out

    def coarse(self, capacity: int, shards: int) -> list[int]:
        """Ends that cut only between buckets: what is feasible so is feasible."""
        at, out = 0, []
        for _ in range(shards):
            at = max(at, self.before[bisect_right(self.before, at + capacity) - 1])
            out.append(at)
        return out


def smallest(feasible, low: int, high: int) -> int:
    """The least value in [low, high] that is feasible; high is, and so is all above a feasible one."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def minimax_cuts(groups: Groups, shards: int) -> list[bytes]:
    """The last digest of each shard but the last; b"" for a shard that is empty from the start."""
    if not groups.total:
        return [b""] * (shards - 1)
    low = max(groups.most, -(-groups.total // shards))
    high = smallest(lambda c: groups.coarse(c, shards)[-1] >= groups.total, low, groups.total)
    near, far = groups.coarse(low, shards), [min(groups.total, (i + 1) * high) for i in range(shards)]
    likely = {b for a, z in zip(near, far, strict=True) for b in range(groups.bucket_at(a), groups.bucket_at(z) + 1)}
    if len(likely) <= 64 * shards:
        groups.fetch(likely)
    best = smallest(lambda c: groups.fill(c, shards)[-1][0] >= groups.total, low, high)
    cuts = []
    for _, (b, i) in groups.fill(best, shards)[:-1]:
        while i < 0 and b > 0:  # the last group of an earlier bucket
            b -= 1
            groups.fetch({b})
            i = len(groups.digests[b]) - 1
        cuts.append(groups.digests[b][i] if i >= 0 else b"")
    return cuts


def shard_of(digest: Column, cuts: list[bytes]) -> Column:
    out = F.lit(0)
    for cut in cuts:
        out = out + (digest > F.lit(cut)).cast("int")
    return out


def _count_along(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        place = np.zeros(len(shard), dtype=np.int64)
        for s in np.unique(shard):
            own = np.flatnonzero(shard == s)
            place[own] = seen.get(s, 0) + np.arange(len(own))
            seen[s] = seen.get(s, 0) + len(own)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shard), part)), pa.array(place)], [*batch.schema.names, "part", "place"])


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, list[bytes]]:
    """Placements and cuts.

    Placements: a row for each row of docs with the key, size (UTF-8 bytes plus
    one), text_crc32, digest, shard and slot, gapless from 0 in its shard. Cuts:
    with shard_of they tell the shard of any digest, so that texts can be written
    by shard without a join. Equal texts share a shard; a null text counts as
    empty; rows without a key are placed like others. A group larger than the
    fair share makes the capacity, and later shards may stay empty. An empty
    table gives no rows.
    """
    body = text_or_empty(text)
    rows = durable(
        docs.select(
            F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("digest")
        ), "sizes"
    )
    grouped = durable(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "groups")
    bits = bucket_bits(grouped.count())
    bucket = F.shiftright(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), 32 - bits).cast("int")
    cuts = minimax_cuts(Groups(grouped.withColumn("bucket", bucket), bits), shards)
    dealt = rows.withColumn("shard", shard_of(F.col("digest"), cuts))
    schema = f"{', '.join(f'`{n}` {t}' for n, t in dealt.dtypes)}, part long, place long"
    placed = durable(dealt.mapInArrow(_count_along, schema), "placed")
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    starts = durable(running_start(counts, ["shard"], "part", "n", "before").drop("n"), "starts")
    out = placed.join(small(starts, starts.count()), ["shard", "part"]).withColumn("slot", F.col("before") + F.col("place"))
    return out.select(key, "size", "text_crc32", "digest", "shard", "slot"), cuts
