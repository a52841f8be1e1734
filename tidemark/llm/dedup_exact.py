"""Exact dedup through a minimal perfect hash over historical digests.

The digests of the history are split by their leading bits into shards of
bounded size. Each shard gets a minimal perfect hash of its own (cascaded
collision-free bit levels), and a slot table that holds, at the slot of each
digest, the full digest and the locator of the winner. A lookup computes the
slot, compares the full digest byte by byte, and so tells members (repeats of
history) from nonmembers, which are grouped among themselves.

Hot texts are aggregated to one row before anything is looked up, so a text
held by a third of all rows is one key in one shard.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, small, text_or_empty

#: Digests a shard holds on average; a task builds one shard at a time.
SHARD_KEYS = 40_000
#: Bits for each key in a level of the hash.
GAMMA = 2.0
LEVELS = 48


def _words(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def _position(words: np.ndarray, level: int, size: int) -> np.ndarray:
    x = words[:, 1] + np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) * (words[:, 2] | np.uint64(1))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def build_function(words: np.ndarray) -> tuple[list[int], bytes]:
    """Sizes of the levels and their bits. The digests are distinct, so LEVELS suffice
    but with a probability far below that of equal digests; that case raises."""
    sizes, bits, rest = [], [], words
    for level in range(LEVELS):
        if not len(rest):
            break
        size = max(64, int(math.ceil(GAMMA * len(rest) / 8)) * 8)
        at = _position(rest, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone))
        rest = rest[~alone[at]]
    if len(rest):
        raise ValueError("digests of a shard are not distinct")
    return sizes, b"".join(x.tobytes() for x in bits)


def slots_of(words: np.ndarray, sizes: list[int], blob: bytes) -> np.ndarray:
    """The slot of each digest; -1 where no level takes it, so it is no member."""
    flat = np.unpackbits(np.frombuffer(blob, dtype=np.uint8))
    rank = np.concatenate([[0], np.cumsum(flat, dtype=np.int64)])
    out, open_ = np.full(len(words), -1, dtype=np.int64), np.arange(len(words))
    base = 0
    for level, size in enumerate(sizes):
        if not len(open_):
            break
        at = base + _position(words[open_], level, size)
        hit = flat[at] == 1
        out[open_[hit]] = rank[at[hit]]
        open_ = open_[~hit]
        base += size
    return out


def _build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    words = _words(pdf["digest"])
    sizes, blob = build_function(words)
    n = len(pdf)
    return pd.DataFrame({
        "shard": [key[0]] * (n + 1), "slot": [-1, *slots_of(words, sizes, blob).tolist()], "digest": [None, *pdf["digest"]],
        "winner": pd.array([None, *pdf["winner"].astype("Int64")], dtype="Int64"), "copies": pd.array([None, *pdf["copies"]], dtype="Int64"),
        "sizes": [sizes, *[None] * n], "bits": [blob, *[None] * n],
    })


def _look_up(key: tuple, new: pd.DataFrame, function: pd.DataFrame) -> pd.DataFrame:
    out = new.assign(slot=-1)
    if len(new) and len(function):
        out["slot"] = slots_of(_words(new["digest"]), [int(x) for x in function["sizes"].iloc[0]], function["bits"].iloc[0])
    return out[["shard", "slot", "digest", "winner", "copies"]]


def distinct_digests(docs: DataFrame, text: str = "text", locator: str = "doc_id") -> DataFrame:
    """digest (32 bytes), winner (largest locator) and copies for each distinct text."""
    rows = docs.select(F.unhex(F.sha2(text_or_empty(text), 256)).alias("digest"), F.col(locator).cast("long").alias("locator"))
    return rows.groupBy("digest").agg(F.max("locator").alias("winner"), F.count(F.lit(1)).alias("copies"))


def shard_of(shards: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def build_history(distinct: DataFrame, shards: int) -> DataFrame:
    """The index: for each shard a row with its function (slot -1) and a row for each slot."""
    return durable(
        distinct.withColumn("shard", shard_of(shards)).groupBy("shard").applyInPandas(
            _build, "shard int, slot long, digest binary, winner long, copies long, sizes array<long>, bits binary"
        ),
        "digest-index",
    )


def classes_of(old: DataFrame, new: DataFrame) -> DataFrame:
    """digest, keep_id and group_size of every distinct digest of either side; both come
    from distinct_digests. The old side is indexed, the new one is looked up."""
    old = durable(old, "old-digests")
    shards = max(1, math.ceil(old.count() / SHARD_KEYS))
    index = build_history(old, shards)
    functions = index.filter("slot = -1").select("shard", "sizes", "bits")
    slots = index.filter("slot >= 0").select("shard", "slot", F.col("digest").alias("held"), F.col("winner").alias("held_winner"), F.col("copies").alias("held_copies"))
    found = new.withColumn("shard", shard_of(shards)).groupBy("shard").cogroup(functions.groupBy("shard")).applyInPandas(
        _look_up, "shard int, slot long, digest binary, winner long, copies long"
    )
    looked = durable(
        found.join(slots, ["shard", "slot"], "left").withColumn("member", F.coalesce(F.col("held") == F.col("digest"), F.lit(False))), "looked-up"
    )
    repeats = looked.filter("member").select("shard", "slot", "winner", "copies")
    held = slots.join(repeats, ["shard", "slot"], "left").select(
        F.col("held").alias("digest"), F.greatest("winner", "held_winner").alias("keep_id"), (F.col("held_copies") + F.coalesce("copies", F.lit(0))).alias("group_size")
    )
    fresh = looked.filter("not member").select("digest", F.col("winner").alias("keep_id"), F.col("copies").alias("group_size"))
    return held.unionByName(fresh)


def exact_dedup(docs: DataFrame, history: DataFrame | None = None, text: str = "text", locator: str = "doc_id") -> DataFrame:
    """docs with digest, keep_id, group_size and kept.

    history: rows that were taken before, with the same two columns. Without it
    the table is its own history: the half of the rows that a hash of the locator
    picks is indexed, the other half is looked up in it, and rows of both halves
    are answered.

    Of equal texts the row with the largest locator stays, on whichever side. A
    null text counts as empty. A row without a locator never wins over one that
    has it; where no copy has one, keep_id is null and all of them are kept. Rows
    that repeat a locator are one document twice and are treated alike. An empty
    table gives an empty result. Columns of docs named like those added are
    replaced.
    """
    docs = docs.drop("digest", "keep_id", "group_size", "kept")
    if history is None:
        late = F.coalesce(F.pmod(F.xxhash64(F.col(locator)), F.lit(2)) == 1, F.lit(False))
        old, new = docs.filter(~late), docs.filter(late)
    else:
        old, new = history, docs
    classes = classes_of(distinct_digests(old, text, locator), distinct_digests(new, text, locator))
    rows = docs.withColumn("digest", F.unhex(F.sha2(text_or_empty(text), 256)))
    return rows.join(classes, "digest", "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], "digest", "keep_id", "group_size", F.coalesce(F.col(locator) == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept")
    )


def drop_repeats(docs: DataFrame, history: DataFrame | None = None, text: str = "text", locator: str = "doc_id") -> DataFrame:
    """docs without the rows that exact_dedup does not keep, its own columns unchanged.

    The decisions are made on locators and digests; texts are only shuffled where the dropped rows are too many to broadcast."""
    narrow = docs.select(F.col(locator).alias("doc_id"), F.col(text).alias("text"))
    old = None if history is None else history.select(F.col(locator).alias("doc_id"), F.col(text).alias("text"))
    judged = exact_dedup(narrow, old).select("doc_id", "digest", "kept")
    dropped = durable(judged.filter("NOT kept").select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_doc"), F.col("digest").alias("_digest")), "dropped-repeats")
    same = (F.coalesce(F.col(locator).cast("long"), F.lit(-(1 << 63))) == F.col("_doc")) & (F.unhex(F.sha2(text_or_empty(text), 256)) == F.col("_digest"))
    return docs.join(small(dropped, dropped.count()), same, "left_anti")
