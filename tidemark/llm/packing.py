"""Packing token sequences: shortest-pack-first over the histogram of lengths.

Documents are tokenized once, cut into pieces of at most the sequence length,
and written. Only the histogram of piece lengths, as many rows as a sequence
has tokens, reaches the driver, where whole counts of equal lengths are placed
at a time: longest first, each into the open pack with most room left. The
result is a bounded list of patterns with counts. Every pattern takes a range
of ranks of each length it holds; pieces find their sequence by their rank.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, running_start, small, text_batches
from .tokenize import Encoder
from .tokens import portions

SEQUENCE = 1024
#: Id that ends a document.
END = 0
#: Pieces in a batch handed back to Spark, and characters tokenized at once.
OUT_PIECES, IN_CHARS = 2_000, 1 << 21


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(how many packs, lengths in each) that hold counts[length] pieces of each length.

    Longest first; a piece goes to the pack with most room, a new pack is opened
    where none has enough. At most one group of equal packs is split for each
    length and level of room, so the list stays short whatever the counts are.
    """
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = max((r for r, groups in open_.items() if groups), default=-1)
            if room < length:
                each = capacity // length
                for n, items in ((left // each, each), (1, left % each)):
                    if n and items:
                        open_.setdefault(capacity - items * length, []).append((n, (length,) * items))
                break
            n, held = open_[room].pop()
            take = min(n, left)
            if n > take:
                open_[room].append((n - take, held))
            open_.setdefault(room - length, []).append((take, (*held, length)))
            left -= take
        open_ = {r: g for r, g in open_.items() if g}
    return [group for room in sorted(open_) for group in sorted(open_[room], reverse=True)]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset): the pieces of a
    length with these ranks go, one each, to the sequences from the first on."""
    out, used, sequence = [], {}, 0
    for n, lengths in patterns:
        offset = 0
        for length in lengths:
            low = used.get(length, 0)
            out.append((length, low, low + n, sequence, offset))
            used[length] = low + n
            offset += length
        sequence += n
    return out


def token_pieces(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = SEQUENCE, end: int = END) -> DataFrame:
    """A row for each piece: key, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, part, and rank, gapless from 0 within part and length. Durable, since
    part and rank hold for this very split of the input."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of_worker(tokenizer), TaskContext.get().partitionId()
        last, tail = np.zeros(capacity + 1, dtype=np.int64), np.array([end], dtype="<u4").tobytes()
        names = ["key", "start", "length", "ids", "doc_tokens", "part", "rank"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        rows: list[tuple] = []

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            return out

        for batch in portions(batches):
            keys, texts, at = batch.column(0).to_pylist(), batch.column(1), 0
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            while at < len(keys):
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + IN_CHARS, side="right")))
                for k, ids in zip(keys[at:to], encoder.encode([t or "" for t in texts[at:to].to_pylist()]), strict=True):
                    ids += tail
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        length = min(capacity, n - start)
                        rows.append((k, start, length, ids[4 * start : 4 * (start + length)], n, part, int(last[length])))
                        last[length] += 1
                    if len(rows) >= OUT_PIECES:
                        yield emit()
                at = to
        if rows:
            yield emit()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return durable(text_batches(rows).mapInArrow(cut, "key long, start long, length long, ids binary, doc_tokens long, part long, rank long"), "pieces")


def pack(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", capacity: int = SEQUENCE, end: int = END) -> DataFrame:
    """A row for each piece: key column, start (tokens of its document before it), length,
    ids, doc_tokens, sequence_id and offset in that sequence.

    Every document ends with the id `end`, so a null or empty text is that one
    id. Sequences are filled from offset 0 without gaps to at most `capacity`;
    what is left is padding. Rows that repeat a key are packed like any others.
    An empty table gives no rows. Other columns of docs are not carried. Texts of
    any length are taken whole, runs of millions of blanks too.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, tokenizer, text, key, capacity, end)
    counts = durable(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    table = slots(pack_histogram(histogram, capacity))
    places = spark.createDataFrame(table, "length long, low long, high long, first_sequence long, offset long")
    starts = running_start(counts, ["length"], "part", "n", "before").select("part", "length", "before")
    ranked = pieces.join(small(starts, counts.count()), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    found = ranked.alias("p").join(small(places, len(table)).alias("s"), F.expr("p.length = s.length AND p.rank >= s.low AND p.rank < s.high"))
    return found.select(
        F.col("p.key").alias(key), "p.start", "p.length", "p.ids", "p.doc_tokens", (F.col("s.first_sequence") + F.col("p.rank") - F.col("s.low")).alias("sequence_id"), "s.offset"
    )
