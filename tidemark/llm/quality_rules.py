"""Quality rules: counts within a text, and line frequency across the documents of a host.

Lines are normalised to their words, case-folded for A-Z, and hashed. A line that too many
documents of one host share is removed from all of them, and a document of
which too little is left is rejected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, small, text_batches
from .tokens import blocks, mix, portions, _power, span_hashes, windows, word_bounds

#: A line is removed on a host if at least so many of its documents have it, however many the host has.
LEAST_DOCUMENTS = 20
#: A document is rejected if less than this share of its words is left.
LEAST_LEFT = 0.4
LEAST_WORDS, MOST_REPEATED = 50, 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets])


def text_facts(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[list[int], list[tuple[int, int, int]]]]:
    """For each text the five COUNTS, and (hash, words, number) of each line with a word."""
    for _, data, offsets in blocks(column):
        space = (data == 32) | ((data - np.uint8(9)) < 5)
        starts, ends, first = word_bounds(data, offsets, space)
        chars = _sums(~space & ((data & 0xC0) != 0x80), offsets)
        symbols = _sums(_SYMBOL[data], offsets)
        exact = span_hashes(data, starts, ends, lower=False)
        folded = span_hashes(data, starts, ends)
        triples, at = windows(exact, first, 3)
        newline = np.flatnonzero(data == 10)
        for i in range(len(offsets) - 1):
            a, b = int(offsets[i]), int(offsets[i + 1])
            w0, w1 = int(first[i]), int(first[i + 1])
            inner = newline[np.searchsorted(newline, a) : np.searchsorted(newline, b)]
            ls, le = np.concatenate([[a], inner + 1]), np.concatenate([inner, [b]])
            ws, we = np.searchsorted(starts[w0:w1], ls) + w0, np.searchsorted(starts[w0:w1], le) + w0
            worded = np.flatnonzero(we > ws)
            raw = span_hashes(data[a:b], ls[worded] - a, le[worded] - a, lower=False) if len(worded) else np.zeros(0, dtype=np.uint64)
            dup = len(raw) - len(np.unique(raw))
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(folded[w0:w1] * _power("up", max(1, w1 - w0))[: w1 - w0])])
            lines = mix((sums[we[worded] - w0] - sums[ws[worded] - w0]) * _power("down", max(1, w1 - w0))[np.minimum(ws[worded] - w0, max(0, w1 - w0 - 1))] + (we - ws)[worded].astype(np.uint64))
            own = triples[at[i] : at[i + 1]]
            marked = np.zeros(w1 - w0 + 3, dtype=bool)
            if len(own):
                _, back, times = np.unique(own, return_inverse=True, return_counts=True)
                twice = np.flatnonzero(times[back] > 1)
                for k in range(3):
                    marked[twice + k] = True
            yield [w1 - w0, int(chars[i]), int(symbols[i]), dup, int(marked.sum())], list(zip(lines.view(np.int64).tolist(), (we - ws)[worded].tolist(), worded.tolist(), strict=True))


def _facts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 33
    lines_kind = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int32()), ("number", pa.int32())]))
    for batch in portions(batches):
        facts = list(text_facts(batch.column("_text")))
        counts = [pa.array([c[i] for c, _ in facts], pa.int64()) for i in range(len(COUNTS))]
        lines = pa.array([[{"line": h, "words": w, "number": n} for h, w, n in x] for _, x in facts], lines_kind)
        rows = pa.array(range(row, row + len(facts)), pa.int64())
        row += len(facts)
        kept = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), rows, *counts, lines], [*kept, "_row", *COUNTS, "_lines"])


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", clean: bool = True, key: str = "doc_id") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, removed_words and kept; with clean, also clean_text, the text without
    the removed lines.

    A null text has no words. Documents without a host are one host. Lines of
    copies count once for each document, and a line twice in a document counts once. Rows that repeat a key
    are one document to these counts; rows without a key are one each. An empty
    table gives an empty result. Columns of docs by the added names are replaced.
    """
    added = [*COUNTS, "base_failed", "removed_words", "kept", "clean_text"]
    docs = docs.drop(*added)
    own = docs.columns if clean else [c for c in docs.columns if c != text]
    named = docs.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("")).alias("_host"), F.col(key).cast("string").alias("_key"), F.col(text).alias("_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in named.dtypes if n != "_text")
    facts = durable(text_batches(named).mapInArrow(_facts, f"{schema}, _row long, {', '.join(f'{c} long' for c in COUNTS)}, _lines array<struct<line: long, words: int, number: int>>"), "facts")
    apart = F.array_distinct(F.transform("_lines", lambda x: x["line"]))
    document = F.coalesce(F.concat(F.lit("="), "_key"), F.col("_row").cast("string"))
    spread = facts.select("_host", document.alias("document"), F.explode(apart).alias("line")).groupBy("_host", "line").agg(F.count_distinct("document").alias("n")).filter(F.col("n") >= LEAST_DOCUMENTS)
    frequent = durable(spread.select("_host", "line"), "frequent-lines")
    each = facts.select("_row", "_host", F.explode("_lines").alias("x")).select("_row", "_host", "x.*")
    removed = each.join(small(frequent, frequent.count()), ["_host", "line"]).groupBy("_row").agg(F.sum("words").alias("removed_words"), F.collect_set("number").alias("_numbers"))
    out = facts.drop("_lines", "_host", "_key").join(removed, "_row", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("n_words") - F.col("removed_words") >= LEAST_LEFT * F.col("n_words")))
    if clean:
        left = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(F.col("_numbers"), i))
        out = out.withColumn("clean_text", F.when(F.col("_numbers").isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    return out.drop("_row", "_numbers")
