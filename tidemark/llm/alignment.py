"""Alignment of two tokenizers on whole texts by a dangling-suffix transducer.

The tokens of both sides are read in order. The state is which side leads and by
which bytes it does, its dangling suffix; the side behind gives the next token,
which shortens the suffix, or takes the lead with a suffix of its own. Where
nothing dangles, both sides end at the same byte: a group closes and its last two
tokens are linked. What a token does in a state is the same wherever it stands, so
transitions are kept by suffix and token.

Neither tokenizer joins bytes across a blank between two other characters, so a text is
cut there and each distinct cut is encoded and run through the transducer once in a while of a task:
what the transducer says of it, from nothing dangling to nothing dangling, is one step for all its occurrences.

The counts of linked id pairs come from all texts. Pairs that are counted often are looked up in a
table of bounded size, all others by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import durable, text_batches
from .tokenize import PATTERN, UNUSUAL, printable_bytes
from .tokens import portions

#: A blank with neither white space nor a text's end beside it.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Cuts that a worker keeps (as many again of those met before), the longest of them, and transitions that it keeps.
KEPT_CUTS, KEPT_CHARS, KEPT_STEPS = 200_000, 48, 500_000
#: Pairs in the table that every task gets; the rarer ones are joined.
TABLE = 1 << 17
#: Pair counts gathered in a task before they are handed on.
GATHERED = 1 << 19


class Cut(NamedTuple):
    """What the two sides make of one cut: how many tokens, the groups as text, the linked pairs (a << 32 | b) as 64-bit integers."""

    n_a: int
    n_b: int
    groups: bytes
    pairs: bytes


class Transducer:
    """States are (dangling suffix, side that gives the next token); 0 is that of no suffix, and side b gives in odd ones.

    steps has the state that a token leads to by state << 20 | token; FAILED where bytes differ."""

    FAILED = -1

    def __init__(self, bytes_a: list[bytes], bytes_b: list[bytes]):
        self.bytes = bytes_a, bytes_b
        self.names = [str(i) for i in range(max(len(bytes_a), len(bytes_b)))]
        self.forget()

    def forget(self) -> None:
        self.suffixes: list[bytes] = [b""]
        self.numbers: dict[tuple[bytes, int], int] = {(b"", 0): 0}
        self.steps: dict[int, int] = {}

    def learn(self, state: int, token: int) -> int:
        suffix, side = self.suffixes[state >> 1], state & 1
        own = self.bytes[side][token]
        if suffix.startswith(own):
            after = suffix[len(own) :], side
        elif own.startswith(suffix):
            after = own[len(suffix) :], 1 - side
        else:
            after = None
        if after is None:
            to = self.FAILED
        elif not after[0]:
            to = 0  # either side may go on; the first does
        elif after in self.numbers:
            to = self.numbers[after]
        else:
            to = self.numbers[after] = len(self.suffixes) << 1 | after[1]
            self.suffixes.append(after[0])
        self.steps[state << 20 | token] = to
        return to

    def run(self, a: list[int], b: list[int]) -> tuple[bytes, bytes] | None:
        """The groups as text and the linked pairs; None if the sides' bytes differ."""
        if len(self.steps) >= KEPT_STEPS:
            self.forget()
        step, names = self.steps.get, self.names
        i = j = open_a = open_b = state = 0
        end_a, end_b = len(a), len(b)
        groups, pairs = [], []
        while True:
            if state & 1:
                if j == end_b:
                    return None
                token = b[j]
                j += 1
            else:
                if i == end_a:
                    break
                token = a[i]
                i += 1
            to = step(state << 20 | token)
            if to is None:
                to = self.learn(state, token)
            if to <= 0:
                if to < 0:
                    return None
                groups.append(",".join([names[x] for x in a[open_a:i]]) + "|" + ",".join([names[x] for x in b[open_b:j]]))
                pairs.append(a[i - 1] << 32 | b[j - 1])
                open_a, open_b = i, j
            state = to
        if state or j < end_b:
            return None
        return ";".join(groups).encode("ascii"), array("q", pairs).tobytes()


class Aligner:
    """Both tokenizers, the transducer, and the cuts that it has met."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        byte, special = printable_bytes(), {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab = {**spec["model"]["vocab"], **special}
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            bytes_a[i] = token.encode() if token in special else bytes(byte[c] for c in token)
        ranks = {bytes_a[i]: i for token, i in vocab.items() if token not in special}
        self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        bytes_b, spaced = [], True
        for i in range(self.pieces.vocab_size()):
            piece = self.pieces.id_to_piece(i)
            spaced &= "▁" not in piece.lstrip("▁")
            bytes_b.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        #: No piece goes on past a blank, so texts may be cut there.
        self.may_cut = spaced
        self.transducer = Transducer(bytes_a, bytes_b)
        self.cuts: dict[str, Cut | None] = {}
        self.older: dict[str, Cut | None] = {}

    @classmethod
    def of_worker(cls, path_a: str, path_b: str) -> Aligner:
        """The one that this Python process holds; a reused worker keeps it from task to task."""
        held = sys.modules.setdefault("tidemark_worker_state", types.ModuleType("tidemark_worker_state")).__dict__
        if ("aligner", path_a, path_b) not in held:
            held["aligner", path_a, path_b] = cls(path_a, path_b)
        return held["aligner", path_a, path_b]

    def ids_a(self, text: str) -> list[int]:
        if not UNUSUAL.search(text):
            try:
                # For long texts the way that raises what can be caught where a run of some million blanks is too much.
                return self.fast.encode_ordinary(text) if len(text) <= KEPT_CHARS else self.fast.encode(text, disallowed_special=())
            except ValueError:
                pass
        return self.library.encode(text, add_special_tokens=False).ids

    def encoded(self, parts: list[str]) -> list[Cut | None]:
        """Each part, which follows a blank; None if a side does not give back its bytes."""
        out = []
        for part, b in zip(parts, self.pieces.encode(parts, num_threads=1), strict=True):
            a = self.ids_a(" " + part)
            found = self.transducer.run(a, b)
            same = found is not None and b"".join([self.transducer.bytes[0][x] for x in a]) == (" " + part).encode()
            out.append(Cut(len(a), len(b), *found) if same else None)
        return out

    def align(self, texts: list[str | None]) -> list[list[Cut] | None]:
        """The cuts of each text in order; None for one without tokens. New cuts of all the texts are encoded together."""
        parted = [(CUT.split(t) if self.may_cut else [t]) if t else [] for t in texts]
        held, older = self.cuts, self.older
        new = [x for x in dict.fromkeys(chain.from_iterable(parted)) if x not in held]
        known = {x: older[x] for x in new if x in older}
        new = [x for x in new if x not in known]
        for at in range(0, len(new), 20_000):
            known.update(zip(new[at : at + 20_000], self.encoded(new[at : at + 20_000]), strict=True))
        long = {x: c for x, c in known.items() if len(x) > KEPT_CHARS}
        held.update((x, c) for x, c in known.items() if len(x) <= KEPT_CHARS)
        out = []
        for parts in parted:
            found = [held[x] if x in held else long[x] for x in parts]
            out.append(found if found and None not in found else None)
        if len(held) >= KEPT_CUTS:
            self.cuts, self.older = {}, held
        return out


ROW = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each row of docs: key, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct linked pairs
    (a << 32 | b) and how often it has each, both as little-endian 64-bit integers. Durable."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of_worker(path_a, path_b)
        for batch in portions(batches, 100):
            out = []
            for k, cuts in zip(batch.column(0).to_pylist(), aligner.align(batch.column(1).to_pylist()), strict=True):
                if cuts is None:
                    out.append((k, 0, 0, 0, 0, "", b"", b""))
                    continue
                n_a, n_b, groups, pairs = zip(*cuts, strict=True)
                links = np.frombuffer(b"".join(pairs), dtype="<i8")
                codes, times = np.unique(links, return_counts=True)
                digest = hashlib.sha256(b";".join(groups)).hexdigest()
                out.append((k, sum(n_a), sum(n_b), len(links), len(links), digest, codes.tobytes(), times.astype("<i8").tobytes()))
            names = [x.split()[0] for x in ROW.split(", ")]
            kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return durable(text_batches(narrow).mapInArrow(rows, ROW), "aligned")


def pair_counts(found: DataFrame) -> DataFrame:
    """a, b and n: how many links of all texts link these ids. Summed up in each task before the shuffle."""

    def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(times)], ["code", "n"])

        for batch in portions(batches):
            more = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<i8")
            counts = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<i8")
            codes, where = np.unique(np.concatenate([codes, more]), return_inverse=True)
            times = np.bincount(where, weights=np.concatenate([times, counts]), minlength=len(codes)).astype(np.int64)
            if len(codes) >= GATHERED:
                yield out()
                codes, times = codes[:0], times[:0]
        if len(codes):
            yield out()

    partial = found.select("pairs", "times").mapInArrow(gathered, "code long, n long")
    return partial.groupBy("code").agg(F.sum("n").alias("n")).select(F.shiftright("code", 32).alias("a"), F.col("code").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "n")


def with_best(counts: DataFrame) -> DataFrame:
    """counts with best: whether n is the highest of its b. One row for each b is shuffled twice, not more than it has ids a."""
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each row of docs: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    path_a is a byte-level `tokenizers` file, path_b a `sentencepiece` model that sets a blank before a text; both encode a blank and the text,
    strings of special tokens being plain text. Groups are the finest stretches at whose ends tokens of both sides
    end; the pairs of tokens that end there are linked. An id pair's count is the number of links with it in all rows. n_best: links whose count is the
    highest that their second id has, ties included; count_sum: the sum of counts over links.

    A null or empty text, and one that a side does not give back byte for byte (U+2581 is read as a blank), has no tokens: zeros and ''. Rows that
    repeat a key are rows of their own, rows without a key too; long texts are taken whole; an empty table gives no rows; other columns are not carried.
    """
    found = aligned(docs, path_a, path_b, text, key)
    counts = durable(with_best(pair_counts(found)), "pair-counts")
    table = common_pairs(counts, TABLE)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(table)

    def looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the pairs of the table, and the other pairs for the join."""
        codes, n, best, _ = held.value
        for batch in portions(batches):
            sums, bests, others, often = [], [], [], []
            for p, t in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist(), strict=True):
                pairs, times = np.frombuffer(p, dtype="<i8"), np.frombuffer(t, dtype="<i8")
                at = np.minimum(np.searchsorted(codes, pairs), max(len(codes) - 1, 0))
                hit = codes[at] == pairs if len(codes) else np.zeros(len(pairs), dtype=bool)
                sums.append(int((n[at[hit]] * times[hit]).sum()))
                bests.append(int((best[at[hit]] * times[hit]).sum()))
                others.append(pairs[~hit])
                often.append(times[~hit])
            keep = [batch.column(c) for c in ("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (others, often)]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), *lists], ["key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "others", "often"])

    schema = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, others array<long>, often array<long>"
    near = found.mapInArrow(looked_up, schema)
    if table[3]:
        return near.select(F.col("key").alias(key), *[x.split()[0] for x in schema.split(", ")[1:5]], "n_best", "count_sum", "groups_sha256")
    near = durable(near.withColumn("row", F.monotonically_increasing_id()), "looked-up")
    rare = near.select("row", F.explode(F.arrays_zip("others", "often")).alias("x")).select("row", F.col("x.others").alias("code"), F.col("x.often").alias("times"))
    coded = counts.select((F.shiftleft("a", 32).bitwiseOR(F.col("b"))).alias("code"), "n", F.col("best").cast("long").alias("best"))
    summed = rare.join(coded, "code").groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.col("times") * F.col("best")).alias("more_best"))
    total = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
    return near.join(summed, "row", "left").select(F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links", total("n_best", "more_best"), total("count_sum", "more"), "groups_sha256")


def common_pairs(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Codes in order, counts and best of the pairs counted most often, at most `most` of them, and whether these are all.

    The least count that still fits is found from how many pairs have counts of each bit length, so nothing is sorted and pairs beyond the bound never
    leave the executors."""
    length = F.ceil(F.log2(F.col("n") + 1)).cast("int")
    sizes = {r["length"]: r["rows"] for r in counts.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("rows")).collect()}  # at most 63 rows
    least, rows = 64, 0
    for k in sorted(sizes, reverse=True):
        if rows + sizes[k] > most:
            break
        least, rows = k, rows + sizes[k]
    got = counts.filter(length >= least).toArrow()
    codes = np.left_shift(got["a"].to_numpy(), 32) | got["b"].to_numpy()
    order = np.argsort(codes)
    return codes[order], got["n"].to_numpy()[order], got["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64), rows == sum(sizes.values())
