"""A hashed maximum-entropy language model with a class-factored softmax.

The words counted most often have a bin of their own, all others share bins by their last two bytes, so every word,
seen or not, has a bin. Bins lie in a square of classes and members. The probability of a word is that of its class, given
features of the words before it, times that of the member of the class, given the same features and the class, times the
word's smoothed share in its bin. Features are the bin before, the two bins before, and the bins two and three words back; each
is hashed to a row of weights, and a softmax goes over the sums of the rows.

Word counts come from all texts learned from. Weights are learned in rounds: in each, every task
starts from the same weights, goes once through its part of the round's texts in small gradient steps, and sends the rows that it has changed.
What has changed in them is averaged, a row by how often each task has met it, and makes the weights of the next round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, text_batches
from .tokens import blocks, mix, portions, span_hashes, word_bounds

#: Classes, members of a class; bins of single words and of word endings; the bin before a text begins.
SIDE = 32
BINS, ENDINGS = SIDE * SIDE, 256
SINGLES, BEFORE = BINS - ENDINGS, BINS
#: Rows of weights of either level, and of these the ones that features of the upper level have without hashing.
ROWS, PLAIN = 1 << 16, 3 * (BINS + 1)
#: Words in the table that every task gets, and its slots; all other words are joined.
TABLE, SLOTS = 1 << 18, 1 << 20
#: Passes over disjoint parts of the texts, tokens in a gradient step, its size, and tasks that train at once at most.
ROUNDS, STEP_TOKENS, RATE, TASKS = 2, 8192, 0.2, 4096
#: Rows of weights that are averaged in one group.
CHUNK = 512
#: Distinct words gathered in a task before they are handed on.
GATHERED = 1 << 19
#: The token at a text's end; no word has this hash but by chance.
END = mix(np.array([0xE0D], dtype=np.uint64))[0]


class Tokens(NamedTuple):
    """Words of consecutive texts, each followed by END: 64-bit hash, ending (0 .. ENDINGS - 1), and where each text starts (one more at the end)."""

    words: np.ndarray
    endings: np.ndarray
    first: np.ndarray


def tokens(column: pa.Array) -> Iterator[Tokens]:
    for _, data, offsets in blocks(column):
        starts, ends, first = word_bounds(data, offsets)
        words = span_hashes(data, starts, ends)
        low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        last = low[ends - 1].astype(np.uint64) << np.uint64(8)
        if len(ends):
            last += np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
        endings = (mix(last + np.uint64(7)) >> np.uint64(56)).astype(np.int64)
        yield Tokens(np.insert(words, first[1:], END), np.insert(endings, first[1:], 0), first + np.arange(len(first)))


def word_counts(texts: DataFrame) -> DataFrame:
    """word (hash), ending and n over the texts of one column `text`; counted in each task before the shuffle. Durable."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            words, endings, n = (np.concatenate(x) for x in zip(*held, strict=True))
            each, at, where = np.unique(words, return_index=True, return_inverse=True)
            return each, endings[at], np.bincount(where, weights=n, minlength=len(each)).astype(np.int64)

        def out(x: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1]), pa.array(x[2])], ["word", "ending", "n"])

        for batch in portions(batches):
            for t in tokens(batch.column(0)):
                words, at, n = np.unique(t.words, return_index=True, return_counts=True)
                held.append((words, t.endings[at], n))
            if sum(len(x[0]) for x in held) >= 2 * GATHERED:
                held[:] = [merged()]
                if len(held[0][0]) >= GATHERED:
                    yield out(held.pop())
        if held:
            yield out(merged())

    each = text_batches(texts.select("text")).mapInArrow(counted, "word long, ending long, n long")
    return durable(each.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "word-counts")


class Words(NamedTuple):
    """Common words by slot: hash, log10(count + 1), bin. bin_logs: log10 of what a share in a bin is divided by; tokens, distinct: of all texts learned from."""

    hashes: np.ndarray
    logs: np.ndarray
    bins: np.ndarray
    bin_logs: np.ndarray
    tokens: int
    distinct: int

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each word, and whether it is in the table."""
        at = _slot(words)
        hit = self.hashes[at] == words
        miss = np.flatnonzero(~hit)
        second = _slot(words[miss], 1)
        at[miss], hit[miss] = second, self.hashes[second] == words[miss]
        return at, hit & (self.bins[at] >= 0)


def _slot(words: np.ndarray, turn: int = 0) -> np.ndarray:
    return ((words >> np.uint64(22 * turn)) & np.uint64(SLOTS - 1)).astype(np.int64)


def common_words(counts: DataFrame) -> Words:
    """The table of at most TABLE words with the highest counts. How many words have counts of each bit length tells the least count
    that fits, so nothing is sorted and rarer words never leave the executors."""
    by_ending = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()  # ENDINGS rows at most
    length = F.ceil(F.log2(F.col("n") + 1)).cast("int")
    sizes = {r["length"]: r["rows"] for r in counts.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("rows")).collect()}  # at most 63 rows
    least, rows = 64, 0
    for k in sorted(sizes, reverse=True):
        if rows + sizes[k] > TABLE:
            break
        least, rows = k, rows + sizes[k]
    got = counts.filter(length >= least).toArrow()
    word, ending, n = got["word"].to_numpy().view(np.uint64), got["ending"].to_numpy(), got["n"].to_numpy()
    order = np.lexsort((word, -n))
    word, ending, n = word[order], ending[order], n[order]
    owner = np.full(SLOTS, -1, dtype=np.int64)
    left = np.arange(len(word))
    for turn in range(2):  # the commoner word has the slot; who has none of its two is joined like rare words
        slots = _slot(word[left], turn)
        free = np.flatnonzero(owner[slots] < 0)
        _, first = np.unique(slots[free], return_index=True)
        won = free[first]
        owner[slots[won]] = left[won]
        left = np.delete(left, won)
    taken = np.flatnonzero(owner >= 0)
    whose = owner[taken]
    hashes, logs, bins = np.zeros(SLOTS, dtype=np.uint64), np.zeros(SLOTS), np.full(SLOTS, -1, dtype=np.int16)
    hashes[taken], logs[taken] = word[whose], np.log10(n[whose] + 1.0)
    single = np.sort(whose)[:SINGLES]
    bin_of = SINGLES + ending
    bin_of[single] = np.arange(len(single))
    bins[taken] = bin_of[whose]
    total, seen = np.zeros(BINS), np.zeros(BINS)
    for r in by_ending:
        total[SINGLES + r["ending"]], seen[SINGLES + r["ending"]] = r["n"], r["rows"]
    np.subtract.at(total, SINGLES + ending[single], n[single])
    np.subtract.at(seen, SINGLES + ending[single], 1)
    bin_logs = np.log10(total + seen + 1.0)
    bin_logs[:SINGLES] = 0.0
    return Words(hashes, logs, bins, bin_logs, sum(r["n"] for r in by_ending), sum(r["rows"] for r in by_ending))


def events(t: Tokens, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each token: its slot, whether the table has it, its bin, and the bins one, two and three words before it in its text, in rows."""
    at, hit = words.look_up(t.words)
    bins = np.where(hit, words.bins[at], SINGLES + t.endings).astype(np.int64)
    place = np.arange(len(bins)) - np.repeat(t.first[:-1], np.diff(t.first))
    back = [np.where(place < k, BEFORE, np.concatenate([np.full(min(k, len(bins)), BEFORE), bins[:-k]])) for k in (1, 2, 3)]
    return at, hit, bins, np.stack(back)


def feature_rows(back: np.ndarray, classes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of weights, below ROWS, of the features of each token for its class, and for the member of its class."""
    one, two, three = back
    wide = BINS + 1
    pair = mix((one * wide + two).astype(np.uint64))
    upper = [one, two + wide, three + 2 * wide, PLAIN + (pair % np.uint64(ROWS - PLAIN)).astype(np.int64)]
    salt = mix(np.arange(1, 4 * SIDE + 1, dtype=np.uint64))
    own = [mix(x.astype(np.uint64) + salt[k * SIDE + classes]) for k, x in enumerate((one, two, three))] + [mix(pair + salt[3 * SIDE + classes])]
    return [x.astype(np.uint16) for x in upper], [(x >> np.uint64(48)).astype(np.uint16) for x in own]


def chances(weights: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        z += weights.take(r, axis=0)
    np.exp(np.clip(z, -40, 40, out=z), out=z)
    z /= (z @ np.ones(SIDE, dtype=np.float32))[:, None]
    return z


class Learner:
    """Weights of one level in one task, with the squares of its gradients and how often each row has been met."""

    def __init__(self, weights: np.ndarray, squares: np.ndarray):
        self.start, self.before, self.weights, self.squares = weights, squares, weights.copy(), squares.copy()
        self.met = np.zeros(ROWS, dtype=np.float32)

    def learn(self, rows: list[np.ndarray], truth: np.ndarray) -> None:
        """One gradient step of the log-likelihood, each row with a step of its own."""
        p = chances(self.weights, rows)
        p[np.arange(len(truth)), truth] -= 1
        for r in rows:
            order = np.argsort(r, kind="stable")
            ordered = r[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            # Two floats are summed at once as one complex number.
            slope = np.add.reduceat(p.take(order, axis=0).view(np.complex64), first, axis=0).view(np.float32)
            at = ordered[first]
            self.met[at] += np.diff(first, append=len(r))
            self.squares[at] += (slope * slope).mean(axis=1)
            self.weights[at] -= (RATE / np.sqrt(self.squares[at]))[:, None] * slope

    def changed(self, level: int, part: int) -> Iterator[tuple[int, int, bytes, bytes, bytes, bytes]]:
        """(chunk, part, rows, how their weights and the roots of their squares changed, in half precision, and how often they were met) for each chunk
        with a row that has been met."""
        rows = np.flatnonzero(self.met)
        for own in np.split(rows, np.flatnonzero(np.diff(rows // CHUNK)) + 1):
            if len(own):
                yield level * (ROWS // CHUNK) + int(own[0]) // CHUNK, part, own.astype("<i4").tobytes(), (self.weights[own] - self.start[own]).astype("<f2").tobytes(), (np.sqrt(self.squares[own]) - np.sqrt(self.before[own])).astype("<f2").tobytes(), self.met[own].tobytes()


CHANGED = "chunk long, part long, rows binary, weights binary, squares binary, met binary"


def averaged(pdf: pd.DataFrame) -> pd.DataFrame:
    """The tasks' rows of one chunk as one row: changes as averages by how often a task has met the row, met as sums."""
    pdf = pdf.sort_values("part")  # so that sums don't depend on the order of arrival
    total = {k: np.zeros((CHUNK, w)) for k, w in (("weights", SIDE), ("squares", 1), ("met", 1))}
    for r in pdf.itertuples():
        at, met = np.frombuffer(r.rows, dtype="<i4") % CHUNK, np.frombuffer(r.met, dtype="<f4")[:, None]
        total["weights"][at] += np.frombuffer(r.weights, dtype="<f2").reshape(-1, SIDE) * met.astype(float)
        total["squares"][at] += np.frombuffer(r.squares, dtype="<f2")[:, None] * met.astype(float)
        total["met"][at] += met
    own = np.flatnonzero(total["met"][:, 0])
    met = total["met"][own]
    rows = (own + int(pdf["chunk"].iloc[0]) * CHUNK).astype("<i4")
    return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "part": [0], "rows": [rows.tobytes()], "weights": [(total["weights"][own] / met).astype("<f4").tobytes()], "squares": [(total["squares"][own] / met).astype("<f4").tobytes()], "met": [met.astype("<f4").tobytes()]})


class LanguageModel(NamedTuple):
    """counts: word, ending and n of all words learned from. weights: of both levels, ROWS x SIDE each."""

    counts: DataFrame
    words: Words
    weights: tuple[np.ndarray, np.ndarray]


def train_language_model(docs: DataFrame, learn: Column, text: str = "text", key: str = "doc_id") -> LanguageModel:
    """Learned from the rows of docs where `learn` is true; a null text is an empty one. Every row is counted, and learned from in one round, by a hash of its key."""
    spark = docs.sparkSession
    texts = docs.filter(learn).select(F.col(text).alias("text"), F.pmod(F.xxhash64(F.col(key)), F.lit(ROUNDS)).alias("round"))
    counts = word_counts(texts)
    words = common_words(counts)
    held = spark.sparkContext.broadcast(words)
    weights = [np.zeros((ROWS, SIDE), dtype=np.float32) for _ in range(2)]
    squares = [np.ones(ROWS, dtype=np.float32) for _ in range(2)]
    for turn in range(ROUNDS):
        state = spark.sparkContext.broadcast((weights, squares))

        def learned(batches: Iterable[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            levels = [Learner(w, s) for w, s in zip(*state.value, strict=True)]
            for batch in portions(batches):
                for t in tokens(batch.column(0)):
                    _, _, bins, back = events(t, held.value)
                    for at in range(0, len(bins), STEP_TOKENS):
                        own = bins[at : at + STEP_TOKENS]
                        classes, members = own // SIDE, own % SIDE
                        for level, rows, truth in zip(levels, feature_rows(back[:, at : at + STEP_TOKENS], classes), (classes, members), strict=True):
                            level.learn(rows, truth)
            part = TaskContext.get().partitionId()
            for k, level in enumerate(levels):
                for row in level.changed(k, part):
                    yield pa.RecordBatch.from_pydict(dict(zip([x.split()[0] for x in CHANGED.split(", ")], ([v] for v in row), strict=True)))

        tasks = min(TASKS, spark.sparkContext.defaultParallelism)
        each = text_batches(texts.filter(F.col("round") == turn).select("text").coalesce(tasks)).mapInArrow(learned, CHANGED)
        got = each.groupBy("chunk").applyInPandas(averaged, CHANGED).select("rows", "weights", "squares").collect()  # 2 * ROWS rows of weights at most
        weights, squares = [w.copy() for w in weights], [s.copy() for s in squares]
        for r in got:
            at = np.frombuffer(r["rows"], dtype="<i4")
            level, at = int(at[0]) // ROWS, at % ROWS
            weights[level][at] += np.frombuffer(r["weights"], dtype="<f4").reshape(-1, SIDE)
            squares[level][at] = (np.sqrt(squares[level][at]) + np.frombuffer(r["squares"], dtype="<f4")) ** 2
        state.destroy()
    return LanguageModel(counts, words, (weights[0], weights[1]))


def log_chances(bins: np.ndarray, back: np.ndarray, weights: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 of the probability of each token's bin."""
    out = np.zeros(len(bins))
    for at in range(0, len(bins), STEP_TOKENS):
        own = bins[at : at + STEP_TOKENS]
        classes, members = own // SIDE, own % SIDE
        each = np.arange(len(own))
        for w, rows, truth in zip(weights, feature_rows(back[:, at : at + STEP_TOKENS], classes), (classes, members), strict=True):
            out[at : at + STEP_TOKENS] += np.log10(np.maximum(chances(w, rows)[each, truth], 1e-30).astype(np.float64))
    return out


def score_texts(docs: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row for each row of docs: key, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are the words, A-Z folded, and one end. base_score: sum over tokens of log10((c + 1) / (N + V + 1)) for a token counted c
    times among N tokens, V of them distinct, learned from. score: log10 of the model's probability of the text; a word not learned from has
    the share of a word counted 0 times in the bin of its ending. A null or empty text is its end alone. Texts of any length are scored whole; rows
    that repeat a key, or have none, each have their row; an empty table gives no rows; other columns are not carried. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((model.words, model.weights))
    schema = "key long, n_tokens long, n_known long, logs double, score double, others array<long>, often array<long>"

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights = held.value
        for batch in portions(batches):
            rows: list[tuple] = []
            for t in tokens(batch.column(1)):
                at, hit, bins, back = events(t, words)
                logs = np.where(hit, words.logs[at], 0.0)
                score = log_chances(bins, back, weights) - words.bin_logs[bins] + np.where(bins >= SINGLES, logs, 0.0)
                sums = [np.add.reduceat(x, t.first[:-1]).tolist() for x in (hit.astype(np.int64), logs, score)]
                for i, (n, known, a, b) in enumerate(zip(np.diff(t.first).tolist(), *sums, strict=True)):
                    own = slice(t.first[i], t.first[i + 1])
                    others, often = np.unique(t.words[own][~hit[own]].view(np.int64), return_counts=True)
                    rows.append((n, known, a, b, others, often))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]], [x.split()[0] for x in schema.split(", ")])

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    near = durable(text_batches(narrow).mapInArrow(scored, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = near.select("row", F.explode(F.arrays_zip("others", "often")).alias("x")).select("row", F.col("x.others").alias("word"), F.col("x.often").alias("times"))
    summed = rare.join(model.counts.select("word", "n"), "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("known"))
    n, v = model.words.tokens, model.words.distinct
    out = near.join(summed, "row", "left").withColumns({"more": F.coalesce("more", F.lit(0.0)), "known": F.coalesce("known", F.lit(0))})
    base = F.col("logs") + F.col("more") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return out.select(F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.col("known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.col("more")).alias("score"))
