"""Quality by ordinal regression: a cumulative-link model over hashed text.

A rating has ordered grades 0, 1, ... One weight vector scores a text, and
ordered thresholds cut the score into grades: P(grade >= g) is the logistic of
score minus threshold g. The expected grade and the probability of the top
grades follow. The model is fitted on a bounded sample of rated rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches
from .language import bounded_sample
from .tokens import blocks, mix, portions, span_hashes, word_bounds

DIMENSIONS = 1 << 18
#: A feature gets a weight only if its chi-square against the grades is at least this; with
#: two degrees of freedom chance gives it to none of some hundred thousand features.
LEAST_CHI_SQUARE = 50.0
#: Rated rows of a grade that a fit takes, as an expected number.
SAMPLE_PER_GRADE = 2_500
_SALT = mix(np.arange(11, 16, dtype=np.uint64))

# Classes of bytes for a word's shape: lower and upper letters, digits, marks, other.
_CLASS = np.full(256, 5, dtype=np.uint8)
_CLASS[list(range(97, 123))] = 1
_CLASS[list(range(65, 91))] = 2
_CLASS[list(range(48, 58))] = 3
_CLASS[list(b".,;:!?'\"-()#*$%&|<>@_/\\[]{}+=~^`")] = 4
_BARE = _CLASS != 4


def text_features(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text sorted places in [0, DIMENSIONS) and values: presence of its words
    without marks, shares of word shapes, and its size and repetition."""
    for _, data, offsets in blocks(column):
        starts, ends, first = word_bounds(data, offsets)
        bare = np.where(_BARE[data], data, 32).astype(np.uint8)
        shaped = _CLASS[data]
        run = np.ones(len(data), dtype=bool)
        run[1:] = shaped[1:] != shaped[:-1]
        run[starts] = True
        moved = np.concatenate([[0], np.cumsum(run)])
        shapes = span_hashes(shaped[run], moved[starts], moved[ends], lower=False) if len(starts) else np.zeros(0, dtype=np.uint64)
        ws, we, wf = word_bounds(bare, offsets)
        words = span_hashes(bare, ws, we)
        exact = span_hashes(data, starts, ends)
        for i in range(len(offsets) - 1):
            own, n = words[wf[i] : wf[i + 1]], first[i + 1] - first[i]
            kinds, times = np.unique(shapes[first[i] : first[i + 1]], return_counts=True)
            distinct = np.unique(own)
            different = len(np.unique(exact[first[i] : first[i + 1]]))
            extra = [np.float32(np.log1p(n) / 5), np.float32(different / n if n else 0)]
            places = np.concatenate([mix(distinct ^ _SALT[0]), mix(kinds ^ _SALT[1]), _SALT[2:4]]) >> np.uint64(64 - 18)
            values = np.concatenate([np.full(len(distinct), 0.5), 4 * times / max(1, n), extra]).astype(np.float32)
            order = np.argsort(places, kind="stable")
            yield places[order].astype(np.int32), values[order]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    cuts: np.ndarray

    def at_least(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """P(grade >= g) for g = 1, 2, ..."""
        score = float(self.weights[places] @ values)
        return 1 / (1 + np.exp(-np.clip(score - self.cuts, -40, 40)))


def telling(places: np.ndarray, owner: np.ndarray, y: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which features are in rows of some grade more or less often than chance explains;
    those that nearly every row has (shares, sizes) always are."""
    seen = np.bincount(places, minlength=DIMENSIONS)
    chi = np.zeros(DIMENSIONS)
    for g in np.flatnonzero(counts):
        there = np.bincount(places[y[owner] == g], minlength=DIMENSIONS)
        expected = seen * counts[g] / len(y)
        chi += (there - expected) ** 2 / np.maximum(expected * (1 - seen / (len(y) + 1)), 0.5)
    return (chi >= LEAST_CHI_SQUARE) | (seen >= 0.9 * len(y))


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: list[int], levels: int, epochs: int = 200, ridge: float = 1e-5, rate: float = 0.1) -> OrdinalModel:
    """Maximum likelihood by full Adam steps, every grade with the same total weight; deterministic.

    Thresholds are a first one and positive steps, so they stay ordered."""
    weights, base, gaps = np.zeros(DIMENSIONS), 0.0, np.zeros(levels - 2)
    if not rows:
        return OrdinalModel(weights, np.arange(levels - 1, dtype=float))
    y = np.array(grades)
    counts = np.bincount(y, minlength=levels)
    share = (1.0 / np.maximum(counts, 1))[y] / max(1, (counts > 0).sum())
    places = np.concatenate([p for p, _ in rows])
    values = np.concatenate([v for _, v in rows]).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum([len(p) for p, _ in rows])[:-1]])
    owner = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    values[~telling(places, owner, y, counts)[places]] = 0
    state = np.zeros((2, DIMENSIONS + levels - 1))
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for step in range(1, epochs + 1):
        cuts = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.add.reduceat(weights[places] * values, starts)
        above = np.hstack([np.ones((len(y), 1)), logistic(score[:, None] - cuts), np.zeros((len(y), 1))])
        slope = above * (1 - above)
        mass = np.maximum(above[np.arange(len(y)), y] - above[np.arange(len(y)), y + 1], 1e-9)
        low, high = slope[np.arange(len(y)), y] / mass * share, slope[np.arange(len(y)), y + 1] / mass * share
        by_score = low - high  # of the log-likelihood
        by_cut = np.zeros(levels + 1)
        np.add.at(by_cut, y, -low)
        np.add.at(by_cut, y + 1, high)
        by_cut = by_cut[1:levels]
        steps = np.array([np.exp(g) * by_cut[k + 1 :].sum() for k, g in enumerate(gaps)])
        grad = np.concatenate([np.bincount(places, weights=by_score[owner] * values, minlength=DIMENSIONS) - ridge * weights, [by_cut.sum()], steps])
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad * grad
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-9)
        weights, base, gaps = weights + move[:DIMENSIONS], base + move[DIMENSIONS], gaps + move[DIMENSIONS + 1 :]
    return OrdinalModel(weights.astype(np.float32), base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def _featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        found = list(text_features(batch.column("text")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("grade"), pa.array([p.tobytes() for p, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())], ["grade", "places", "values"]
        )


def train_quality_model(docs: DataFrame, ratings: DataFrame, levels: int, text: str = "text", grade: str = "grade", key: str = "doc_id", per_grade: int = SAMPLE_PER_GRADE) -> OrdinalModel:
    """Fit on about per_grade rated documents of each grade. The ratings (key, grade) are
    sampled first; their texts come by a join with that bounded sample. Ratings without a key or
    with a grade outside 0 .. levels - 1 are not learned from; a null text is an empty one. Where a key
    repeats, each of its documents is learned from once for each of its ratings."""
    rated = ratings.select(F.col(key).alias("_key"), F.col(grade).cast("int").alias("grade")).filter(F.col("_key").isNotNull() & F.col("grade").between(0, levels - 1))
    chosen = bounded_sample(rated, "grade", "_key", per_grade)
    rows = docs.select(F.col(key), F.col(text).alias("text")).join(F.broadcast(chosen), F.col(key) == F.col("_key")).select("grade", "text")
    got = text_batches(rows).mapInArrow(_featurise, "grade int, places binary, values binary").collect()
    got = sorted((r["grade"], bytes(r["places"]), bytes(r["values"])) for r in got)
    return fit_ordinal([(np.frombuffer(p, dtype="<i4"), np.frombuffer(v, dtype="<f4")) for _, p, v in got], [g for g, _, _ in got], levels)


def grade_quality(docs: DataFrame, model: OrdinalModel, text: str = "text", select: int = 2, least: float = 0.3) -> DataFrame:
    """docs with expected_grade, tail_probability (of grade `select` or a higher one) and
    kept (that probability is `least` or more).

    A null or empty text is graded as one without words. Nothing but the text is
    looked at; rows come back once each; an empty table gives an empty result.
    Columns of docs by the added names are replaced.
    """
    docs = docs.drop("expected_grade", "tail_probability", "kept")
    where = docs.columns.index(text)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            chances = np.array([model.at_least(p, v) for p, v in text_features(batch.column(where))]).reshape(batch.num_rows, len(model.cuts))
            tail = chances[:, select - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chances.sum(axis=1)), pa.array(tail), pa.array(tail >= least)], [*batch.schema.names, "expected_grade", "tail_probability", "kept"]
            )

    return text_batches(docs).mapInArrow(predict, docs.withColumns({"expected_grade": F.lit(0.0), "tail_probability": F.lit(0.0), "kept": F.lit(True)}).schema)


def toxicity_aware_grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0: toxic; 1: poor, not toxic; 2: good, not toxic; null where the quality is not known
    and the text is not known to be toxic."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 1, 2).when(F.col(quality) == 0, 1)
