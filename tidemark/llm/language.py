"""Language identification in two steps: the family first, then one-versus-one linear
support vector machines among the languages of that family.

A text becomes hashed counts of its byte 1- to 4-grams over letters (anything
else is one space), square-rooted and brought to unit length. All of a text
counts, however long. Models are fitted on a bounded sample; prediction is one
pass over the table without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, small, text_batches
from .tokens import blocks, _LOWER, portions

DIMENSIONS = 4096
#: Labelled rows of a language that a fit takes, as an expected number.
SAMPLE_PER_LANGUAGE = 400
UNDETERMINED = "und"
#: Language codes of the families told apart first. A language that is
#: not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy af lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi bn ur mr gu pa ne",
    "semitic": "ar he mt",
}
_LETTER = re.compile(r"[^\W\d_]")
_GRAM = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]

_SYMBOL = _LOWER.copy()
_SYMBOL[[i for i in range(128) if not chr(i).isalpha()]] = 32


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def features(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """A unit vector for each text, or zeros for one without letters."""
    for _, data, offsets in blocks(column):
        symbol = _SYMBOL[data].astype(np.uint32)
        if len(symbol) > 1:  # one space for a run of them
            keep = np.ones(len(symbol), dtype=bool)
            keep[1:] = (symbol[1:] != 32) | (symbol[:-1] != 32)
            keep[offsets[:-1][offsets[:-1] < len(keep)]] = True  # but not across texts
            moved = np.concatenate([[0], np.cumsum(keep)])
            symbol, offsets = symbol[keep], moved[offsets]
        grams, total = [], np.zeros(len(symbol), dtype=np.uint32)
        for n in range(4):
            if n:
                total = total[:-1] if len(total) else total
            total = total * np.uint32(0x01000193) + (symbol[n:] + np.uint32(1)) * _GRAM[n]
            grams.append(((total ^ (total >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 12))
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            counts = np.zeros(DIMENSIONS, dtype=np.float32)
            for n, g in enumerate(grams):
                if b - n > a:
                    counts += np.bincount(g[a : b - n], minlength=DIMENSIONS)
            counts = np.sqrt(counts)
            norm = float(np.sqrt((counts * counts).sum()))
            yield counts / norm if norm else counts


def linear_svm(x: np.ndarray, y: np.ndarray, steps: int = 120, ridge: float = 1e-3) -> np.ndarray:
    """Weights and bias for y in {-1, 1}: squared hinge, classes weighed evenly, by
    accelerated gradient steps over all rows; deterministic."""
    x1 = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    w = v = np.zeros(x1.shape[1], dtype=x.dtype)
    for i in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ v))
        new = v - 0.2 * (ridge * v - 2 * (x1.T @ (share * y * slack)))
        v, w = new + i / (i + 3) * (new - w), new
    return w


@dataclass
class LanguageModel:
    languages: list[str]
    family_of: dict[str, str]
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str | None], np.ndarray]:
        """Languages and scores in [0, 1] of unit vectors; no learned language: None."""
        if not self.languages or not len(x):
            return [None] * len(x), np.zeros(len(x))
        x1 = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
        sure = lambda m: 1 / (1 + np.exp(-4 * np.clip(m, -20, 20)))
        if len(self.families) > 1:
            margins = x1 @ self.family_weights.T
            family = margins.argmax(axis=1)
            top = np.sort(margins, axis=1)
            score = sure((top[:, -1] - top[:, -2]) / 2)
        else:
            family, score = np.zeros(len(x), dtype=int), np.ones(len(x))
        out: list[str | None] = [None] * len(x)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            members = [k for k in self.languages if self.family_of[k] == name]
            votes, margin = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for i, j in combinations(range(len(members)), 2):
                m = x1[rows] @ self.pairs[members[i], members[j]]
                votes[:, i] += m > 0
                votes[:, j] += m <= 0
                margin[:, i] += m
                margin[:, j] -= m
            best = (votes + np.tanh(margin / 10) * 0.4).argmax(axis=1)
            for r, k in zip(rows, best, strict=True):
                out[r] = members[k]
            if len(members) > 1:
                score[rows] *= sure(margin[np.arange(len(rows)), best] / (len(members) - 1))
        return out, score


def family_lookup(languages: Iterable[str]) -> dict[str, str]:
    known = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
    return {k: known.get(k, k) for k in languages}


def fit_language_model(x: np.ndarray, languages: list[str]) -> LanguageModel:
    names = sorted(set(languages))
    model = LanguageModel(names, family_lookup(names))
    model.families = sorted({model.family_of[k] for k in names})
    label = np.array(languages, dtype=object)
    family = np.array([model.family_of[k] for k in languages], dtype=object)
    signs = lambda mask: np.where(mask, 1, -1).astype(np.float32)
    if len(model.families) > 1:
        model.family_weights = np.stack([linear_svm(x, signs(family == f)) for f in model.families])
    for a, b in combinations(names, 2):
        if model.family_of[a] == model.family_of[b]:
            rows = (label == a) | (label == b)
            model.pairs[a, b] = linear_svm(x[rows], signs(label[rows] == a))
    return model


def _featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches):
        rows = [x.astype("<f2").tobytes() for x in features(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(rows, pa.binary())], ["lang", "x"])


def bounded_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """About per_label rows of each label, chosen by a hash of the key; no sort, no shuffle of texts."""
    counts = durable(rows.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n")), "label-counts")
    share = F.least(F.lit(1.0), F.lit(float(per_label)) / F.col("_n"))
    draw = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(small(counts, counts.count()), F.col(label) == F.col("_label")).filter(draw < share).drop("_label", "_n")


def train_language_model(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on about per_language rows of each language among those that `learn` admits.
    Rows without text, letters or language are not learned from."""
    rows = docs.filter(learn).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).filter("lang is not null and text is not null")
    got = bounded_sample(text_batches(rows), "lang", "key", per_language).select("lang", "text").mapInArrow(_featurise, "lang string, x binary").collect()
    got = sorted((r["lang"], bytes(r["x"])) for r in got)
    x = np.stack([np.frombuffer(b, dtype="<f2").astype(np.float32) for _, b in got]) if got else np.zeros((0, DIMENSIONS), dtype=np.float32)
    used = x.any(axis=1) if len(x) else np.zeros(0, dtype=bool)
    return fit_language_model(x[used], [k for (k, _), u in zip(got, used, strict=True) if u])


def identify_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1).

    A text that is null or has no letter is `und` with score 0, and so is every
    text if the model knows no language. Nothing but the text is looked at; rows
    come back once each, in whatever order; an empty table gives an empty result.
    Columns of docs by the two names are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    where = docs.columns.index(text)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            vectors, names, scores = features(batch.column(where)), [], [np.zeros(0)]
            while part := list(islice(vectors, 256)):
                found, sure = model.predict(np.stack(part))
                names += found
                scores.append(sure)
            score = np.concatenate(scores)
            known = [k is not None and has_letter(t.as_py()) for k, t in zip(names, batch.column(where), strict=True)]
            names = [k if ok else UNDETERMINED for k, ok in zip(names, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0), pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    return text_batches(docs).mapInArrow(predict, docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)}).schema)
