"""The language model: base scores in plain Python, probabilities that sum to one, scores from loops over the same weights, held-out gain."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import entry, language_model as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, word string, n int, row int, score string, key int"


def words(t):
    return [*WORD.findall((t or "").translate(FOLD)), None]


def base(rows, learned):
    counts = Counter(w for i, t in rows if learned(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    return n, {(i, t): (len(words(t)), sum(counts[w] > 0 for w in words(t)), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))) for i, t in rows}


TEXTS = ["The cat sat on the mat. The dog too", "the cat ate", None, "", "  ", "die Katze saß auf der Matte", "ÉCOLE école", "unseen words here", "a\x1fb c d", " ".join(f"w{i % 50}" for i in range(3000)), "x"] * 4


@pytest.mark.parametrize("table", [lm.TABLE, 16, 0])
def test_base_scores(spark, monkeypatch, table):
    monkeypatch.setattr(lm, "TABLE", table)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a second row of one key"), (None, "no key")]
    df = spark.createDataFrame([(i, t, "mine", 1, 2, "mine", 3) for i, t in rows], SCHEMA).repartition(3)
    learned = lambda i: i is not None and i % 3 > 0
    n, want = base(rows, learned)
    got = lm.score_texts(df, lm.train_language_model(df, F.col("doc_id").isNotNull() & (F.col("doc_id") % 3 > 0))).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    left = Counter((i, *want[i, t][:2], round(want[i, t][2], 6)) for i, t in rows)
    assert left == Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_probabilities_and_scores_by_loops(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = lm.train_language_model(docs, F.col("doc_id") % 7 != 2)
    table, counts = model.words, {r.word: r.n for r in model.counts.collect()}
    back = np.array([[5, lm.BEFORE], [800, lm.BEFORE], [1000, lm.BEFORE]])
    for k in range(2):
        every = np.arange(lm.BINS)
        total = 10 ** lm.log_chances(every, np.repeat(back[:, k : k + 1], lm.BINS, axis=1), model.weights)
        assert math.isclose(total.sum(), 1, rel_tol=1e-4)
    # Shares in a bin: the words learned from and one for all others make one.
    shares = Counter()
    ending = {r.word: r.ending for r in model.counts.collect()}
    at, hit = table.look_up(np.array(list(counts), dtype=np.int64).view(np.uint64))
    assert hit.mean() > 0.999  # a word may find both of its slots taken
    for w, a, h in zip(counts, at, hit, strict=True):
        b = int(table.bins[a]) if h else lm.SINGLES + ending[w]
        assert b < lm.SINGLES or b == lm.SINGLES + ending[w]
        shares[b] += 1 if b < lm.SINGLES else (counts[w] + 1) / 10 ** table.bin_logs[b]
    assert all(math.isclose(s + (0 if b < lm.SINGLES else 1 / 10 ** table.bin_logs[b]), 1, rel_tol=1e-9) for b, s in shares.items())
    rows = {r.doc_id: r.text for r in docs.limit(12).collect()}
    got = {r.doc_id: r.score for r in lm.score_texts(docs, model).collect()}
    for i, t in rows.items():
        (tok,) = lm.tokens(pa.array([t]))
        a, h = table.look_up(tok.words)
        bins = [int(table.bins[x]) if y else lm.SINGLES + int(e) for x, y, e in zip(a, h, tok.endings, strict=True)]
        score = 0.0
        for k, b in enumerate(bins):
            before = np.array([[bins[k - j] if k >= j else lm.BEFORE] for j in (1, 2, 3)])
            for w, r, truth in zip(model.weights, lm.feature_rows(before, np.array([b // lm.SIDE])), (b // lm.SIDE, b % lm.SIDE), strict=True):
                z = [sum(float(w[int(x[0]), c]) for x in r) for c in range(lm.SIDE)]
                score += (z[truth] - math.log(sum(map(math.exp, z)))) / math.log(10)
            if b >= lm.SINGLES:
                score += math.log10(counts.get(int(tok.words[k].view(np.int64)), 0) + 1) - table.bin_logs[b]
        assert math.isclose(score, got[i], rel_tol=1e-4)


def test_query_beats_the_base_where_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    n, want = base(rows, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    want = {i: want[i, t] for i, t in rows}
    got = entry.op12_language_model(spark, sf).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    for r in got:
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2] and math.isclose(r.base_score, want[r.doc_id][2], rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in got if r.held_out]
    bits = lambda c: -sum(getattr(r, c) for r in held) / sum(r.n_tokens for r in held) / math.log10(2)
    assert bits("score") < bits("base_score") - 1
    again = {r.doc_id: r.score for r in entry.op12_language_model(spark, sf).collect()}
    assert all(math.isclose(again[r.doc_id], r.score, rel_tol=1e-5) for r in got)


def test_no_rows_nothing_learned_and_long_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert lm.score_texts(df.limit(0), lm.train_language_model(df, F.lit(True))).count() == 0
    got = lm.score_texts(df, lm.train_language_model(df, F.lit(False))).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)} and all(math.isfinite(r.score) for r in got)
    texts = ["a" + c * 3_000_000 + "b" for c in (" ", "\n", "a")] + ["ab " * 1_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in lm.score_texts(df, lm.train_language_model(df, F.col("doc_id") < 3)).collect()}
    assert got == {0: 3, 1: 3, 2: 2, 3: 1_000_001}
