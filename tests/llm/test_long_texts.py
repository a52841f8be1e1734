"""Texts of several megabytes: hashes are those of short ones, and every operator on words takes them whole."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import dedup_exact, entry, language, line_dedup, mixing, near_dedup, packing, quality_model, quality_rules, sharding
from tidemark.llm.tokens import BLOCK, span_hashes, word_bounds


def test_hashes_in_parts():
    words = [f"W{i * 7919 % 10007}é" for i in range(500_000)]
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    assert len(data) > 3 * BLOCK
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    got = span_hashes(data, starts, ends)
    one = {w: int(span_hashes(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0]), np.array([len(w.encode())]))[0]) for w in words[:10007]}
    assert len(got) == len(words) and got.tolist() == [one[w] for w in words]
    giant = np.frombuffer(b"x" * (3 * BLOCK) + b" y", dtype=np.uint8)
    assert len(span_hashes(giant, *word_bounds(giant, np.array([0, len(giant)]))[:2])) == 2


def test_operators_take_them_whole(spark):
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(450_000))
    other = long + " end of the other one"
    rows = [(1, long, "a"), (2, other, "a"), (3, "short text of its own here", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in near_dedup.near_duplicates(df).collect()}
    assert (got[1].component_id, got[2].component_id, got[3].component_id) == (1, 1, 3) and got[2].n_shingles == got[1].n_shingles + 5
    facts = {r.doc_id: r for r in quality_rules.quality_rules(df, clean=False).collect()}
    assert facts[1].n_words == 450_000 and facts[2].n_words == 450_005 and facts[1].word_chars == len(long) - 449_999
    assert len(list(language.features(pa.array([long, None, other])))) == 3
    assert zlib.crc32(long.encode()) == df.filter("doc_id = 1").select(F.crc32(F.col("text").cast("binary"))).first()[0]


def test_rows_of_one_key_are_one_document(spark):
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    rows = [(7, f"{own(i)}\nthe same line", "h") for i in range(30)] + [(None, f"{own(i)}\na keyless line", "h") for i in range(30, 55)]
    got = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.removed_words for r in got if r.doc_id == 7} == {0} and {r.removed_words for r in got if r.doc_id is None} == {3}


def test_tokens_of_long_runs(spark):
    tokenizer = Tokenizer.from_file(entry.tokenizer_file())
    texts = ["a" + c * n + "b" for n in (10**6, 3 * 10**6) for c in (" ", "\n", "a", "1", "!")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {}
    for r in packing.pack(df, entry.tokenizer_file()).select("doc_id", "start", "ids", "doc_tokens").toLocalIterator():
        got.setdefault(r.doc_id, []).append((r.start, bytes(r.ids), r.doc_tokens))
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, packing.END], dtype="<u4")
        assert b"".join(x for _, x, _ in sorted(got[i])) == ids.tobytes() and {n for _, _, n in got[i]} == {len(ids)}


def test_other_operators_take_long_runs(spark):
    texts = ["a" + c * (3 * 10**6) + "b" for c in (" ", "\n", "a", "1", "!")]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate([*texts, texts[0]])], "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in dedup_exact.exact_dedup(df.select("doc_id", "text")).select("doc_id", "kept").collect()}
    assert kept == {0: False, 1: True, 2: True, 3: True, 4: True, 5: True}
    lines = {r.doc_id: (r.n_lines, list(r.dropped_lines)) for r in line_dedup.line_dedup(df.select("doc_id", "text"), clean=False).select("doc_id", "n_lines", "dropped_lines").collect()}
    assert lines[0] == (1, []) and lines[1][0] == 3 * 10**6 + 1 and lines[5] == (1, [0])
    sizes = {r.doc_id: r.size for r in mixing.mixing_plan(df).select("doc_id", "size").collect()}
    assert sizes == {0: 2, 1: 2, 2: 1, 3: 1, 4: 1, 5: 2}
    placed, _ = sharding.shard_documents(df)
    assert {(r.doc_id, r.size) for r in placed.select("doc_id", "size").collect()} == {(i, 3 * 10**6 + 3) for i in range(6)}
    ratings = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, grade int")
    model = quality_model.train_quality_model(df, ratings, levels=3)
    assert quality_model.grade_quality(df, model).count() == 6
