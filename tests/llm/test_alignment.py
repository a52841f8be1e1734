"""Alignment of tokenizers against offsets compared one by one, through the table of common pairs and through the join."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, entry

A, B = entry.tokenizer_file(), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello world, it's a fine day.", "Hello world", None, "", " ", "  two  blanks \n\n lines\t", "<|endoftext|> and <s> are text", "a▁b is read as a blank", "日本語 の テキスト と 😀 😀x", "é à ü ñ été", "a\x1cb \x00 nul",
    "x" * 5000, "Hello world", "don't can't 1234567 !!??", "﻿bom　wide blank", " leads", "ends ", "a" + " " * 300 + "b", "one two three",
]
SCHEMA = "doc_id long, text string, n_a string, pairs int, key int, row int, times int"


def brute(texts):
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    printable = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = [b for b in range(256) if b not in printable.values()]
    printable |= {chr(256 + i): b for i, b in enumerate(rest)}
    found = []
    for t in texts:
        if not t:
            found.append(None)
            continue
        a, b = one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)
        as_bytes = [bytes(printable[c] for c in one.id_to_token(i)) for i in a], [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, two.id_to_piece(i)) for i in b)]
        if any(b"".join(x) != (" " + t).encode() for x in as_bytes):
            found.append(None)
            continue
        ends = [[sum(map(len, x[: i + 1])) for i in range(len(x))] if len(x) < 400 else __import__("itertools").accumulate(map(len, x)) for x in as_bytes]
        ends = [{e: i for i, e in enumerate(x)} for x in ends]
        groups, links, i, j = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            p, q = ends[0][e] + 1, ends[1][e] + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        found.append((len(a), len(b), links, ";".join(groups)))
    counts = Counter(x for f in found if f for x in f[2])
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [
        (0, 0, 0, 0, 0, 0, "") if f is None else (f[0], f[1], len(f[2]), len(f[2]), sum(counts[x] == best[x[1]] for x in f[2]), sum(counts[x] for x in f[2]), hashlib.sha256(f[3].encode()).hexdigest()) for f in found
    ]


@pytest.mark.parametrize("table", [alignment.TABLE, 40, 0])
def test_against_offsets(spark, monkeypatch, table):
    monkeypatch.setattr(alignment, "TABLE", table)
    df = spark.createDataFrame([(i, t, "mine", 1, 2, 3, 4) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.align_tokenizers(df, A, B).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute(TEXTS)
    assert {i for i in got if got[i][0] == 0} == {2, 3, 7}


def test_query_over_whole_tables(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in entry.op13_align_tokenizers(spark, sf_dir).collect()}
    assert [got[i] for i in docs] == brute(docs.values())


def test_repeated_and_missing_keys_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c"), (None, "a b"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_links) for r in alignment.align_tokenizers(df, A, B).collect())
    assert got == [(0, 0), (0, 2), (1, 1), (1, 2)]
    assert alignment.align_tokenizers(df.limit(0), A, B).count() == 0


def test_long_runs(spark):
    texts = ["a" + c * 1_000_000 + "b" for c in (" ", "\n", "a", "1", "!")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    got = {r.doc_id: (r.n_a, r.n_b) for r in alignment.align_tokenizers(df, A, B).collect()}
    assert got == {i: (len(one.encode(" " + t).ids), len(two.encode(t))) for i, t in enumerate(texts)}


def test_transducer_keeps_its_transitions_in_bounds(monkeypatch):
    pieces = [b"a", b"ab", b"b", b"abc", b"c", b"bc"]
    t = alignment.Transducer(pieces, pieces)
    assert t.run([1, 4, 0], [0, 5, 0]) == (b"1,4|0,5;0|0", (4 << 32 | 5).to_bytes(8, "little") + (0).to_bytes(8, "little"))
    assert t.run([1], [0]) is None and t.run([0], [1]) is None and t.run([0], [2]) is None and t.run([], []) == (b"", b"") and t.run([], [0]) is None
    monkeypatch.setattr(alignment, "KEPT_STEPS", 1)
    assert t.run([3], [0, 2, 4]) == (b"3|0,2,4", (3 << 32 | 4).to_bytes(8, "little")) and t.run([3], [1, 4])[0] == b"3|1,4"
