"""Every operator against plain Python on small tables with nulls, ties, repeats, long and empty texts."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import dedup_exact, entry, language, line_dedup, mixing, near_dedup, packing, pii, quality_model, quality_rules, sharding
from tidemark.llm.tokenize import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LINE = "the quick brown fox jumps over the lazy dog and runs on"
BODY = " ".join(f"word{i} alpha{i * 7 % 13} beta{i * 5 % 11}" for i in range(120))

#: doc_id, text, lang, source, n_chars, and columns named like those that operators add.
ROWS = [
    (1, BODY, "en", "a", 1), (2, BODY, "en", "a", 1), (3, BODY.replace("word7 ", "other "), "en", "b", 1), (4, None, None, "a", None), (5, "", "en", None, 0), (6, "   \n\t ", "de", "b", 6),
    (7, "one two", "en", "b", 7), (8, "one two", "en", "b", 7), (9, f"{LINE}\n{LINE}x\nshort\n{LINE}", "en", "a", 3), (10, "ünïcödé 日本語 " * 4000, "fr", "c", 9), (10, BODY, "fr", "c", 9),
    (None, BODY, "en", "a", 1), (11, LINE + "\n" + LINE[1:], None, "d", 4), (12, "<|endoftext|> a  b   c\n\n d's", "en", "d", 5), (12, "<|endoftext|> a  b   c\n\n d's", "en", "d", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    clash = {c: F.lit("mine") for c in ("digest", "keep_id", "kept", "size", "target", "copies", "shard", "slot", "pii", "score", "n_words", "n_lines", "clean_text", "length", "start", "row", "key", "source_size", "lang_pred", "expected_grade", "tail_probability", "removed_words", "base_failed", "dropped_lines", "component_id", "n_shingles", "sequence_id", "offset", "doc_tokens", "text_crc32", "bucket", "node")}
    return df.withColumns(clash).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, empty):
    got = dedup_exact.exact_dedup(docs).collect()
    assert len(got) == len(ROWS)
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[t or ""].append(i)
    for r in got:
        ids = groups[r.text or ""]
        assert r.keep_id == max(i for i in ids if i is not None)
        assert r.group_size == len(ids)
        assert r.kept == (r.doc_id == r.keep_id)
        assert bytes(r.digest) == hashlib.sha256((r.text or "").encode()).digest()
    assert dedup_exact.exact_dedup(empty).count() == 0


def test_exact_dedup_against_a_given_history(spark):
    old = spark.createDataFrame([(1, "x"), (9, "y")], "doc_id long, text string")
    new = spark.createDataFrame([(5, "x"), (6, "y"), (7, "z"), (8, "z")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in dedup_exact.exact_dedup(new, old).collect()}
    assert got == {5: (5, 2, True), 6: (9, 2, False), 7: (8, 2, False), 8: (8, 2, True)}


def test_dropping_repeats(docs):
    kept = dedup_exact.exact_dedup(docs.drop("kept", "digest", "keep_id")).filter("kept").select("doc_id", "text", "source")
    got = dedup_exact.drop_repeats(docs)
    assert got.columns == docs.columns and sorted(map(str, got.select("doc_id", "text", "source").collect())) == sorted(map(str, kept.collect()))


def test_minimal_perfect_hash():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(3000)), dtype="<u8").reshape(-1, 4)
    sizes, bits = dedup_exact.build_function(digests[:2000])
    assert sorted(dedup_exact.slots_of(digests[:2000], sizes, bits)) == list(range(2000))
    assert dedup_exact.slots_of(digests[2000:], sizes, bits).max() < 2000
    with pytest.raises(ValueError):
        dedup_exact.build_function(np.concatenate([digests[:5], digests[:1]]))


def test_packing_holds_every_token_once(docs, empty):
    path = entry.tokenizer_file()
    library = Encoder(path).library
    got = packing.pack(docs, path).collect()
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, *_ in ROWS)
    by_doc = defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert len(ids) == r.length and r.offset + r.length <= packing.SEQUENCE
        by_doc[r.doc_id].append((r.start, r.doc_tokens, ids))
    for key in {i for i, _ in want}:
        docs_of = Counter({ids: n for (i, ids), n in want.items() if i == key})
        assert Counter(x for ids, n in docs_of.items() for x in ids * n) == Counter(x for _, _, ids in by_doc[key] for x in ids)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
    assert packing.pack(empty, path).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
@settings(max_examples=60, deadline=None)
def test_pack_histogram(counts):
    patterns = packing.pack_histogram(counts, 64)
    placed = Counter()
    for n, lengths in patterns:
        assert sum(lengths) <= 64 and n > 0
        for x in lengths:
            placed[x] += n
    assert placed == Counter(counts)
    ranks = defaultdict(list)
    for length, low, high, _, _ in packing.slots(patterns):
        ranks[length] += range(low, high)
    assert all(sorted(r) == list(range(counts[k])) for k, r in ranks.items())


@given(st.text(alphabet=st.sampled_from(" \n\tabé1'sdt.<|>endoftx²ªØ日ß\x1c\x85\xa0　"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_the_library(text):
    e = Encoder.of_worker(entry.tokenizer_file())
    assert np.frombuffer(e.encode_one(text), dtype="<u4").tolist() == e.library.encode(text, add_special_tokens=False).ids


def test_line_dedup(docs, empty):
    got = {(r.doc_id, r.text): r for r in line_dedup.line_dedup(docs).collect()}
    r = got[9, ROWS[8][1]]
    assert r.dropped_lines == [1, 3] and r.clean_text == f"{LINE}\nshort" and r.n_lines == 4
    assert got[11, ROWS[12][1]].dropped_lines == [0, 1]
    assert got[4, None].n_lines == 1 and got[4, None].dropped_lines == []
    assert got[None, BODY].dropped_lines == [0] and got[1, BODY].dropped_lines == [] and got[2, BODY].dropped_lines == [0]
    assert got[3, ROWS[2][1]].dropped_lines == []  # five characters apart
    assert line_dedup.line_dedup(empty).count() == 0


def test_line_dedup_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = ["abcdefghijklmnopqrstuvwxyz 0123456789", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "zyxwvutsrqponmlkjihgfedcbaé日本" * 3]

    def edit(s):
        i, kind = int(rng.integers(0, len(s))), int(rng.integers(0, 3))
        return s[:i] + ("", "#", "#" + s[i])[kind] + s[i + 1 :]

    lines = []
    for _ in range(150):
        s = base[int(rng.integers(0, 3))]
        for _ in range(int(rng.integers(0, 4))):
            s = edit(s)
        lines.append(s)

    def close(a, b):
        if a == b:
            return True
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    want = [i for i, s in enumerate(lines) if len(s) >= 24 and any(close(s, t) for t in lines[:i] if len(t) >= 24)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "doc_id long, text string")
    assert sorted(r.doc_id for r in line_dedup.line_dedup(df).filter(F.size("dropped_lines") > 0).collect()) == want


PLAIN = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")), ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")), ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def plain_by_regex(text):
    out = []
    for kind, pattern in PLAIN:
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum((int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9)) for i, c in enumerate(digits[::-1])) % 10 == 0
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out)


@given(st.text(alphabet=st.sampled_from("a1@.+ -9(4%)_Z\n05é"), max_size=80))
@settings(max_examples=500, deadline=None)
def test_plain_spans(text):
    assert sorted(pii.plain_spans(text)) == plain_by_regex(text)
    assert {s[:3] for s in pii.find_spans(text) if not s[3]} == set(plain_by_regex(text))


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("mail john [at] example [dot] com now", "email", "john [at] example [dot] com"), ("jane dot doe at mail dot example dot org", "email", "jane dot doe at mail dot example dot org"),
        ("x jоhn@exаmple.com y", "email", "jоhn@exаmple.com"), ("john＠example．com", "email", "john＠example．com"), ("4​111 1111 1111 1111", "card", "4​111 1111 1111 1111"),
        ("card four one one one one one one one one one one one one one one one end", "card", "four one one one one one one one one one one one one one one one"),
        ("ip one nine two dot one six eight dot one dot one ok", "ip", "one nine two dot one six eight dot one dot one"),
        ("call plus four nine one seven six one two three four five six eight now", "phone", "plus four nine one seven six one two three four five six eight"), ("nr ٤١١١ 1111 1111 1111", "card", "٤١١١ 1111 1111 1111"),
        ("pay 4lll-1111-1111-1111 now", "card", "4lll-1111-1111-1111"), ("at l92.168.1O.21 there", "ip", "l92.168.1O.21"),
    ],
)
def test_disguises(text, kind, found):
    assert [(k, text[a:b]) for k, a, b, hidden in pii.find_spans(text) if hidden] == [(kind, found)]


@pytest.mark.parametrize("text", ["look at example.com and dot the i", "we met at noon, one or two of us", "plus one more", "Привет, как дела? 12.05.2024"])
def test_clean_text_has_no_spans(text):
    assert pii.find_spans(text) == []


def test_pii_operator(docs, empty):
    got = pii.detect_pii(docs).collect()
    assert len(got) == len(ROWS) and all(r.pii == [] for r in got if not r.text)
    assert pii.detect_pii(empty).count() == 0


def near_by_pairs(rows):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(fold))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if None not in (rows[i][0], rows[j][0]) and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)), key=lambda x: rows[x][0])
                root[b] = a
    return sorted(((i, len(s), rows[find(k)][0]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def test_near_duplicates(docs, empty, spark):
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_by_pairs([r[:2] for r in ROWS])
    assert near_dedup.near_duplicates(empty).count() == 0
    kept = near_dedup.drop_near_duplicates(docs)
    first = {c: i for i, _, c in near_by_pairs([r[:2] for r in ROWS])}
    own = [r for r in ROWS if r[0] is None or r[0] not in (2, 3, 8) and not (r[0] == 10 and r[1] == BODY)]
    assert kept.columns == docs.columns and set(first)
    assert sorted(((r.doc_id, r.text, r.source, r.kept, r["component_id"]) for r in kept.collect()), key=str) == sorted(((r[0], r[1], r[3], "mine", "mine") for r in own), key=str)


def test_near_duplicates_in_chains(spark):
    rng = np.random.default_rng(11)
    rows, vocabulary = [], [f"w{i}" for i in range(5000)]
    for g in range(12):
        words = [vocabulary[i] for i in rng.integers(0, 5000, 90)]
        for k in range(12):
            rows.append((len(rows), " ".join(words).upper() if k % 3 == 0 else " ".join(words)))
            words = words.copy()
            for i in rng.integers(0, 90, 1 + g % 3):
                words[int(i)] = f"new{len(rows)}x{i}"
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_by_pairs(rows)


def test_mixing(docs, empty, spark):
    got = mixing.mixing_plan(docs).collect()
    assert len(got) == len(ROWS)
    sizes = defaultdict(int)
    for _, t, _, s, _ in ROWS:
        sizes[s] += len(WORD.findall(t or ""))
    for r in got:
        assert r.size == len(WORD.findall(r.text or "")) and r.source_size == sizes[r.source] and r.copies <= 3
        assert r.target <= 3 * sizes[r.source] + 1e-9
    targets = {r.source: r.target for r in got}
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1e-6 or all(abs(t - 3 * sizes[s]) < 1e-9 for s, t in targets.items())
    mixed = mixing.mix_sources(docs)
    want = Counter({(r.doc_id, r.text, r.source): 0 for r in got}) + Counter(x for r in got for x in [(r.doc_id, r.text, r.source)] * r.copies)
    assert mixed.columns == docs.columns and Counter((r.doc_id, r.text, r.source) for r in mixed.collect()) == want
    assert {(r["size"], r.target, r.copies, r.source_size) for r in mixed.collect()} <= {("mine",) * 4}
    assert sorted(map(str, mixing.mixing_plan(docs).select("doc_id", "text", "copies").collect())) == sorted(map(str, mixing.mixing_plan(docs.repartition(5)).select("doc_id", "text", "copies").collect()))
    assert mixing.mixing_plan(empty).count() == 0
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x y z").alias("text"), F.when(F.col("id") % 3 == 0, "s1").when(F.col("id") % 3 == 1, "s2").alias("source"))
    for r in mixing.mixing_plan(many).groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect():
        assert abs(r.taken - r.target) < 0.12 * r.target


def test_sharding(docs, empty):
    placed, cuts = sharding.shard_documents(docs)
    got = placed.collect()
    assert len(got) == len(ROWS) and len(cuts) == 7
    slots, load, groups = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
        groups[bytes(r.digest)].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(g) == 1 for g in groups.values())
    sizes = defaultdict(int)
    for _, t, *_ in ROWS:
        sizes[hashlib.sha256((t or "").encode()).digest()] += len((t or "").encode()) + 1
    assert Counter((r.text_crc32, r["size"]) for r in got) == Counter((zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for _, t, *_ in ROWS)
    ordered = [sizes[k] for k in sorted(sizes)]

    def fits(c):
        n, a = 1, 0
        for v in ordered:
            n, a = (n + 1, v) if a + v > c else (n, a + v)
        return n <= 8

    assert max(load.values()) == next(c for c in range(max(ordered), sum(ordered) + 1) if fits(c))
    assert sharding.shard_documents(empty)[0].count() == 0


def test_quality_rules(docs, empty):
    got = quality_rules.quality_rules(docs).collect()
    assert len(got) == len(ROWS)
    for r in got:
        t = r.text or ""
        w = WORD.findall(t)
        triples = Counter(zip(w, w[1:], w[2:], strict=False))
        marked = {i + k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked))
        assert r.base_failed == (len(w) < 50 or 100 * len(marked) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality_rules.quality_rules(empty).count() == 0


def test_frequent_lines_are_removed(spark):
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    shared = " ".join(f"menu{k}" for k in range(200))
    rows = [(i, f"{own(i)}\n{shared}\nShare  This page" if i < 30 else f"{own(i)}\nshare this PAGE", "host") for i in range(60)] + [(99, f"{own(99)}\n{shared}", "other")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].removed_words == 203 and not got[0].kept and got[0].clean_text == own(0)
    assert got[40].removed_words == 3 and got[40].kept and got[99].removed_words == 0 and got[99].kept


def test_language(docs, empty, spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train_language_model(table, ~entry.held_out())
    got = language.identify_language(table, model).filter(entry.held_out())
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()
    odd = language.identify_language(docs, model).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in odd)
    assert language.identify_language(empty, model).count() == 0
    nothing = language.train_language_model(empty, F.lit(True))
    assert {r.lang_pred for r in language.identify_language(docs, nothing).collect()} == {"und"}


def test_quality_model(docs, empty, spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    rows = []
    for i in range(900):
        words = [word() for _ in range(40)]
        grade = i % 3
        if grade == 0:
            words[5] = "vile"
        if grade == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), grade))
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    learn = F.col("doc_id") < 600
    model = quality_model.train_quality_model(df.filter(learn).drop("grade"), df.filter(learn), 3)
    assert list(model.cuts) == sorted(model.cuts)
    got = quality_model.grade_quality(df, model).filter(~learn)
    share = {r.grade: r.k for r in got.groupBy("grade").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert share[0] < 0.05 and share[1] < 0.05 and share[2] > 0.95
    assert quality_model.grade_quality(docs, model).count() == len(ROWS) and quality_model.grade_quality(empty, model).count() == 0
    none = quality_model.train_quality_model(empty, df.limit(0), 3)
    assert quality_model.grade_quality(docs, none).count() == len(ROWS)


def test_pipeline_keeps_what_it_should(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["language"](spark, docs, sf_dir)
    assert kept.columns == docs.columns and kept.count() >= 0.95 * docs.count()
    once = steps["exact dedup"](spark, kept, sf_dir)
    assert once.count() == kept.select("text").distinct().count()
    near = steps["near dedup"](spark, once, sf_dir)
    rows = [(r.doc_id, r.text) for r in once.collect()]
    assert {r.doc_id for r in near.collect()} == {c for _, _, c in near_by_pairs(rows)}
    mixed = steps["mix"](spark, near, sf_dir)
    assert mixed.columns == docs.columns
    assert corpus_pipeline.run(spark, sf_dir).agg(F.sum("length")).first()[0] > 0
