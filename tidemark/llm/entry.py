"""Queries over the text tables and their SQL, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .dedup_exact import exact_dedup
from .language import identify_language, train_language_model
from .language_model import score_texts, train_language_model as train_maxent
from .line_dedup import line_dedup
from .mixing import mixing_plan
from .near_dedup import near_duplicates
from .packing import pack
from .pii import KINDS, detect_pii, joined
from .quality_model import grade_quality, toxicity_aware_grade, train_quality_model
from .quality_rules import quality_rules
from .sharding import shard_documents
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SQL["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


def held_out():
    """Documents that no model learns from. A row without an id is learned from by none either, but is not in this set."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train_language_model(docs, F.col("doc_id").isNotNull() & ~held_out())
    return identify_language(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_file()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


SQL["op5_minhash"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM d),
c AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM s WHERE len(s) > 0 GROUP BY s),
i AS (SELECT rep, n, unnest(s) AS x FROM c),
p AS (SELECT a.rep AS a, b.rep AS b FROM i a JOIN i b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n) GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT rep AS node, rep AS label FROM c UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node WHERE r.label < e.b),
k AS (SELECT node, min(label) AS label FROM r GROUP BY 1)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(k.label, s.doc_id) AS component_id, coalesce(k.label, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.s = s.s LEFT JOIN k ON k.node = c.rep
"""


@query
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing_plan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL["op6_mix_sources"] = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY source_size * 3 / weight, source NULLS LAST) AS place FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM r),
f AS (SELECT level FROM l WHERE level * weight <= 3 * source_size ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, least((SELECT level FROM f) * weight, (3 * source_size)::DOUBLE) AS target FROM w),
z AS (
  SELECT doc_id, d.source, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, 'none:' || coalesce(d.source || ':', '') || size)), 1, 15))::BIGINT AS h,
    ('0x' || substr(md5('mix|' || coalesce('=' || d.source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
g AS (SELECT source, size, rate - floor(rate) AS part, u, count(*) AS n FROM z GROUP BY ALL),
q AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM g),
k AS (SELECT source, size, floor(part * (before + n) + u) - floor(part * before + u) AS due FROM q)
SELECT doc_id, z.size, source_size, target,
  z.size * (floor(rate)::BIGINT + CASE WHEN rank() OVER (PARTITION BY z.source, z.size ORDER BY h) <= due THEN 1 ELSE 0 END) AS taken
FROM z JOIN k ON z.source IS NOT DISTINCT FROM k.source AND z.size = k.size
"""


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_pii(documents(spark, sf_dir).select("doc_id", "text")).withColumn("base", F.filter("pii", lambda s: ~s["disguised"]))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"))


@query
def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = shard_documents(documents(spark, sf_dir))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(documents(spark, sf_dir).select("doc_id", "source", "text"), clean=False)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


@query
def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ratings = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out()).select("doc_id", toxicity_aware_grade().alias("grade"))
    model = train_quality_model(docs, ratings, levels=3)
    return grade_quality(docs, model).select("doc_id", held_out().alias("held_out"), "expected_grade", "tail_probability", "kept")


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(documents(spark, sf_dir).select("doc_id", "text"), clean=False)
    return found.select("doc_id", "n_lines", F.size("dropped_lines").cast("long").alias("n_dropped"), F.array_join(F.col("dropped_lines").cast("array<string>"), ",").alias("dropped"))


SQL["op3_line_dedup"] = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS number FROM d),
u AS (SELECT line, length(line) AS n, min(struct_pack(d := doc_id, k := number)) AS place FROM l WHERE length(line) >= 24 OR regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY 1, 2),
p AS (
  SELECT a.line FROM u a JOIN u b ON a.n >= 24 AND b.n >= 24 AND b.n BETWEEN a.n - 1 AND a.n + 1 AND b.place < a.place
    AND (left(a.line, (least(a.n, b.n) // 2)::BIGINT) = left(b.line, (least(a.n, b.n) // 2)::BIGINT)
      OR right(a.line, (least(a.n, b.n) // 2)::BIGINT) = right(b.line, (least(a.n, b.n) // 2)::BIGINT))
  WHERE CASE WHEN a.n = b.n
    THEN len(list_filter(list_zip(string_split(a.line, ''), string_split(b.line, '')), lambda x: x[1] <> x[2])) = 1
    ELSE len(list_filter(range(0, greatest(a.n, b.n)), lambda i:
      CASE WHEN a.n > b.n THEN left(a.line, i) || substr(a.line, i + 2) = b.line ELSE left(b.line, i) || substr(b.line, i + 2) = a.line END)) > 0 END
),
x AS (
  SELECT doc_id, number FROM l JOIN u USING (line)
  WHERE struct_pack(d := doc_id, k := number) <> place OR line IN (SELECT line FROM p)),
g AS (SELECT doc_id, count(*) AS n_dropped, string_agg(number::VARCHAR, ',' ORDER BY number) AS dropped FROM x GROUP BY 1)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, coalesce(dropped, '') AS dropped
FROM d LEFT JOIN g USING (doc_id)
"""


SQL["op8_quality_rules"] = """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS c FROM g),
m AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM h WHERE c > 1) GROUP BY 1),
l AS (
  SELECT doc_id, source, raw, array_to_string(regexp_extract_all(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), ' ') AS line,
    len(regexp_extract_all(raw, '[^\\x20\\x09-\\x0D]+')) AS n FROM (SELECT doc_id, source, unnest(ls) AS raw FROM d)),
u AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n_dup_lines FROM l WHERE n > 0 GROUP BY 1),
f AS (
  SELECT coalesce('=' || source, '') AS host, line FROM l WHERE n > 0 GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 20),
x AS (SELECT doc_id, sum(n) AS removed FROM l JOIN f ON f.host = coalesce('=' || source, '') AND f.line = l.line WHERE n > 0 GROUP BY 1),
a AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS removed_words
  FROM d LEFT JOIN m USING (doc_id) LEFT JOIN u USING (doc_id) LEFT JOIN x USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - removed_words >= 0.4 * n_words AS kept FROM a
"""


@query
def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scored = score_texts(docs, train_maxent(docs, F.col("doc_id").isNotNull() & ~held))
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return align_tokenizers(documents(spark, sf_dir), tokenizer_file(), public_tokenizers.path("piece_bpe_32k.model"))
