"""From documents to packed training sequences, in five stages.

Every stage works on all that the one before it kept, and is written as Parquet
before the next one reads it. The language model is trained, so no SQL gives
these rows: ORACLE_SQL is None and tests hold the stages against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ARROW_ROWS, durable, scratch
from tidemark.llm.dedup_exact import drop_repeats
from tidemark.llm.entry import held_out, tokenizer_file
from tidemark.llm.language import UNDETERMINED, identify_language, train_language_model
from tidemark.llm.mixing import mix_sources
from tidemark.llm.near_dedup import drop_near_duplicates
from tidemark.llm.packing import pack

#: Below this score a text is as good as none of the learned languages; real prose scores far higher.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language: no letters, or no language that fits."""
    model = train_language_model(docs, F.col("doc_id").isNotNull() & ~held_out())
    own = {c: f"_own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = identify_language(docs.withColumnsRenamed(own), model)
    kept = found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the one with the largest doc_id."""
    return drop_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents until the sources have their target shares."""
    return mix_sources(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids, a row for each piece."""
    return pack(docs, tokenizer_file())


STAGES = [("language", language), ("exact dedup", exact), ("near dedup", near), ("mix", mix), ("pack", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. All stages are run and written here, so the session's size of Python's batches is set back at the end."""
    batch = spark.conf.get(ARROW_ROWS)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    try:
        for name, stage in STAGES:
            with scratch(spark) as kept:
                docs = durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
                kept.append(docs)
    finally:
        spark.conf.set(ARROW_ROWS, batch)
    return docs
