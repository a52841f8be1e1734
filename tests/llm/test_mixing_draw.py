"""Systematic draws: every source comes as near to its target as its largest document, and no document has a better chance."""

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import mixing


def test_no_source_strays_by_more_than_its_largest_document(spark):
    rng = np.random.default_rng(9)
    rows, at = [], 0
    for s in range(40):
        for _ in range(10 if s < 30 else 400):
            rows.append((at, f"s{s:02}" if s else None, " ".join(["w"] * int(rng.integers(0, 300)))))
            at += 1
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    plan = mixing.mixing_plan(df).collect()
    assert len(plan) == len(rows)
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in plan:
        taken[r.source] += r.copies * r["size"]
        target[r.source], largest[r.source] = r.target, max(largest[r.source], r["size"])
        rate = r.target / r.source_size
        assert int(rate) <= r.copies <= int(rate) + 1 and r.copies <= 3
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in target)


def test_one_size_and_a_hot_source(spark):
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 2)).alias("source"), F.lit("a b c").alias("text"))
    for r in mixing.mixing_plan(df).groupBy("source", "target").agg(F.sum(F.col("copies") * 3).alias("taken")).collect():
        assert abs(r.taken - r.target) <= 3


def test_each_document_has_the_same_chance(spark):
    words = lambda i: " ".join(["w"] * (1 + i))
    df = spark.createDataFrame([(20 * k + i, f"s{k:03}", words(i)) for k in range(240) for i in range(20)], "doc_id long, source string, text string")
    off = defaultdict(list)
    for r in mixing.mixing_plan(df).collect():
        off[r["size"]].append(r.copies - r.target / r.source_size)
    assert len(off) == 20 and max(abs(np.mean(x)) for x in off.values()) < 0.12
