"""A source of many documents spares no line that a small one removes."""

from pyspark.sql import functions as F

from tidemark.llm import quality_rules


def test_lines_of_a_hot_source_are_removed(spark):
    i = F.col("id")
    own = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("own"), i.cast("string"), F.lit("x"), k.cast("string"))), " ")
    shared, rare = " ".join(f"menu{k}" for k in range(200)), "nineteen have this"
    tail = F.when(i < 20, f"\n{shared}").when(i < 39, f"\n{rare}").otherwise("")
    hot = spark.range(10_000).select(i.alias("doc_id"), F.concat(own, tail).alias("text"), F.lit("hot").alias("source"))
    low = hot.filter("doc_id < 500").withColumns({"doc_id": F.col("doc_id") + 20_000, "source": F.lit("small")})
    got = {r.doc_id: r for r in quality_rules.quality_rules(hot.unionByName(low)).collect()}
    assert len(got) == 10_500
    for at in (0, 20_000):
        assert {k - at for k, r in got.items() if at <= k < at + 20_000 and r.removed_words} == set(range(20))
        assert got[at].removed_words == 200 and not got[at].kept and "menu" not in got[at].clean_text and got[at + 20].kept
