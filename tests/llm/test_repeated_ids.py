"""A near copy takes no other text of its doc_id with it."""

from tidemark.llm import near_dedup

BODY = " ".join(f"word{i} alpha{i * 7 % 13} beta{i * 5 % 11}" for i in range(120))


def test_the_clean_row_of_a_repeated_id_stays(spark):
    rows = [(1, BODY), (10, BODY), (10, "ünïcödé 日本語 a text of its own that nobody else has"), (10, BODY + " end"), (11, BODY), (None, BODY), (12, None), (12, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = [rows[0], rows[2], *rows[5:]]
    got = near_dedup.drop_near_duplicates(df)
    assert got.columns == df.columns and sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))
