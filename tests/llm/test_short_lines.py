"""Lines under the bound of the one-edit match are dropped for equal ones."""

from tidemark.llm import line_dedup


def test_equal_short_lines_are_dropped(spark):
    rows = [
        (1, "All rights reserved.\nle treque.\n\n   \n版权所有，保留所有权利。"), (2, "all rights reserved.\nle treque.\n\n   \nle treque,"), (3, "版权所有，保留所有权利。\nAll rights reserved.\nle treque.\n}"),
        (4, "x\n \nx\n" + "long enough for the one-edit match"), (5, "le treque.\nlong enough for the one edit match"), (None, "}"),
    ]
    got = {(r.doc_id, r.text): r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert {k: r.dropped_lines for k, r in got.items()} == dict(zip(rows, [[], [1], [0, 1, 2], [2], [0, 1], [0]], strict=True))
    assert got[rows[2]].clean_text == "}" and got[rows[1]].clean_text == "all rights reserved.\n\n   \nle treque,"
