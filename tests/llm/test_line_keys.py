"""Line dedup where unlike lines share keys: every link is found all the same."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import line_dedup


@pytest.mark.parametrize("mask", [0, 3, (1 << 32) - 1])
def test_colliding_keys_hide_no_line(spark, monkeypatch, mask):
    monkeypatch.setattr(line_dedup, "_MASK", mask)
    rng = np.random.default_rng(8)
    base = ["".join(rng.choice(list("abcdef "), 30)).replace(" ", "_") for _ in range(6)]
    lines = []
    for k in range(60):
        s = base[k % 6]
        for _ in range(int(rng.integers(0, 3))):
            i, kind = int(rng.integers(0, len(s))), int(rng.integers(0, 3))
            s = s[:i] + ("", "#", "#" + s[i])[kind] + s[i + 1 :]
        lines.append(s)

    def close(a, b):
        if a == b:
            return True
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    want = [i for i, s in enumerate(lines) if any(close(s, t) for t in lines[:i])]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    assert 10 < len(want) < 60
    assert sorted(r.doc_id for r in line_dedup.line_dedup(df).filter(F.size("dropped_lines") > 0).collect()) == want
