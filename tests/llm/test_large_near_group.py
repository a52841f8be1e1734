"""One large group of near copies: the work of each step is bounded by its documents, and no link is lost."""

import numpy as np

from test_operators import near_by_pairs
from tidemark.llm import near_dedup
from tidemark.operators import graph


def test_rows_of_every_step_follow_the_group(spark, monkeypatch):
    made = {}
    write = near_dedup.durable

    def counted(df, name):
        out = write(df, name)
        made.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "durable", counted)
    monkeypatch.setattr(graph, "durable", counted)

    def rows_of(n):
        rng = np.random.default_rng(12)
        base, rows = [f"w{i}" for i in rng.integers(0, 9000, 80)], []
        for k in range(n):
            words = base.copy()
            for i in rng.integers(0, 80, int(rng.integers(0, 6))):
                words[int(i)] = f"own{k}x{i}"
            rows.append((k, " ".join(words)))
        return rows

    sums = []
    for n in (100, 400):
        made.clear()
        rows = rows_of(n)
        got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == near_by_pairs(rows)
        sums.append({k: sum(v) for k, v in made.items()})
    for name, n in sums[1].items():
        assert n <= 73 * 400 and n <= max(4 * 400, 8 * sums[0].get(name, 0)), (name, n, sums[0].get(name))
