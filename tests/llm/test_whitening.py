"""Whitening against exact fractions and numpy, with vectors that must be dropped, copies, huge entries and odd lengths."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import entry, whitening

SCHEMA = "vec_id long, embedding array<float>, key string, x int, component string"


def brute(rows):
    """n, sums and exact covariance of the distinct integer vectors, and the rows that remain."""
    remain = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in remain})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    cov = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n**3) for j in range(d)] for i in range(d)]
    return remain, n, sums, np.array([[float(c) for c in r] for r in cov])


def held(got, rows, tolerance=1e-6):
    remain, n, sums, cov = brute(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(16, int((values > len(sums) * np.finfo(float).eps * values[0]).sum()))
    assert len(got) == k * len(remain)
    assert {r.n for r in got} == {n} and all(abs(r.identity_error) <= 1e-6 for r in got)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, x in remain:
        for c in range(k):
            r = by[i, c + 1][0]
            assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
            assert math.isclose(r.explained, values[c] / np.trace(cov), rel_tol=1e-9)
            want = float(np.dot([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)], vectors[:, c]) / math.sqrt(values[c]))
            if abs(want) > 1e-3:
                sign = signs.setdefault(c, math.copysign(1, r.whitened * want))
                assert math.isclose(r.whitened, sign * want, rel_tol=tolerance, abs_tol=tolerance)


def test_against_fractions(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 1 + k) for k in range(6)]) for i in range(60)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (100, rows[3][1]), (102, None), (103, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (104, [math.nan] * 6), (105, [math.inf] + [0.0] * 5), (106, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "mine", 1, "mine") for i, v in rows], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    assert set(whitening.whiten(df).columns) == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    held([r for r in got if r.vec_id != 100], [(i, v) for i, v in rows if i not in (100, 106)])
    assert sorted({r.deviation for r in got if r.vec_id == 100}) == sorted({r.deviation for r in got if r.vec_id in (0, 3)})


def test_query_against_fractions(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    remain, n, sums, cov = brute(rows)
    got = entry.op11_whiten(spark, sf_dir).collect()
    assert len(got) == 16 * len(remain) and {r.n for r in got} == {n}
    want = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)) for i, x in remain}
    assert all(r.deviation == want[r.vec_id] for r in got)
    values = np.linalg.eigvalsh(cov)[::-1]
    assert all(math.isclose(r.explained, values[r.component - 1] / np.trace(cov), rel_tol=1e-9) and r.identity_error < 1e-9 for r in got)
    table = np.zeros((len({i for i, _ in remain}), 16))
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
    fit = np.array([table[i] for i in {x: i for i, x in remain}.values()])
    assert np.abs(np.cov(fit.T, bias=True) - np.eye(16)).max() < 1e-9


def test_empty_equal_and_huge(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "", 1, ""), (2, [], "", 1, "")], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], "", 1, "")] * 3, SCHEMA)).count() == 0
    rows = [(1, [1e12, -3e12, 1.0]), (2, [-1e12, 5e12, 2.0]), (3, [2e12, 1e12, -7.0]), (4, [1e30, 1.0, 1.0]), (5, [3e15, 1e15, 2.0])]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    got = whitening.whiten(spark.createDataFrame([(i, v, "", 1, "") for i, v in rows], SCHEMA)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3, 5} and {r.n for r in got} == {4} and all(r.deviation is None or r.deviation >= 0 for r in got)


@pytest.mark.parametrize("bits", [3, 20, 21, 22, 41, 42, 43, 61])
def test_products_are_exact(bits):
    draw = random.Random(bits)
    x = np.array([[draw.randrange(-(1 << bits), 1 << bits) for _ in range(4)] for _ in range(200)], dtype=np.int64)
    x[:8] = [[(1 << bits) - 1] * 4, [-(1 << bits)] * 4] * 4
    want = [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(4)] for i in range(4)]
    assert whitening.gram(x).tolist() == want
    top = np.full((whitening.BLOCK_ROWS, 2), (1 << bits) - 1, dtype=np.int64)
    assert whitening.gram(top).tolist() == [[whitening.BLOCK_ROWS * ((1 << bits) - 1) ** 2] * 2] * 2
    assert whitening.unpacked(whitening.packed([-5, 0, 1 << 200])) == [-5, 0, 1 << 200]
