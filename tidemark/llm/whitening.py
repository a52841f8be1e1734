"""Whitening of vectors from exact covariances: digit-slice products, merged as big integers.

Entries become integers. A block of them is split into limbs of 21 bits, so that a product of two limbs, summed
over a block of at most 2048 rows, stays below 2^53 and float64 matrix products are exact. The products of all pairs of limbs are
put together as big integers, so sums over all rows are exact whatever their order and number. The
covariance is rounded once, from an exact fraction, and only then decomposed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable
from .tokens import portions

#: Fixed values of the contract: an entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
LIMB, BLOCK_ROWS = 21, 2048
#: Groups in which the tasks' sums are merged before the driver merges what is left.
MERGE_GROUPS = 32
#: Entries of larger size have no exact product with SCALE in a long.
LARGEST = float(1 << 56)
COMPONENTS = 16


class Whitener(NamedTuple):
    """n vectors with sums S (Python integers); components in rows by falling eigenvalue; only those whose eigenvalue is told from zero."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x as a sum of float64 arrays times 2^(21 k), k = 0, 1, ...; all but the last in 0 .. 2^21 - 1. Limbs that are zero throughout are left out at the end."""
    out, rest = [], x.astype(np.int64)
    while True:
        if len(rest) == 0 or (rest.min() >= -(1 << (LIMB - 1)) and rest.max() < 1 << LIMB):
            return [*out, rest.astype(np.float64)]
        out.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
        rest = rest >> LIMB


def gram(x: np.ndarray) -> np.ndarray:
    """x.T @ x of an integer array of at most BLOCK_ROWS rows, exactly, as Python integers."""
    parts = limbs(x)
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for i, a in enumerate(parts):
        for j in range(i, len(parts)):
            product = (a.T @ parts[j]).astype(np.int64).astype(object)
            total = total + ((product if i == j else product + product.T) << (LIMB * (i + j)))
    return total


def packed(values: Iterable[int]) -> str:
    """Big integers as text; sums of any size fit."""
    return ",".join(format(int(v), "x") for v in values)


def unpacked(text: str) -> list[int]:
    return [int(v, 16) for v in text.split(",")]


def vectors(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """key and x (array of longs) of the rows that remain."""
    c = F.transform(F.col(vector), lambda v: v.cast("double"))
    fine = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < LARGEST))
    found = rows.select(F.col(key).alias("key"), c.alias("c")).filter(F.col("c").isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size("c") > 0))
    return found.select("key", F.transform("c", lambda v: F.floor(v * SCALE).cast("long") + SHIFT).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each task: how many vectors, their sums and products."""
    n, sums, products = 0, 0, 0
    for batch in portions(batches, BLOCK_ROWS):
        x = _matrix(batch.column("x"))
        n += len(x)
        sums = sums + np.array([int(v) for v in x.astype(object).sum(axis=0)], dtype=object)
        products = products + gram(x)
    if n:
        yield pa.RecordBatch.from_pydict({"n": [n], "sums": [packed(sums)], "products": [packed(products.ravel())]})


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    add = lambda c: packed(np.array([unpacked(t) for t in pdf[c]], dtype=object).sum(axis=0))
    return pd.DataFrame({"n": [int(pdf["n"].sum())], "sums": [add("sums")], "products": [add("products")]})


def fit(distinct: DataFrame, most: int = COMPONENTS) -> Whitener | None:
    """From x of every distinct vector, all of one length. None without vectors.

    A task sends one row with the square of the length as many integers; these are merged in MERGE_GROUPS groups, and what is
    left, as many rows, in the driver."""
    schema = "n long, sums string, products string"
    each = distinct.select("x").mapInArrow(_sums, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    got = each.groupBy("part").applyInPandas(lambda pdf: _merged(pdf), schema).collect()
    if not got:
        return None
    whole = _merged(pd.DataFrame([r.asDict() for r in got])).iloc[0]
    n, sums = int(whole["n"]), unpacked(whole["sums"])
    d, products = len(sums), unpacked(whole["products"])
    square = n * n
    v = np.array([[(n * products[i * d + j] - sums[i] * sums[j]) / square for j in range(d)] for i in range(d)])
    trace = sum(n * products[i * d + i] - sums[i] * sums[i] for i in range(d)) / square
    values, columns = np.linalg.eigh(v)
    order = np.argsort(-values, kind="stable")
    order = [k for k in order if values[k] > d * np.finfo(float).eps * max(values[order[0]], 0)][:most]
    return Whitener(n, sums, values[order], np.ascontiguousarray(columns[:, order].T), trace)


def _numerators(x: np.ndarray, w: Whitener) -> np.ndarray:
    """n * x - S, exactly: longs where these suffice, Python integers elsewhere."""
    low, high = min(min(w.sums), w.n * int(x.min())), max(max(w.sums), w.n * int(x.max()))
    if -(1 << 62) < low and high < 1 << 62:
        return x * np.int64(w.n) - np.array(w.sums, dtype=np.int64)
    return x.astype(object) * w.n - np.array(w.sums, dtype=object)


def project(x: np.ndarray, w: Whitener) -> np.ndarray:
    """A row for each vector: its centred entries on the components, over the roots of the eigenvalues."""
    d = _numerators(x, w)
    centred = d.astype(np.float64) / w.n if d.dtype != object else np.array([[v / w.n for v in row] for row in d], dtype=np.float64)
    return centred @ w.components.T / np.sqrt(w.eigenvalues)


def deviations(x: np.ndarray, w: Whitener) -> list[int | None]:
    """Sum of the squares of n * x - S; None where a long can't hold it."""
    d = _numerators(x, w)
    most = int(np.abs(d).max()) if d.size else 0
    if most * most * d.shape[1] < 1 << 63 and d.dtype != object:
        return [int(v) for v in (d * d).sum(axis=1)]
    exact = [sum(int(v) ** 2 for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in exact]


def identity_error(distinct: DataFrame, w: Whitener) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity: each task sends one small matrix."""

    def squares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean = 0.0, 0.0
        for batch in portions(batches, BLOCK_ROWS):
            p = project(_matrix(batch.column("x")), w)
            total, mean = total + p.T @ p, mean + p.sum(axis=0)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"k": list(range(total.size + len(mean))), "v": [*total.ravel().tolist(), *mean.tolist()]})

    k = len(w.eigenvalues)
    got = {r["k"]: r["v"] for r in distinct.select("x").mapInArrow(squares, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()}  # (components + 1)^2 rows at most
    flat = np.array([got[i] for i in range(k * k + k)]) / w.n
    mean = flat[k * k :]
    return float(np.abs(flat[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """A row for each remaining row and each of the first components: key, component (from 1), n, deviation, whitened, explained, identity_error.

    A null vector, one without entries, and one with an entry that is null, not finite or of 2^56 and more in size is dropped; of vectors of several lengths, those of the
    commonest length remain (of two, the longer). Equal vectors are fitted once and each of their rows is returned, rows that repeat
    a key or have none too. There are as many components as eigenvalues above rounding error, so none where all vectors are equal: then, and for an
    empty table, there are no rows. deviation is null where it is beyond a long. Other columns are not carried.
    """
    spark = rows.sparkSession
    found = vectors(rows, vector, key)
    lengths = found.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", "d")).alias("x")).first()["x"]
    kind = f"key {dict(found.dtypes)['key']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if lengths is None:
        return spark.createDataFrame([], kind).withColumnRenamed("key", key)
    found = found.filter(F.size("x") == lengths["d"])
    distinct = durable(found.select("x").distinct(), "distinct-vectors")
    w = fit(distinct, most)
    k = len(w.eigenvalues)
    if not k:
        return spark.createDataFrame([], kind).withColumnRenamed("key", key)
    error = identity_error(distinct, w)

    def out(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, BLOCK_ROWS):
            x = _matrix(batch.column("x"))
            each = np.repeat(np.arange(len(x)), k)
            dev = pa.array(deviations(x, w), pa.int64())
            fixed = [np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), np.full(len(each), w.n, dtype=np.int64)]
            shares = np.tile(w.eigenvalues / w.trace, len(x))
            columns = [batch.column("key").take(pa.array(each)), *map(pa.array, fixed), dev.take(pa.array(each)), *map(pa.array, (project(x, w).ravel(), shares, np.full(len(each), error)))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return found.mapInArrow(out, kind).withColumnRenamed("key", key)
