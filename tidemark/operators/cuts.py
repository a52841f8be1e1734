"""Cutting the sorted line of a hot key into chunks that tasks can share.

Operators that carry something along a sorted key (the last fact, a running sum or maximum, a rank) sort rows within chunks, keep one row
of each chunk, carry along those few, and hand each chunk what the chunks before it left. Where the cuts are decides nothing but the
sizes of chunks, so a sample may place them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a key from which its line is cut, one row in how many is looked at for it, and the most chunks of a key (SIDE * SIDE).
HOT_ROWS, ONE_IN, SIDE = 1_000_000, 64, 16


def same(a: str, b: str, columns: Sequence[str]) -> Column:
    """The columns of two aliased tables are equal, null with null."""
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns], F.lit(True))


#: What has been measured in this process, by plan; a stale answer costs time, never a result.
_measured: dict[tuple, bool] = {}


def _few(df: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    return df.filter(F.col(at).isNotNull() & (F.pmod(F.xxhash64(at, *by), F.lit(ONE_IN)) == 0)).select(*by, at)


def _hot_keys(few: DataFrame, by: Sequence[str]) -> DataFrame:
    return few.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * ONE_IN >= HOT_ROWS).select(*by)


def any_hot(df: DataFrame, by: Sequence[str], at: str) -> bool:
    """Whether a key of df has HOT_ROWS rows or more: one count of a sample of keys, kept with the plan, so that only the first query over a table pays for it.

    Where none has, operators sort a key as a whole, which is the cheaper plan."""
    asked = (df.semanticHash(), *by, at, HOT_ROWS, ONE_IN)
    if asked not in _measured:
        if len(_measured) > 10_000:
            _measured.clear()
        _measured[asked] = not _hot_keys(_few(df, by, at), by).isEmpty()
    return _measured[asked]


def hot_cuts(df: DataFrame, by: Sequence[str], at: str) -> DataFrame:
    """by and cuts of every hot key: SIDE ascending lists of SIDE values of `at`, each with about as many rows before the next. At most one row for HOT_ROWS rows of df."""
    n = SIDE * SIDE
    shares = F.array(*[F.lit(k / n) for k in range(n)])
    few = _few(df, by, at)
    among = few.alias("f").join(F.broadcast(_hot_keys(few, by).alias("h")), same("f", "h", by), "left_semi")
    values = among.groupBy(*by).agg(F.percentile_approx(at, shares, 4 * n).alias("values")).filter("values IS NOT NULL")
    return values.select(*by, F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda k: F.slice("values", k * SIDE + 1, SIDE)).alias("cuts"))


def chunk_of(cuts: str, at: str) -> Column:
    """How many cuts are at or before the value: first among the firsts of the lists, then in one list. Equal values are in one chunk; 0 for none."""
    upper = F.size(F.filter(cuts, lambda c: c[0] <= F.col(at)))
    inner = F.size(F.filter(F.element_at(cuts, F.greatest(upper, F.lit(1))), lambda x: x <= F.col(at)))
    return F.coalesce(F.when(upper > 0, (upper - 1) * SIDE + inner), F.lit(0)).alias("_chunk")


def with_chunks(df: DataFrame, cuts: DataFrame, by: Sequence[str], at: str, only_hot: bool = False) -> DataFrame:
    """df with _chunk, 0 for keys that are not hot; only_hot: without these. The cuts are of hot keys alone, so they are broadcast."""
    joined = df.alias("l").join(F.broadcast(cuts.alias("k")), same("l", "k", by), "inner" if only_hot else "left")
    return joined.select("l.*", chunk_of("k.cuts", at))


def every_chunk(cuts: DataFrame, by: Sequence[str]) -> DataFrame:
    """by and _chunk of all chunks that hot keys can have."""
    return cuts.select(*by, F.explode(F.sequence(F.lit(0), F.lit(SIDE * SIDE))).alias("_chunk"))


def can_cut(df: DataFrame, at: str) -> bool:
    """Whether cuts can be placed by this column: numbers, dates and times."""
    return isinstance(df.schema[at].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def with_previous(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str) -> DataFrame:
    """df with the value, null or not, of the row before in its key; null for first rows.

    The line of a hot key is cut by the first of the order columns, and the last row of each chunk is handed to the next."""
    before = F.lag(F.struct(F.col(value).alias("v")))
    if not can_cut(df, order[0]) or not any_hot(df.select(*by, order[0]), by, order[0]):
        return df.withColumn(name, before.over(Window.partitionBy(*by).orderBy(*order))["v"])
    cuts = hot_cuts(df, by, order[0])
    last = with_chunks(df, cuts, by, order[0], only_hot=True).groupBy(*by, "_chunk").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_own"))
    handed = last.select(*by, "_chunk", F.lag("_own").over(Window.partitionBy(*by).orderBy("_chunk")).alias("_handed"))  # chunks without rows are not there
    own = with_chunks(df, cuts, by, order[0]).withColumn("_before", before.over(Window.partitionBy(*by, "_chunk").orderBy(*order)))
    joined = own.alias("o").join(F.broadcast(handed.alias("h")), same("o", "h", [*by, "_chunk"]), "left").select("o.*", "h._handed")
    return joined.withColumn(name, F.coalesce("_before", "_handed")["v"]).drop("_before", "_handed", "_chunk")
