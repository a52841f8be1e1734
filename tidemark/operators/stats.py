"""Aggregates: three kinds of percentile that must not be confused, shares, null rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.cuts import any_hot, hot_cuts, same, with_chunks


def interpolated(value: Column | str, p: float) -> Column:
    """Between the two nearest values, by linear interpolation; for keys of few values, which one buffer holds. quantiles() is for any."""
    return F.percentile(value, F.lit(p))


#: How a percentile is told from n sorted values: the ranks (from 1) it lies between, and how far it is from the first to the second.
_RANKS = {
    "interpolated": lambda n, p: (F.floor((n - 1) * p) + 1, F.ceil((n - 1) * p) + 1, (n - 1) * p - F.floor((n - 1) * p)),
    "lower": lambda n, p: (F.floor((n - 1) * p) + 1, F.floor((n - 1) * p) + 1, F.lit(0.0)),
    "nearest": lambda n, p: (F.greatest(F.ceil(n * p), F.lit(1)), F.greatest(F.ceil(n * p), F.lit(1)), F.lit(0.0)),
}


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, _v and _n: how often each key has each value; nulls are left out. Counted in each task before the shuffle."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))


def quantiles(counts: DataFrame, by: Sequence[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """by and a column for each alias in wanted (kind and p; kinds are "interpolated", "lower" and "nearest"), exact, from value_counts.

    Values of a key with very many are cut into chunks; totals tell in which chunks the wanted ranks lie, and only these are
    sorted, each in a task of its own. No key's values are gathered. A key without values has no row. Where no key has very many, ranks come from one sorted pass."""
    if not any_hot(counts.select(*by, "_v"), by, "_v"):
        w = Window.partitionBy(*by)
        ranked = counts.withColumns({"_to": F.sum("_n").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)), "_all": F.sum("_n").over(w)})
        out = []
        for alias, (kind, p) in wanted.items():
            low, high, part = _RANKS[kind](F.col("_all"), p)
            at = lambda r: F.max(F.when((r > F.col("_to") - F.col("_n")) & (r <= F.col("_to")), F.col("_v")))
            out.append((at(low) + F.max(part) * (at(high) - at(low)) if kind == "interpolated" else at(low)).alias(alias))
        return ranked.groupBy(*by).agg(*out)
    cuts = hot_cuts(counts, by, "_v")
    cut = with_chunks(counts, cuts, by, "_v")
    along = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*by, "_chunk").agg(F.sum("_n").alias("_in"))
    totals = totals.withColumns({"_before": F.coalesce(F.sum("_in").over(along), F.lit(0)), "_all": F.sum("_in").over(Window.partitionBy(*by))})
    n, each = F.col("_all"), []
    for alias, (kind, p) in wanted.items():
        low, high, part = _RANKS[kind](n, p)
        each += [F.struct(F.lit(f"{alias} {end}").alias("name"), r.cast("long").alias("rank"), part.cast("double").alias("part")) for end, r in (("low", low), ("high", high))]
    asked = totals.select(*by, "_chunk", "_before", "_in", F.explode(F.array(*each)).alias("x")).filter("x.rank > _before AND x.rank <= _before + _in")
    asked = asked.groupBy(*by, "_chunk").agg(F.collect_list(F.struct("x.name", (F.col("x.rank") - F.col("_before")).alias("rank"), "x.part")).alias("_asked"))  # two for each alias at most
    w = Window.partitionBy(*by, "_chunk").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cut.alias("c").join(asked.alias("a"), same("c", "a", [*by, "_chunk"])).select("c.*", "a._asked").withColumn("_to", F.sum("_n").over(w))
    hits = F.filter("_asked", lambda x: (x["rank"] > F.col("_to") - F.col("_n")) & (x["rank"] <= F.col("_to")))
    found = ranked.select(*by, "_v", F.explode(hits).alias("x"))
    end = lambda alias, e: F.max(F.when(F.col("x.name") == f"{alias} {e}", F.col("_v")))
    out = []
    for alias, (kind, _) in wanted.items():
        low, high = end(alias, "low"), end(alias, "high")
        part = F.max(F.when(F.col("x.name") == f"{alias} low", F.col("x.part")))
        out.append((low + part * (high - low) if kind == "interpolated" else low).alias(alias))
    return found.groupBy(*by).agg(*out)


def lower_index(df: DataFrame, by: Sequence[str], value: str, ps: dict[str, float]) -> DataFrame:
    """For each key and p the value at index floor((n - 1) * p) of the sorted values."""
    return quantiles(value_counts(df, by, value), by, {a: ("lower", p) for a, p in ps.items()})


def nearest_rank(df: DataFrame, by: Sequence[str], value: str, ps: dict[str, float]) -> DataFrame:
    """For each key and p the value at rank ceil(p * n)."""
    return quantiles(value_counts(df, by, value), by, {a: ("nearest", p) for a, p in ps.items()})


def null_rate(c: str, digits: int = 6) -> Column:
    """Share of nulls; null for no rows."""
    return F.round(F.try_divide(F.count_if(F.col(c).isNull()).cast("double"), F.count(F.lit(1)).cast("double")), digits)


def concentration(df: DataFrame, by: Sequence[str], owner: str, amount: str, tops: Sequence[int], complete: Column | None = None) -> DataFrame:
    """Shares in percent of the largest owners of each key, and the Herfindahl index.

    Amounts are summed by owner first; ranks come from a window, so no key's owners are gathered in one value."""
    held = df.groupBy(*by, owner).agg(F.sum(amount).cast("double").alias("_held"))
    w = Window.partitionBy(*by)
    ranked = held.withColumns({"_rank": F.row_number().over(w.orderBy(F.col("_held").desc(), owner)), "_all": F.sum("_held").over(w)})
    share = F.try_divide(F.col("_held"), F.col("_all"))
    return ranked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("owners"), *[F.sum(F.when(F.col("_rank") <= k, share * 100)).alias(f"top{k}_pct") for k in tops],
        F.sum(share * share).alias("hhi")
    )
