"""Integrity of an archive across its families: references, repeated keys and counts, each in one pass for all rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Reference(NamedTuple):
    """Each row of `child` names in its column `by` a row of `parent` by its column `key`."""

    name: str
    child: str
    by: str
    parent: str
    key: str = "id"


def _as_key(c: str) -> Column:
    return F.col(c).cast("string")


def missing_references(families: Mapping[str, DataFrame], rules: Sequence[Reference]) -> DataFrame:
    """rule, key and rows: child rows whose parent is not there, for all rules whose families are there, a null reference included as key null.

    The keys of all children and parents go through one aggregation, tagged with their rule, and are counted where they are read: a key that
    millions of rows name is one row of the shuffle for each task."""
    sides = []
    for r in rules:
        if r.child in families and r.parent in families:
            sides.append(families[r.child].select(F.lit(r.name).alias("rule"), _as_key(r.by).alias("key"), F.lit(1).cast("long").alias("rows"), F.lit(False).alias("there")))
            sides.append(families[r.parent].select(F.lit(r.name).alias("rule"), _as_key(r.key).alias("key"), F.lit(0).cast("long").alias("rows"), F.lit(True).alias("there")))
    if not sides:
        raise ValueError("no rule has both of its families")
    each = reduce(DataFrame.unionByName, sides).groupBy("rule", "key").agg(F.sum("rows").alias("rows"), F.max("there").alias("there"))
    return each.filter((F.col("rows") > 0) & (~F.col("there") | F.col("key").isNull())).drop("there")


def repeated_keys(families: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """family, key (as JSON) and rows of every key that a family has more than once; one aggregation for all families."""
    each = [families[f].select(F.lit(f).alias("family"), F.to_json(F.struct(*k), {"ignoreNullFields": "false"}).alias("key")) for f, k in keys.items() if f in families]
    return reduce(DataFrame.unionByName, each).groupBy("family", "key").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def counts_that_differ(source: Mapping[str, DataFrame], archived: Mapping[str, DataFrame], times: Mapping[str, str]) -> DataFrame:
    """family, day, in_source, in_archive where the rows of a day are not as many in both; a family without a side has none there. A row without a time has day null."""
    sides = []
    for tables, name in ((source, "in_source"), (archived, "in_archive")):
        other = "in_archive" if name == "in_source" else "in_source"
        for f in times:
            if f in tables:
                day = F.date_format(times[f], "yyyy-MM-dd").alias("day")
                sides.append(tables[f].select(F.lit(f).alias("family"), day, F.lit(1).cast("long").alias(name), F.lit(0).cast("long").alias(other)))
    each = reduce(DataFrame.unionByName, sides).groupBy("family", "day").agg(F.sum("in_source").alias("in_source"), F.sum("in_archive").alias("in_archive"))
    return each.filter("in_source <> in_archive")
