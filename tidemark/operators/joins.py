"""Semi joins on several tables at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_any(df: DataFrame, key: str, *sets: tuple[DataFrame, str]) -> DataFrame:
    """Rows of df whose key is in any of the tables (table, column): the keys are brought together first,
    so df is joined once, and no row is multiplied. A null key is in none."""
    keys = reduce(lambda a, b: a.union(b), [t.select(F.col(c).alias(key)) for t, c in sets]).distinct()
    return df.join(keys, key, "left_semi")
