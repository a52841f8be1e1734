"""Shared pieces: batches for Python, checked broadcasts and dense numbering without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.work import durable, scratch, work_folder  # noqa: F401

#: Rows of a small side up to which a broadcast is asked for; beyond it the join is shuffled.
BROADCAST_ROWS = 500_000
#: Rows of whole texts that go to Python at once; their bytes, not their number, fill memory.
TEXT_ROWS = 500
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(df: DataFrame) -> DataFrame:
    """df, in a session that hands Python at most TEXT_ROWS rows at once. The setting is the session's and stays, as
    the plan is run later, by the caller; a smaller one is left as it is."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(ARROW_ROWS)) <= TEXT_ROWS:
        conf.set(ARROW_ROWS, str(TEXT_ROWS))
    return df


def small(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """df, hinted for broadcast only if its counted rows are within the bound."""
    return F.broadcast(df) if rows <= bound else df


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def running_start(counts: DataFrame, key: list[str], part: str, n: str, out: str) -> DataFrame:
    """counts has a row for each (key, part); out: the rows of the key in lower parts."""
    w = Window.partitionBy(*key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long"))
