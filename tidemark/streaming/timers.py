"""Coverage of keys as a stream: classes that end by themselves, by event-time timers that are armed anew at each boundary."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.plans.policies import COVERAGE

_OUT = ["key", "coverage", "began", "ended", "observations"]
_STARTS = [start * 1000 for _, start, _ in COVERAGE]
_LAST = len(COVERAGE) - 1


class _Coverage:
    """Of a key: when it was admitted, the class not yet given out and the observations in it. Its state is read and written once a batch."""

    def __init__(self, key: object, state: tuple | None) -> None:
        self.key, self.state, self.out = key, state, []

    def _leave(self, ended: int) -> None:
        admitted, stage, n = self.state
        self.out.append((self.key, COVERAGE[stage][0], (admitted + _STARTS[stage]) / 1000, ended / 1000, n))

    def until(self, now: int) -> None:
        """Gives out the classes whose end is at or before now; after the last one no state is left."""
        while self.state and self.state[0] + _STARTS[self.state[1] + 1] <= now:
            admitted, stage, _ = self.state
            self._leave(admitted + _STARTS[stage + 1])
            self.state = (admitted, stage + 1, 0) if stage + 1 < _LAST else None

    def row(self, ms: int, admits: bool) -> None:
        self.until(ms)
        if admits and not (self.state and self.state[0] == ms):
            if self.state:
                self._leave(ms)
            self.state = (ms, 0, 0)
        if self.state:
            self.state = (*self.state[:2], self.state[2] + 1)


def _fold(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    c = _Coverage(key[0], tuple(state.get) if state.exists else None)
    if state.hasTimedOut:
        c.until(state.getCurrentWatermarkMs())  # which may have passed further boundaries
    else:
        # The rows of a key in one batch, by time, those that admit first: as pairs of a number and a flag.
        for ms, follows in sorted((ms, not admits) for part in batches for ms, admits in zip(part["ms"].tolist(), part["admits"].tolist(), strict=True)):
            c.row(ms, not follows)
    if c.state:
        state.update(c.state)
        # A timer fires once the watermark is behind it, and a class ends once the watermark is at its boundary.
        state.setTimeoutTimestamp(max(c.state[0] + _STARTS[c.state[1] + 1] - 1, state.getCurrentWatermarkMs()))
    elif state.exists:
        state.remove()
    if c.out:
        yield pd.DataFrame(c.out, columns=_OUT)


def coverage_stream(stream: DataFrame, key: str, at: str, admits: Column, delay: str = "0 seconds") -> DataFrame:
    """key, coverage, began, ended (seconds) and observations: each coverage class of a key once it is over, and how many rows fell in it.

    A row that admits starts a key's classes, from the first; a later one ends the class at its time and starts them again. A class ends by itself when
    the watermark passes its boundary, whether rows of the key come or not, and the next boundary's timer is armed then. After the last boundary nothing of the key is kept. Of rows of one time in a batch,
    those that admit come first, and a second start at the same time is none. Rows without key or time are left out, and rows older than the watermark come too late. Times are cut to milliseconds."""
    rows = stream.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("t"), F.coalesce(admits, F.lit(False)).alias("admits")).withWatermark("t", delay)
    # One condition on both, so that it stays behind the watermark, which rows without a key move too.
    rows = rows.filter(F.when(F.col("key").isNotNull(), F.col("t")).isNotNull()).withColumn("ms", F.unix_millis("t"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.groupBy("key").applyInPandasWithState(_fold, f"key {kind}, coverage string, began double, ended double, observations long",
        "admitted long, stage int, n long", "append", GroupStateTimeout.EventTimeTimeout)
