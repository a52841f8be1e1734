"""A stream with timers runs in a session that names Spark's default state store, as well as in one that names RocksDB."""

import pytest

from tidemark.plans.fact_queries import QUERIES

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DEFAULT = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.mark.parametrize("name", ["q121_stream_coverage"])
def test_default_store(spark, sf_dir, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    other.conf.set(PROVIDER, DEFAULT)
    assert QUERIES[name](other, sf_dir).count() == QUERIES[name](spark, sf_dir).count() > 0
    assert other.conf.get(PROVIDER) == DEFAULT


def test_spans_to_the_millisecond(spark, tmp_path):
    """Times that a double cannot hold, an event at a span's very end, and one a millisecond before it."""
    from datetime import datetime, timedelta

    from tidemark.streaming import events

    start = datetime(2024, 1, 26, 17, 23, 55)
    at = lambda ms: start + timedelta(milliseconds=ms)
    rows = [("a", 52), ("a", 100_051), ("a", 200_051), ("b", 52), ("b", 100_052), ("c", 900_000)]
    folder = f"{tmp_path}/in"
    spark.createDataFrame([(k, at(ms), 1.0) for k, ms in rows], "k string, at timestamp, v double").coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema("k string, at timestamp, v double").parquet(folder)
    out = events.run_to_end(events.expiring_spans(stream, "k", "at", "v", 1.0, 100), f"{tmp_path}/out", f"{tmp_path}/checkpoint", "append")
    zero = spark.createDataFrame([(start,)], "t timestamp").selectExpr("unix_millis(t)").first()[0]
    got = sorted((r.key, round(r.started * 1000) - zero, round(r.ended * 1000) - zero, r.renewals) for r in out.collect())
    assert got == [("a", 52, 200_051, 1), ("a", 200_051, 300_051, 0), ("b", 52, 100_052, 0), ("b", 100_052, 200_052, 0)]
