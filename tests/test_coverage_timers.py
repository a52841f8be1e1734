"""Coverage classes of a stream against plain Python, over a restart from the checkpoint, with timers that fire without rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.plans.policies import COVERAGE
from tidemark.streaming import timers

START = datetime(2024, 1, 1)
KIND = "who string, at timestamp, kind string"


def at(s):
    return START + timedelta(seconds=s)


def plain(rows, watermark):
    out = []
    for key in sorted({r[0] for r in rows if r[0]}):
        mine = sorted((s, kind == "in") for k, s, kind in rows if k == key)
        admitted = sorted({s for s, admits in mine if admits})
        for i, a in enumerate(admitted):
            end = admitted[i + 1] if i + 1 < len(admitted) else float("inf")
            for (name, low, _), (_, high, _) in zip(COVERAGE, COVERAGE[1:], strict=False):
                began, ended = a + low, min(a + high, end)
                if began < ended and ended <= watermark:
                    out.append((key, name, began, ended, sum(began <= s < ended for s, _ in mine)))
    return sorted(out)


def run(stream, out, checkpoint):
    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream.writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_restart_and_timers(spark, tmp_path):
    first = [("a", 0, "in"), ("a", 5, "x"), ("a", 119, "x"), ("a", 120, "x"), ("b", 50, "x"), ("b", 60, "in"), ("b", 61, "in"), ("a", 700, "x"), ("b", 700, "x")]
    second = [("c", 5000, "in"), ("a", 5001, "in"), ("a", 5001, "x"), ("c", 30000, "x"), ("c", 5000, "in"), ("b", 700_000, "x"), ("b", 700_001, "in")]
    last = [(None, 700_100, "x")]  # moves the watermark, belongs to no key
    folder, out, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    for rows in (first, second, last):  # three runs: each goes on where the last one stopped
        spark.createDataFrame([(k, at(s), kind) for k, s, kind in rows], KIND).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(KIND).parquet(folder)
        run(timers.coverage_stream(stream, "who", "at", F.col("kind") == "in"), out, checkpoint)
    spark_zero = spark.createDataFrame([(START,)], "t timestamp").select(F.unix_timestamp("t")).first()[0]
    got = sorted((r.key, r.coverage, round(r.began - spark_zero), round(r.ended - spark_zero), r.observations) for r in spark.read.parquet(out).collect())
    assert got == plain(first + second, 700_100)
