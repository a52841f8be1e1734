"""Streams of events: at-least-once delivery made effectively once, quarantine, closed buckets, keyed state."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.scalar import MICROS, micros
from tidemark.work import work_folder


def stream_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared store of the cluster."""
    return f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_to_end(result: DataFrame, out: str, checkpoint: str, mode: str) -> DataFrame:
    """Run a stream until its input is used up; what it put out, with the number of the batch. A batch that is replayed overwrites itself."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    spark, schema = result.sparkSession, result.schema
    result.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema.add("batch", "long")).parquet(out)


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of a folder, or one file, as a stream."""
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    head, _, last = path.rpartition("/")
    single = spark.read.parquet(path).inputFiles()
    if len(single) == 1 and single[0].endswith("/" + last):
        return source.option("pathGlobFilter", last).parquet(head)
    return source.parquet(path)


def append_once(stream: DataFrame, target: str, key: list[str], valid: F.Column, checkpoint: str, now: bool = True,
    day: F.Column | None = None) -> StreamingQuery:
    """Append each key once to target/facts; repeats go to target/conflicts, invalid rows to target/rejected.

    A batch that is replayed after a failure overwrites what it wrote before, so every fact is there once. day: a column that
    a key determines, e.g. the date of its event; facts lie in folders by it, and a batch reads the stored keys of its own days alone."""
    schema = T.StructType([*stream.schema.fields, T.StructField("_day", T.StringType()), T.StructField("batch", T.LongType())])

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("_day", F.lit("all") if day is None else F.coalesce(day.cast("string"), F.lit("none")))
        good, bad = batch.filter(F.coalesce(valid, F.lit(False))), batch.filter(~F.coalesce(valid, F.lit(False))).drop("_day")
        try:
            stored = spark.read.schema(schema).parquet(f"{target}/facts").filter(F.col("batch") != number)
            if day is not None:  # a few days
                stored = stored.filter(F.col("_day").isin([r[0] for r in good.select("_day").distinct().collect()]))
            stored = stored.select(*key)
        except Exception as e:  # the first batch finds no folder
            if "PATH_NOT_FOUND" not in str(e):
                raise
            stored = batch.select(*key).limit(0)
        fresh = good.join(stored, key, "left_anti").dropDuplicates(key)
        again = good.groupBy(*key).agg(F.count(F.lit(1)).alias("seen")).join(stored.distinct().withColumn("held", F.lit(1)), key, "left")
        again = again.withColumn("repeats", F.col("seen") - F.when(F.col("held").isNull(), 1).otherwise(0)).filter("repeats > 0").select(*key, "repeats")
        fresh.write.mode("overwrite").partitionBy("_day").parquet(f"{target}/facts/batch={number}")
        for rows, name in ((again, "conflicts"), (bad, "rejected")):
            rows.write.mode("overwrite").parquet(f"{target}/{name}/batch={number}")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if now else writer).start()


def deduplicated_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events delivered twice through append_once, as the facts that are left."""
    folder = stream_folder(spark, "once")
    path = f"{sf_dir}/events.parquet"
    twice = event_stream(spark, path)
    twice = twice.withColumn("_delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_delivery")
    append_once(twice, f"{folder}/out", ["event_id"], F.col("event_id").isNotNull(), f"{folder}/checkpoint", day=F.to_date("ts")).awaitTermination()
    return spark.read.schema(twice.schema).parquet(f"{folder}/out/facts")


def closed_buckets(stream: DataFrame, at: str, width: str, delay: str = "0 seconds") -> DataFrame:
    """Counts and totals of tumbling buckets. In append mode a bucket comes out once the watermark passed its end."""
    timed = stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", delay)
    return timed.groupBy(F.window("_at", width).alias("w")).agg(F.count(F.lit(1)).alias("n"),
        F.sum("value").alias("total")).select(F.col("w.start").alias("bucket_start"), "n", "total")


def ordered_stream(spark: SparkSession, sf_dir: str, files: int = 8, flush: bool = False) -> DataFrame:
    """The events table as a stream in order of time: files of ranges of time, that come in one after the other.

    flush: an empty event a day behind the last one follows, which moves the watermark past all others."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = stream_folder(spark, "ordered")
    events.repartitionByRange(files, "ts").sortWithinPartitions("ts").write.parquet(path)
    if flush:
        last = events.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).select(*[F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema])
        last.coalesce(1).write.parquet(f"{path}/z")
    # A stream takes files by their time of change.
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = sorted(f for f in spark.read.option("recursiveFileLookup", "true").parquet(path).inputFiles())
    names.sort(key=lambda f: "/z/" in f)
    for k, name in enumerate(names):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(name), 1_700_000_000_000 + 60_000 * k, -1)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def closed(spark: SparkSession, sf_dir: str, width: str, flush: bool = False) -> DataFrame:
    """Buckets of the events table that close while it streams by in order of time, each once; state holds open buckets only."""
    folder = stream_folder(spark, "closed")
    counted = closed_buckets(ordered_stream(spark, sf_dir, flush=flush), "ts", width)
    return run_to_end(counted, f"{folder}/out", f"{folder}/checkpoint", "append").drop("batch")


def keyed_state(stream: DataFrame, key: str, at: str, identity: str, value: str, step: Callable[[str, float | None], str], start: str) -> DataFrame:
    """State of each key after each batch: `step` is the pure function that batch replays use too.
    Rows of a batch are taken by (time, identity)."""

    def fold(k: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, changes = state.get if state.exists else (start, 0)
        rows = pd.concat(list(batches), ignore_index=True).sort_values(["t", "id"])
        for v in rows["value"]:
            new = step(now, None if v != v else float(v))
            changes += new != now
            now = new
        state.update((now, changes))
        yield pd.DataFrame({"key": [k[0]], "state": [now], "changes": [changes]})

    rows = stream.select(F.col(key).alias("key"), F.col(at).cast("timestamp").alias("t"), F.col(identity).alias("id"),
        F.col(value).cast("double").alias("value"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.groupBy("key").applyInPandasWithState(fold, f"key {kind}, state string, changes long", "state string, changes long", "update",
        GroupStateTimeout.NoTimeout)


def expiring_spans(stream: DataFrame, key: str, at: str, value: str, least: float, ttl_seconds: int, delay: str = "0 seconds") -> DataFrame:
    """Spans of coverage as a stream: an eligible event (value >= least) opens or renews its key's span,
    which closes ttl seconds after the last one. A span comes out once, when the watermark has
    passed its end; the same spans as the batch simulation of tiers gives for what is closed. Times are rounded to milliseconds."""
    # Sessions of Spark itself: no Python per key. A session takes in what starts before or at its end, and a span only what comes before it;
    # times are whole milliseconds, so that a gap shorter by a microsecond tells the two apart.
    rows = stream.select(F.col(key).alias("key"), F.timestamp_millis(F.floor((micros(at) + 500) / 1000)).alias("t"),
        F.col(value).cast("double").alias("value")).withWatermark("t", delay).filter(F.col("value") >= least)
    spans = rows.groupBy("key", F.session_window("t", f"{ttl_seconds * MICROS - 1} microseconds").alias("w")).agg((F.count(F.lit(1)) - 1).alias("renewals"))
    return spans.select("key", (F.unix_millis("w.start") / 1000).alias("started"), ((F.unix_micros("w.end") + 1) / MICROS).alias("ended"), "renewals")
