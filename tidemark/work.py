"""Working tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders that durable() has written in this process.
_written: list[str] = []


def work_folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names. Where it is unset, a local master gets a new
    temporary folder, and a cluster an error: there a machine's own folder would lose data."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, and a
    lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a table's files that one task takes, of tables whose steps sort or hash all rows of a task at once.
TASK_BYTES = 4 << 20


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt out by the columns to tasks whose number grows with the files that it is read from, so that a task's rows do not.

    Adaptive plans would join small blocks, by their compressed size, until few tasks are left."""
    spark, files = df.sparkSession, df.inputFiles()
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    size = 0
    for f in files:
        path = jvm.org.apache.hadoop.fs.Path(f)
        size += path.getFileSystem(conf).getFileStatus(path).getLen()
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES)), *by)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes what durable() writes inside, but for the tables put into the list: for a caller who has
    written the result and needs the steps to it no more."""
    first, keep = len(_written), []
    yield keep
    kept = {f.rpartition("/")[0].removeprefix("file://").removeprefix("file:") for df in keep for f in df.inputFiles()}
    for path in _written[first:]:
        if path.removeprefix("file://").removeprefix("file:") not in kept:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
    _written[first:] = [p for p in _written[first:] if p.removeprefix("file://").removeprefix("file:") in kept]
