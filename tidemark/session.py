"""The session this engine expects: UTC, ANSI, adaptive plans, zstd Parquet."""

from pyspark.sql import SparkSession


def session(master: str = "local[*]", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    conf = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.parquet.compression.codec": "zstd", "spark.ui.enabled": "false", "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    return SparkSession.builder.master(master).config(map=conf | more).getOrCreate()
