"""Keys that a stream has seen, in bounded state: each once within a time, kept in RocksDB, forgotten after it."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.mutations import insert_ignore
from textmill.sources.clustered import ClusteredTable
from textmill.sources.store import ObjectStore

_ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state on the executors' disks, with what a batch changes as their checkpoints."""
    before = {k: spark.conf.get(k, None) for k in _ROCKS}
    for k, v in _ROCKS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def arriving_records(spark: SparkSession, path: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    """Records of JSON lines as files arrive, with the time of their file (arrived)."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("arrived"))


def once_within(records: DataFrame, key: str, time: str = "arrived", within: str = "30 days") -> DataFrame:
    """The first record of each key; repeats are dropped for at least the time within.

    A record older than the newest one seen by more than within is late and dropped, so
    a key is forgotten when the stream has passed it by twice that time, and state
    holds the keys of no longer a time. After that a repeat counts as new. Records
    without a time are as old as can be.
    """
    timed = records.withColumn(time, F.coalesce(F.col(time), F.lit(0).cast("timestamp")))
    return timed.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def clustered_sink(path: str, key: str, shards: int = 64) -> Callable[[DataFrame, int], None]:
    """Insert-ignore into a clustered table: a batch rewrites the partitions of its keys, and one that is tried again adds nothing twice."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if ObjectStore(spark, path).exists("_clustered"):
            ClusteredTable(spark, path).merge(batch, lambda old, new: insert_ignore(old, new, key))
        else:
            ClusteredTable.create(batch.dropDuplicates([key]), path, key, shards)

    return write
