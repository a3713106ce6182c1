"""The record stream: files of JSON lines, URLs seen once, micro-batches that resume."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from textmill.operators.mutations import insert_ignore
from textmill.schemas import CDX
from textmill.sources.store import replace_table


def record_stream(spark: SparkSession, path: str, files_per_batch: int = 8, schema=CDX) -> DataFrame:
    """Index records as files arrive, a few files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def once_each(records: DataFrame, key: str = "url") -> DataFrame:
    """The first record of each key; what has been seen is state that a checkpoint keeps."""
    return records.dropDuplicates([key])


def run_available(records: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Handle all that is there, batch by batch, and stop; a later run goes on where this one ended."""
    query = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def table_sink(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """Insert-ignore into a Parquet table: a batch that is tried again adds nothing twice."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path
        there = p(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(p(path))
        replace_table(insert_ignore(spark.read.parquet(path), batch, key) if there else batch.dropDuplicates([key]), path)

    return write


def appending_sink(path: str) -> Callable[[DataFrame, int], None]:
    """One folder for each batch: a batch that is tried again overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
