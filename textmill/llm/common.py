"""Plumbing shared by the training-data operators: scratch tables and table reading."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters outside this class (the ASCII blanks).
BLANKS = r"[\x20\x09-\x0D]+"

_local_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a temporary folder for a local master (tests) and the
    warehouse, which is shared too, for any other.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found
    master = spark.sparkContext.master
    if master.startswith("local-cluster") or not master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if master not in _local_dirs:
        _local_dirs[master] = tempfile.mkdtemp(prefix="textmill-")
        atexit.register(shutil.rmtree, _local_dirs[master], ignore_errors=True)
    return "file://" + _local_dirs[master]


@contextlib.contextmanager
def _shuffles_cleaned(spark: SparkSession):
    """Shuffle files go as soon as the write that made them has ended, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Tables written to the shared folder to cut lineage between rounds.

    A written table outlives any executor, so a lost executor costs one task of
    the current round and nothing of the earlier ones.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        self.n = 0

    def write(self, df: DataFrame, row_group_mb: int | None = None) -> DataFrame:
        """df, written and read again."""
        path = f"{self.path}/{self.n}"
        self.n += 1
        writer = df.write.option("compression", "zstd")
        if row_group_mb:
            writer = writer.option("parquet.block.size", row_group_mb << 20)
        with _shuffles_cleaned(self.spark):
            writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        self.paths.append(path)
        return out

    def reread(self, written: DataFrame) -> DataFrame:
        """The same table as a frame of its own, to be joined with the first."""
        return self.spark.read.schema(written.schema).parquet(written._scratch_path)

    def drop(self, *written: DataFrame) -> None:
        """Delete tables that no later step reads."""
        self._delete([df._scratch_path for df in written])

    def keep_only(self, *written: DataFrame) -> None:
        """Delete all tables but those that the operator's result reads."""
        kept = {df._scratch_path for df in written}
        self._delete([p for p in self.paths if p not in kept])

    def _delete(self, paths: list[str]) -> None:
        for p in paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths = [p for p in self.paths if p not in paths]


def _give_back() -> None:
    """Freed memory goes back to the system, not to the allocators' stock."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def frugal(function: Callable) -> Callable:
    """A function of groups after which a worker holds no more than before.

    Workers outlive their tasks and stand beside the executor's heap, so what their
    allocators keep of one stage's arrays is missing in all later ones.
    """

    # Spark counts a function's parameters: one group, or the two of a cogroup.
    if function.__code__.co_argcount == 2:

        def run(left, right):
            try:
                return function(left, right)
            finally:
                _give_back()
    else:

        def run(group):
            try:
                return function(group)
            finally:
                _give_back()

    return run


def frugal_batches(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same for a function of batches."""

    @functools.wraps(function)
    def run(batches):
        for out in function(batches):
            yield out
            del out
            _give_back()
        _give_back()

    return run
