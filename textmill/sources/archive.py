"""Index files, crawl catalogs, record fetching and the limits on it."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.records import gunzip_or_raw, parse_warc
from textmill.operators.ingest import DOCX_MIME, index_records, pointers
from textmill.schemas import CDX
from textmill.sources.store import ObjectStore


def index_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of (gzipped) index files and the file of each; a gzipped file is one task."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def index_paths(spark: SparkSession, path: str) -> DataFrame:
    """The non-empty lines of a (gzipped) list of paths."""
    return spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("path")).where("path <> ''")


def filter_index(spark: SparkSession, path: str, out: str, crawl_id: str, mime: str = DOCX_MIME) -> DataFrame:
    """Write the matching records of index files as JSON lines, an output for each input; returns (file, n).

    The index is read once: n, the records of each file that has any, is counted in what
    was written. Filtering a file again replaces its output. (An Observation would give
    the lines read as well, but once a session has one, its later model transforms fail
    to serialize in Spark 4.1.)
    """
    records = index_records(index_lines(spark, path), mime, keep=("file",))
    name = F.regexp_replace(F.regexp_replace("file", r"^[a-z0-9]+:/+", ""), r"[^A-Za-z0-9._-]", "_")
    rows = records.select("value", F.lit(crawl_id).alias("crawl_id"), name.alias("file"))
    rows.write.partitionBy("crawl_id", "file").mode("overwrite").option("partitionOverwriteMode", "dynamic").text(out)
    return index_names(spark, path).join(_kept_lines(spark, out, crawl_id), "file")


def index_names(spark: SparkSession, path: str) -> DataFrame:
    """(file): the outputs' names of index files, by a listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.select(F.regexp_replace(F.regexp_replace("path", r"^[a-z0-9]+:/+", ""), r"[^A-Za-z0-9._-]", "_").alias("file"))


def _kept_lines(spark: SparkSession, out: str, crawl_id: str) -> DataFrame:
    """(file, n) of a crawl's outputs."""
    if not ObjectStore(spark, out).exists(f"crawl_id={crawl_id}"):
        return spark.createDataFrame([], "file string, n long")
    rows = spark.read.schema("value string, crawl_id string, file string").option("basePath", out).text(f"{out}/crawl_id={crawl_id}")
    return rows.where(F.col("crawl_id") == crawl_id).groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Filtered records of JSON-lines files; blank lines are skipped, a malformed one is an error."""
    return pointers(spark.read.schema(CDX).option("mode", "FAILFAST").json(path))


def crawl_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(id, position) of a JSON list of crawls, newest first."""
    rows = spark.read.option("multiLine", True).json(path)
    return rows.select("id", F.monotonically_increasing_id().alias("position"))


def filtered_crawls(spark: SparkSession, path: str) -> DataFrame:
    """(id, files, total_size) of the files below path, grouped by their first folder; newest id first."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return crawls_of(files.withColumn("key", F.substring_index("path", path.rstrip("/").rsplit("/", 1)[-1] + "/", -1)))


def crawls_of(objects: DataFrame) -> DataFrame:
    """(id, files, total_size) of an object listing (key, length) whose keys are crawl/file; others are skipped."""
    parts = F.split("key", "/")
    return (
        objects.where(F.size(parts) >= 2)
        .groupBy(F.element_at(parts, 1).alias("id"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("total_size"))
        .orderBy(F.desc("id"))
    )


class FetchError(Exception):
    """A response that isn't a record: its status, or None for the network."""

    def __init__(self, status: int | None, message: str = ""):
        super().__init__(message or (f"HTTP {status}" if status else "network error"))
        self.status = status


#: Statuses that slow a limiter down, and those that are worth another try.
SLOW_DOWN = frozenset((403, 429, 503))
TRY_AGAIN = frozenset((429, 503))


@dataclass
class TokenBucket:
    """Requests a second that adapt to a server's answers; the clock and sleep can be replaced."""

    rps: float
    least: float
    most: float
    backoff: float = 0.8
    recovery: float = 1.05
    streak_length: int = 100
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    tokens: float = field(init=False)
    streak: int = field(init=False, default=0)
    last: float = field(init=False)

    def __post_init__(self):
        self.tokens, self.last = self.rps, self.clock()

    def acquire(self) -> None:
        while True:
            now = self.clock()
            # One token at least can be saved up, so a rate below one a second is a long wait, not an endless one.
            self.tokens = min(max(1.0, self.rps), self.tokens + (now - self.last) * self.rps)
            self.last = now
            if self.tokens >= 1 - 1e-9:  # a rounding error is no reason for a wait too short for the clock
                self.tokens = max(0.0, self.tokens - 1)
                return
            self.sleep((1 - self.tokens) / self.rps)

    def success(self) -> None:
        self.streak += 1
        if self.streak >= self.streak_length:
            self.streak = 0
            self.rps = min(self.most, self.rps * self.recovery)

    def error(self, status: int | None) -> None:
        self.streak = 0
        if status in SLOW_DOWN:
            self.rps = max(self.least, self.rps * self.backoff)


@dataclass
class DelayLimiter:
    """A delay between requests that adapts: shorter after a run of successes, doubled on backoff."""

    delay_ms: float = 50
    least_ms: float = 20
    most_ms: float = 5000
    streak_length: int = 20
    streak: int = 0

    def success(self) -> None:
        self.streak += 1
        if self.streak >= self.streak_length:
            self.streak = 0
            self.delay_ms = max(self.least_ms, self.delay_ms * 0.9)

    def back_off(self) -> None:
        self.streak = 0
        self.delay_ms = min(self.most_ms, self.delay_ms * 2)


def retry_delay(attempt: int, most_s: float, jitter: Callable[[], float] = random.random) -> float:
    """Seconds before another try: 2**attempt up to most_s, and up to 30 % more."""
    return min(2.0**attempt, most_s) * (1 + 0.3 * jitter())


def fetch_with_retry(
    fetch: Callable[[str, int, int], bytes], file: str, start: int, length: int, limiter: TokenBucket | None = None,
    tries: int = 5, most_s: float = 60, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random,
) -> bytes:
    """The bytes of a range: throttling and network errors are tried again, other errors are final."""
    for attempt in range(tries):
        if limiter:
            limiter.acquire()
        try:
            out = fetch(file, start, length)
        except FetchError as e:
            if limiter:
                limiter.error(e.status)
            if attempt + 1 == tries or not (e.status is None or e.status in TRY_AGAIN):
                raise
            sleep(retry_delay(attempt, most_s, jitter))
        else:
            if limiter:
                limiter.success()
            return out
    raise ValueError("tries is at least 1")


#: Fetched bodies that a task holds before it passes them on.
FETCHED_BYTES = 4 << 20


def local_range(root: str) -> Callable[[str, int, int], bytes]:
    """A fetcher that reads ranges of files below a folder that all executors see."""

    def fetch(file: str, start: int, length: int) -> bytes:
        try:
            with open(f"{root}/{file}", "rb") as f:
                f.seek(start)
                return f.read(length)
        except FileNotFoundError:
            raise FetchError(404) from None

    return fetch


def address_range(root: str) -> Callable[[str, int, int], bytes]:
    """A fetcher that reads ranges of files below any address that pyarrow has a file system for."""

    def fetch(file: str, start: int, length: int) -> bytes:
        from pyarrow import fs

        files, folder = fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))
        try:
            with files.open_input_file(f"{folder}/{file}") as f:
                return f.read_at(length, start)
        except FileNotFoundError:
            raise FetchError(404) from None
        except OSError as e:
            raise FetchError(None, str(e)) from None

    return fetch


def http_range(base: str, timeout_s: float = 45) -> Callable[[str, int, int], bytes]:
    """A fetcher that asks a web server for ranges of files; a whole file for an answer is cut."""

    def fetch(file: str, start: int, length: int) -> bytes:
        import urllib.error
        import urllib.request

        asked = urllib.request.Request(f"{base.rstrip('/')}/{file}", headers={"Range": f"bytes={start}-{start + length - 1}"})
        try:
            with urllib.request.urlopen(asked, timeout=timeout_s) as answer:
                return answer.read() if answer.status == 206 else answer.read()[start : start + length]
        except urllib.error.HTTPError as e:
            raise FetchError(e.code) from None
        except OSError as e:  # timeouts and connections that fail
            raise FetchError(None, str(e)) from None

    return fetch


def fetcher(address: str) -> Callable[[str, int, int], bytes]:
    """The fetcher for an address: a web server, a store, or a folder that all executors see."""
    if address.startswith(("http://", "https://")):
        return http_range(address)
    return address_range(address) if "://" in address else local_range(address)


def fetch_records(records: DataFrame, fetch: Callable[[str, int, int], bytes], rps: float = 5.0, partitions: int | None = None, tries: int = 5) -> DataFrame:
    """(url, position, content, http_status, content_type, error) of records; position rises in their order.

    Every partition has its own limiter with its share of the rate. An error is a
    row's result and ends nothing. A result that is used more than once is to be
    written first (store.written), or everything is fetched again.
    """
    n = partitions or records.sparkSession.sparkContext.defaultParallelism
    position = F.monotonically_increasing_id().alias("position")
    rows = records.select("url", "filename", "range_start", "range_length", position).repartition(n)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = TokenBucket(max(rps / n, 0.01), min(1.0, rps) / n, rps / n)
        columns = ["url", "position", "raw", "fetch_error"]
        for frame in batches:
            out, held = [], 0
            for url, file, start, length, position in frame.itertuples(index=False):
                try:
                    if pd.isna(start) or pd.isna(length):
                        raise FetchError(None, "no byte range")
                    out.append((url, position, fetch_with_retry(fetch, file, int(start), int(length), limiter, tries), None))
                    held += len(out[-1][2])
                except FetchError as e:
                    out.append((url, position, None, str(e)))
                if held >= FETCHED_BYTES:
                    yield pd.DataFrame(out, columns=columns)
                    out, held = [], 0
            yield pd.DataFrame(out, columns=columns)

    raw = rows.mapInPandas(run, "url string, position long, raw binary, fetch_error string")
    parsed = raw.withColumn("r", parse_warc(gunzip_or_raw("raw")))
    status_error = F.when(F.col("r.http_status") != 200, F.concat(F.lit("HTTP "), F.col("r.http_status").cast("string")))
    return parsed.select(
        "url", "position", F.col("r.content").alias("content"), "r.http_status", "r.content_type",
        F.coalesce("fetch_error", "r.error", status_error).alias("error"),
    )
