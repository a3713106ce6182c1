"""Objects and tables in Hadoop file systems: read, list, put if absent, swap, JSON lines, exports."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.schemas import LABEL, TAXONOMY


class ObjectStore:
    """Keys to bytes below a root that Spark can reach (file:, hdfs:, s3a:, ...)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = jvm.org.apache.commons.io.IOUtils

    def _at(self, key: str):
        return self._path(f"{self.root}/{key}")

    def exists(self, key: str) -> bool:
        return self._fs.exists(self._at(key))

    def read(self, key: str) -> bytes | None:
        """The bytes, or None where there is no such key."""
        if not self.exists(key):
            return None
        stream = self._fs.open(self._at(key))
        try:
            return bytes(self._io.toByteArray(stream))
        finally:
            stream.close()

    def write(self, key: str, data: bytes) -> None:
        """Write through a temporary name, so no reader sees half an object."""
        part = self._at(f"{key}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(part, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        if self.exists(key):
            self._fs.delete(self._at(key), False)
        self._fs.rename(part, self._at(key))

    def write_if_absent(self, key: str, data: bytes) -> bool:
        """Whether it was written; two writers at once may both say so, with equal bytes under hashed keys."""
        if self.exists(key):
            return False
        self.write(key, data)
        return True

    def objects(self, prefix: str = "", pattern: str | None = None) -> DataFrame:
        """(key, length, content) below a prefix; only the columns in use are read."""
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        reader = reader.option("pathGlobFilter", pattern) if pattern else reader
        files = reader.load(f"{self.root}/{prefix}")
        base = self.root.split("://", 1)[-1].split(":", 1)[-1].lstrip("/") + "/"
        return files.select(F.substring_index("path", base, -1).alias("key"), "length", "content")


def write_absent_objects(objects: DataFrame, root: str, suffix: str = ".docx", replace: bool = False) -> None:
    """Write (id, content) rows as files id + suffix, those that aren't there yet (or, to replace, all); runs on the executors.

    Ids are content hashes: a second attempt of a task writes the same bytes. The root
    is a path that all executors share or an address (hdfs:, s3:, gs:, file:); an
    address that pyarrow has no file system for is an error, never a local folder.
    """

    def put(rows) -> None:
        import os

        from pyarrow import fs

        address = root.replace("s3a://", "s3://", 1)
        files, folder = fs.FileSystem.from_uri(address if ":/" in address else f"file://{os.path.abspath(address)}")
        files.create_dir(folder, recursive=True)
        for row in rows:
            path = f"{folder}/{row.id}{suffix}"
            if replace or files.get_file_info(path).type == fs.FileType.NotFound:
                part = f"{path}.{uuid.uuid4().hex}.tmp"
                with files.open_output_stream(part) as f:
                    f.write(bytes(row.content))
                files.move(part, path)

    objects.select("id", "content").dropDuplicates(["id"]).foreachPartition(put)


def write_archives(records: DataFrame, root: str, order: str, suffix: str = ".gz") -> DataFrame:
    """Write (id, content) rows one after another into files id + suffix; returns the other columns, written, with filename, offset and length.

    A task holds a batch of rows, however large a file gets. Rows of a file go by order,
    those of one place by content, so a second attempt of a task writes the same bytes;
    null content has no bytes.
    """
    import pyarrow as pa

    kept = [f for f in records.schema if f.name not in ("id", "content")]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyarrow import fs

        address = root.replace("s3a://", "s3://", 1)
        files, folder = fs.FileSystem.from_uri(address if ":/" in address else f"file://{os.path.abspath(address)}")
        files.create_dir(folder, recursive=True)
        name, part, out, at = None, None, None, 0

        def done() -> None:
            if out:
                out.close()
                files.move(part, f"{folder}/{name}")

        for batch in batches:
            names, begins, sizes = [], [], []
            for key, x in zip(batch["id"], batch["content"], strict=True):
                if f"{key}{suffix}" != name:
                    done()
                    name, at = f"{key}{suffix}", 0
                    part = f"{folder}/{name}.{uuid.uuid4().hex}.tmp"
                    out = files.open_output_stream(part)
                data = x.as_buffer() if x.is_valid else b""
                out.write(data)
                names.append(name)
                begins.append(at)
                sizes.append(len(data))
                at += sizes[-1]
            columns = [*(batch[f.name] for f in kept), pa.array(names, pa.string()), pa.array(begins, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), "filename", "offset", "length"])
        done()

    rows = records.repartition("id").sortWithinPartitions("id", order, "content")
    shape = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return written(rows.mapInArrow(put, f"{shape}filename string, offset long, length long"))


def without_links(files: DataFrame, path_col: str = "path") -> DataFrame:
    """files with is_link: whether a path of a local file system is a symbolic link; other stores have none."""

    def run(batches):
        import os
        from urllib.parse import unquote, urlparse

        for batch in batches:
            local = [p if p.startswith("/") else unquote(urlparse(p).path) if p.startswith("file:") else None for p in batch[path_col]]
            yield batch.assign(is_link=[p is not None and os.path.islink(p) for p in local])

    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.mapInPandas(run, f"{shape}, is_link boolean")


def replace_table(df: DataFrame, path: str) -> None:
    """Write a new version beside a table and swap it in; the old one is read until the swap.

    A crash between the two renames leaves the whole new version beside; recover_table puts it in place.
    """
    spark = df.sparkSession
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(new)
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(p(path))
    if had:
        fs.rename(p(path), p(old))
    fs.rename(p(new), p(path))
    if had:
        fs.delete(p(old), True)


def recover_table(spark: SparkSession, path: str) -> bool:
    """After a crash within a swap: put the newest whole version in place of a missing table. Whether there is a table now."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p(path)):
        return True
    for kind in ("new", "old"):  # the old version is only moved away once the new one is whole
        found = fs.globStatus(p(f"{path}.{kind}-*")) or []
        whole = sorted((f.getModificationTime(), f.getPath().toString()) for f in found if fs.exists(p(f"{f.getPath().toString()}/_SUCCESS")))
        if whole:
            return fs.rename(p(whole[-1][1]), p(path))
    return False


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: spark.checkpoint.dir, else the warehouse; a temporary one for a local master."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master.startswith("local") and not master.startswith("local-cluster"):
        return "file://" + tempfile.mkdtemp(prefix="textmill-")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def written(df: DataFrame) -> DataFrame:
    """df, written to the shared folder once and read again, however often it is used."""
    path = f"{shared_folder(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_json_lines(spark: SparkSession, path: str, schema=LABEL) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def last_per_id(rows: DataFrame, order: str, key: str = "id") -> DataFrame:
    """Of several lines of an id, the last one."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("r")).select(key, "r.*")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(dimension, position, id, label, description) of a taxonomy file."""
    whole = spark.read.schema(TAXONOMY).option("multiLine", True).json(path)
    parts = []
    for name, column in (("type", "document_types"), ("topic", "topics")):
        rows = whole.select(F.posexplode(column).alias("position", "x"))
        parts.append(rows.select(F.lit(name).alias("dimension"), "position", "x.id", "x.label", "x.description"))
    return parts[0].unionByName(parts[1])


def texts_of(ids: DataFrame, texts: DataFrame, most: int = 2000) -> DataFrame:
    """(id, text) of ids: the first characters of each text, empty where there is none."""
    return ids.select("id").join(texts.select("id", "text"), "id", "left").select("id", F.left(F.coalesce("text", F.lit("")), F.lit(most)).alias("text"))


def write_ranged(rows: DataFrame, path: str, key: str = "id", files: int = 64, row_group_mb: int = 16) -> None:
    """A table in the order of a key: each file a range of it, and each row group a narrow one, as its statistics say."""
    ranged = rows.repartitionByRange(files, key).sortWithinPartitions(key)
    ranged.write.mode("overwrite").option("parquet.block.size", row_group_mb << 20).parquet(path)


def key_range(spark: SparkSession, path: str, start: str | None, end: str | None, key: str = "id") -> DataFrame:
    """The rows of a ranged table with start <= key < end (None: open); files and row groups outside aren't decoded."""
    rows = spark.read.parquet(path)
    rows = rows if start is None else rows.where(F.col(key) >= start)
    return rows if end is None else rows.where(F.col(key) < end)


def range_borders(spark: SparkSession, path: str, workers: int, key: str = "id") -> list[tuple]:
    """(start, end) of workers' ranges of a ranged table, about equal in rows: quantiles by the files' numbers of rows and least keys."""
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("least"))
    files = sorted((r["least"], r["n"]) for r in sizes.collect() if r["least"] is not None)  # a row a file
    total, starts, before = sum(n for _, n in files), [], 0
    for least, n in files:
        if len(starts) < workers and before >= len(starts) * total / workers:
            starts.append(least)
        before += n
    if not starts:
        return [(None, None)]
    return list(zip([None, *starts[1:]], [*starts[1:], None], strict=True))


def write_export(rows: DataFrame, path: str) -> None:
    """One zstd Parquet file, in the order of ids."""
    rows.repartition(1).sortWithinPartitions("id").write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_manifest(rows: DataFrame, path: str) -> bool:
    """One text file with a line for each row of a one-column frame, in order; nothing without rows."""
    column = rows.columns[0]
    if rows.isEmpty():
        return False
    rows.repartition(1).sortWithinPartitions(column).select(F.col(column).cast("string")).write.mode("overwrite").text(path)
    return True


def facet_listing(counts: DataFrame, base: str, kind: str) -> DataFrame:
    """Lines for a text listing or sitemap: a facet's address and count."""
    return counts.select(F.concat(F.lit(f"{base}/{kind}/"), F.col("value"), F.lit(" "), F.col("n").cast("string")).alias("line"))


def table_from_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, fetch_size: int = 10_000) -> DataFrame:
    """A database table, read in parts where a numeric column and its bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column and bounds:
        for k, v in (("partitionColumn", partition_column), ("lowerBound", bounds[0]), ("upperBound", bounds[1]), ("numPartitions", partitions)):
            reader = reader.option(k, v)
    return reader.load()
