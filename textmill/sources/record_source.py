"""Archive records as a Spark data source, in batches and as a stream: spark.read.format("archive_records").

An index of JSON lines says where each record lies in large archive files. Index files
are cut into ranges of bytes, a task each; a task parses its lines in bulk, applies the
filters that Spark pushes down, and only then fetches what is left, one range of an
archive file a record. The stream's offset is the newest index file handled, and a
micro-batch reads what the batch reader would read of the files since then.

Options: path (index files: a folder or a file, any address pyarrow knows), archive
(where the record files are; without it content is null), partitionBytes, pushdown
(true lets Spark hand filters over, which spark.sql.python.filterPushdown.enabled has
to allow).
"""

from __future__ import annotations

import io
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringContains, StringEndsWith, StringStartsWith,
)

NAME = "archive_records"
FIELDS = ("url", "mime", "status", "digest", "length", "offset", "filename")
SCHEMA = ", ".join(f"{c} string" for c in FIELDS) + ", range_start long, range_length long, content binary, error string, index_file string"
_TEXT = pa.schema([(c, pa.string()) for c in FIELDS])
_OUT = pa.schema([*_TEXT, ("range_start", pa.int64()), ("range_length", pa.int64()), ("content", pa.binary()), ("error", pa.string()), ("index_file", pa.string())])
#: Lines are parsed, and fetched records passed on, so many bytes at a time.
CHUNK_BYTES = 8 << 20


def _files(address: str):
    """(file system, path) of an address; a plain path is one that driver and executors share."""
    from pyarrow import fs

    address = address.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(address if ":/" in address else f"file://{os.path.abspath(address)}")


@dataclass(frozen=True)
class IndexFile:
    path: str
    size: int
    time: int


def index_files(address: str) -> list[IndexFile]:
    """The index files at an address, oldest first; hidden ones aren't any."""
    from pyarrow import fs

    files, path = _files(address)
    at = files.get_file_info(path)
    found = [at] if at.type == fs.FileType.File else files.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True))
    shown = [f for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
    return sorted((IndexFile(f.path, f.size, f.mtime_ns or 0) for f in shown), key=lambda f: (f.time, f.path))


@dataclass
class Range(InputPartition):
    """The lines that begin in a range of bytes of a file."""

    path: str
    begin: int
    end: int

    def __init__(self, path: str, begin: int, end: int):
        super().__init__(None)
        self.path, self.begin, self.end = path, begin, end


def ranges(files: list[IndexFile], size: int) -> list[Range]:
    """Cuts of about equal size; a compressed file is one."""
    out = []
    for f in files:
        step = max(1, f.size) if f.path.endswith(".gz") else size
        out += [Range(f.path, at, min(at + step, f.size)) for at in range(0, f.size, step)]
    return out


def lines_of(address: str, part: Range) -> Iterator[bytes]:
    """Whole lines, some MB at a time. A line belongs to the range that it begins in."""
    files, _ = _files(address)
    if part.path.endswith(".gz"):
        with files.open_input_stream(part.path, compression="gzip") as f:
            rest = b""
            while data := f.read(CHUNK_BYTES):
                whole, cut, rest = (rest + data).rpartition(b"\n")
                yield whole + cut
            yield rest
        return
    with files.open_input_file(part.path) as f:
        at = part.begin
        if at:
            f.seek(at - 1)  # a line that begins here follows a line feed
            at += len(_rest_of_line(f)) - 1
        while at < part.end:
            f.seek(at)
            data = f.read(min(CHUNK_BYTES, part.end - at))
            if not data.endswith(b"\n"):
                data += _rest_of_line(f)
            at += len(data)
            yield data


def _rest_of_line(f) -> bytes:
    out = io.BytesIO()
    while data := f.read(1 << 16):
        line, cut, _ = data.partition(b"\n")
        out.write(line + cut)
        if cut:
            break
    return out.getvalue()


def parsed(lines: bytes) -> pa.Table:
    """Records of JSON lines; blank lines are skipped, and a malformed one is an error."""
    from pyarrow import json as arrow_json

    lines = b"\n".join(x for x in lines.split(b"\n") if x.strip())
    if not lines:
        return _TEXT.empty_table()
    how = arrow_json.ParseOptions(explicit_schema=_TEXT, unexpected_field_behavior="ignore")
    return arrow_json.read_json(io.BytesIO(lines), read_options=arrow_json.ReadOptions(block_size=len(lines) + 1), parse_options=how)


@dataclass
class Wanted:
    """Filters on the text columns that are applied before anything is fetched."""

    kept: list[tuple[str, str, object]] = field(default_factory=list)

    def take(self, f: Filter) -> bool:
        """Whether f is one that is applied here."""
        kinds = {EqualTo: "equal", In: "in", IsNotNull: "known", StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains"}
        kind, column = kinds.get(type(f)), getattr(f, "attribute", ())
        if kind is None or len(column) != 1 or column[0] not in FIELDS:
            return False
        self.kept.append((kind, column[0], getattr(f, "value", None)))
        return True

    def apply(self, rows: pa.Table) -> pa.Table:
        tests = {
            "equal": pc.equal, "starts": pc.starts_with, "ends": pc.ends_with, "contains": pc.match_substring,
            "in": lambda x, v: pc.is_in(x, pa.array([i for i in v if i is not None], pa.string())), "known": lambda x, _: pc.is_valid(x),
        }
        for kind, column, value in self.kept:
            rows = rows.filter(tests[kind](rows[column], value))
        return rows


class _Records:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("archive_records needs a path")
        self.archive = options.get("archive")
        self.size = int(options.get("partitionbytes", 32 << 20))
        self.wanted = Wanted()

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for lines in lines_of(self.path, partition):
            rows = self.wanted.apply(parsed(lines))
            begin, size = (_whole_number(rows[c]) for c in ("offset", "length"))
            for at, contents, errors in self._contents(rows["filename"], begin, size):
                cut = slice(at, at + len(contents))
                part = rows.slice(at, len(contents))
                columns = [*(part[c].combine_chunks() for c in FIELDS), pa.array(begin[cut], pa.int64()), pa.array(size[cut], pa.int64())]
                columns += [pa.array(contents, pa.binary()), pa.array(errors, pa.string()), pa.array([partition.path] * len(contents), pa.string())]
                columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
                yield pa.RecordBatch.from_arrays(columns, schema=_OUT)

    def _contents(self, names, begin: list, size: list) -> Iterator[tuple[int, list, list]]:
        """(first row, contents, errors) of rows one after another, some MB at a time; a record that can't be read is an error, not the end."""
        n = len(begin)
        if not self.archive:
            yield 0, [None] * n, [None] * n
            return
        files, root = _files(self.archive)
        first, contents, errors, held, opened = 0, [], [], 0, (None, None)
        for k, name in enumerate(names.to_pylist()):
            data, error = None, None
            try:
                if name is None or begin[k] is None or size[k] is None or begin[k] < 0 or size[k] < 0:
                    raise ValueError("no byte range")
                if opened[0] != name:
                    opened = (name, files.open_input_file(f"{root}/{name}"))
                data = opened[1].read_at(size[k], begin[k])
                if len(data) < size[k]:
                    data, error = None, "range beyond the file's end"
            except (OSError, ValueError) as e:
                opened = (None, None)
                error = "HTTP 404" if isinstance(e, FileNotFoundError) else str(e)
            contents.append(data)
            errors.append(error)
            held += len(data or b"")
            if held >= CHUNK_BYTES:
                yield first, contents, errors
                first, contents, errors, held = k + 1, [], [], 0
        yield first, contents, errors


def _whole_number(column) -> list[int | None]:
    """Numbers in decimal digits; what isn't one is null."""
    good = pc.match_substring_regex(column, r"^\s*[+-]?\d{1,18}\s*$")
    return [int(x) if g else None for x, g in zip(column.to_pylist(), good.to_pylist(), strict=True)]


class RecordReader(_Records, DataSourceReader):
    def partitions(self) -> list[Range]:
        return ranges(index_files(self.path), self.size) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _Records.read(self, partition) if partition.path else iter(())


class FilteringReader(RecordReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        yield from [f for f in filters if not self.wanted.take(f)]


class RecordStream(_Records, DataSourceStreamReader):
    """Index files that appear whole, each later than those before; files of one moment go by their names."""

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = index_files(self.path)
        return {"time": files[-1].time, "path": files[-1].path} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        after, upto = ((x["time"], x["path"]) for x in (start, end))
        return ranges([f for f in index_files(self.path) if after < (f.time, f.path) <= upto], self.size)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _Records.read(self, partition)


class ArchiveRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        options = {k.lower(): v for k, v in self.options.items()}
        return (FilteringReader if json.loads(options.get("pushdown", "false").lower()) else RecordReader)(options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RecordStream({k.lower(): v for k, v in self.options.items()})


def read_archive(spark: SparkSession, path: str, archive: str | None = None, partition_bytes: int = 32 << 20) -> DataFrame:
    """The records of an index; filters on text columns reach the source where the session allows it."""
    spark.dataSource.register(ArchiveRecords)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    reader = spark.read.format(NAME).option("path", path).option("partitionBytes", partition_bytes).option("pushdown", pushdown)
    return (reader.option("archive", archive) if archive else reader).load()


def stream_archive(spark: SparkSession, path: str, archive: str | None = None, partition_bytes: int = 32 << 20) -> DataFrame:
    """The same records as index files arrive."""
    spark.dataSource.register(ArchiveRecords)
    reader = spark.readStream.format(NAME).option("path", path).option("partitionBytes", partition_bytes)
    return (reader.option("archive", archive) if archive else reader).load()
