"""The data source of archive records: ranges, filters, streams."""

import gzip
import hashlib
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from textmill.sources import record_source as S
from textmill.streaming.ingest import appending_sink, run_available


def records(n, start=0):
    rng = random.Random(n)
    out, at, body = [], 0, b""
    for k in range(start, start + n):
        data = f"record {k} ".encode() * rng.randrange(1, 9)
        status = "200" if k % 3 else "404"
        out.append({"url": f"https://x{k % 5}.org/é{k}", "mime": "text/a", "status": status, "digest": "d", "length": str(len(data)), "offset": str(at), "filename": f"w{start}"})
        at, body = at + len(data), body + data
    return out, body


@pytest.fixture
def corpus(tmp_path):
    index, archive = tmp_path / "index", tmp_path / "archive"
    index.mkdir()
    archive.mkdir()

    def add(n, start, zipped=False):
        rows, body = records(n, start)
        (archive / f"w{start}").write_bytes(body)
        lines = ("\n".join(json.dumps(r | {"more": [1]}, ensure_ascii=False) for r in rows) + "\n\n").encode()
        part = index / f".part{start}"
        part.write_bytes(gzip.compress(lines) if zipped else lines)
        part.rename(index / (f"i{start}.gz" if zipped else f"i{start}"))
        return [(r["url"], body[int(r["offset"]) :][: int(r["length"])]) for r in rows]

    return index, archive, add


def told(df):
    return sorted((r.url, bytes(r.content)) for r in df.collect())


@pytest.mark.parametrize("size", [1, 37, 1000, 1 << 20])
def test_every_line_is_read_once(spark, corpus, size):
    index, archive, add = corpus
    want = add(60, 0) + add(40, 100, zipped=True)
    got = S.read_archive(spark, str(index), f"file://{archive}", size)
    if size == 1:  # as many tasks as bytes: some files only
        got, want = S.read_archive(spark, f"{index}/i0", str(archive), 50), want[:60]
    assert told(got) == sorted(want)
    assert got.rdd.getNumPartitions() >= (100 if size == 37 else 1)


def test_lines_begin_in_their_range(tmp_path):
    data = b"a\n\nbb\nccc\n" + b"d" * 200_000 + b"\nlast"
    (tmp_path / "f").write_bytes(data)
    path = str(tmp_path / "f")
    for step in (1, 2, 3, 5, 11):
        cut = [b"".join(S.lines_of(path, S.Range(path, at, min(at + step, 12)))) for at in range(0, 12, step)]
        assert b"".join(cut) == data[: data.index(b"\nlast") + 1], step
    assert b"".join(b"".join(S.lines_of(path, S.Range(path, at, min(at + 70_000, len(data))))) for at in range(0, len(data), 70_000)) == data


def test_filters_reach_the_source(spark, corpus):
    index, archive, add = corpus
    add(60, 0)
    key = "spark.sql.python.filterPushdown.enabled"
    before = spark.conf.get(key)
    try:
        for on in ("false", "true"):
            spark.conf.set(key, on)
            rows = S.read_archive(spark, str(index), str(archive))
            some = rows.where((F.col("status") == "200") & F.col("url").startswith("https://x1") & (F.col("range_start") > 100) & F.col("mime").isin("text/a", "b"))
            late = {r.url for r in rows.where("range_start > 100").collect()}
            assert {r.url for r in some.collect()} == {f"https://x1.org/é{k}" for k in range(60) if k % 3 and k % 5 == 1} & late
            plan = some._jdf.queryExecution().executedPlan().toString()
            # What the source applies is no longer a filter of Spark's.
            assert ("(status#" in plan.split("BatchScan")[0]) == (on == "false"), plan
    finally:
        spark.conf.set(key, before)


def test_unreadable_ranges_are_errors_of_their_rows(spark, corpus):
    index, archive, add = corpus
    add(5, 0)
    odd = [{"url": "a", "filename": "none", "offset": "0", "length": "3"}, {"url": "b", "filename": "w0", "offset": "x", "length": "3"}, {"url": "c", "filename": "w0", "offset": "0", "length": "9999"}, {"url": "d"}]
    (index / "odd").write_text("\n".join(map(json.dumps, odd)))
    got = {r.url: (r.content, r.error) for r in S.read_archive(spark, str(index), str(archive)).where("error is not null").collect()}
    assert set(got) == {"a", "b", "c", "d"} and got["a"] == (None, "HTTP 404") and got["c"][1] == "range beyond the file's end"
    (index / "bad").write_text('{"url": "x"\n')
    with pytest.raises(Exception, match="(?i)json"):
        S.read_archive(spark, str(index)).collect()


def test_no_files(spark, tmp_path):
    assert S.read_archive(spark, f"{tmp_path}/nothing").collect() == []


def test_stream_reads_what_batches_read_and_resumes(spark, corpus, tmp_path):
    index, archive, add = corpus
    want = add(30, 0)
    run = lambda: run_available(S.stream_archive(spark, str(index), str(archive), 500), appending_sink(f"{tmp_path}/out"), f"{tmp_path}/cp")
    run()
    assert told(spark.read.parquet(f"{tmp_path}/out")) == sorted(want)
    run()  # nothing new
    want += add(20, 200, zipped=True) + add(10, 300)
    run()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert told(out) == sorted(want) == told(S.read_archive(spark, str(index), str(archive)))


def test_fetched_bodies_are_passed_on_some_mb_at_a_time(spark, monkeypatch):
    from textmill.sources import archive

    kept = {}
    pointers = spark.createDataFrame([], "url string, filename string, range_start long, range_length long")
    plain = type(pointers).mapInPandas
    monkeypatch.setattr(type(pointers), "mapInPandas", lambda rows, run, shape: kept.setdefault("run", run) and plain(rows, run, shape))
    archive.fetch_records(pointers, lambda file, start, length: bytes(length), rps=1e9, partitions=1)
    columns = ["url", "filename", "range_start", "range_length", "position"]
    told = list(kept["run"](iter([pd.DataFrame([("u", "f", 0, 1 << 20, i) for i in range(20)], columns=columns)])))
    sizes = [sum(map(len, t["raw"])) for t in told]
    assert sum(sizes) == 20 << 20 and max(sizes) <= 4 << 20 and [i for t in told for i in t["position"]] == list(range(20))


def test_archive_files_are_even_whatever_the_ids(spark, tmp_path):
    from textmill.plans import engine_queries as Q

    rows = [(5 * k, None if k == 7 else f"text {k} é" * (k % 40), "web", "en", 9) for k in range(1000)] + [(None, "no id", "web", "en", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    index, archive, _ = Q._archive(spark, str(tmp_path))
    per_file = [r["count"] for r in spark.read.json(index).groupBy("filename").count().collect()]
    assert len(per_file) == 5 and max(per_file) < 300 and sum(per_file) == 1001
    for query in (Q.archive_source_records, Q.archive_source_stream):
        got = {r.url: (r.size, r.content_sha256) for r in query(spark, str(tmp_path)).collect()}
        want = {f"https://web.example.org:8080/files/doc%20{i}.docx?v=1": t for i, t, *_ in rows if i is not None and i % 10}
        assert got == {u: (None, None) if t is None else (len(t.encode()), hashlib.sha256(t.encode()).hexdigest()) for u, t in want.items()}


def test_archives_are_written_a_batch_at_a_time(spark, tmp_path):
    from textmill.sources import store

    rows = [(f"f{k % 3}", k, f"u{k}", None if k == 8 else bytes([k]) * k) for k in range(60)]
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set(key, "7")
        made = store.write_archives(spark.createDataFrame(rows, "id string, k int, url string, content binary"), f"{tmp_path}/a", "k", ".bin")
    finally:
        spark.conf.set(key, before)
    assert sorted(p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith(".")) == ["f0.bin", "f1.bin", "f2.bin"]
    got = {r.k: (r.url, (tmp_path / "a" / r.filename).read_bytes()[r.offset :][: r.length]) for r in made.collect()}
    assert got == {k: (u, x or b"") for _, k, u, x in rows}
    assert all((tmp_path / "a" / f"f{i}.bin").read_bytes() == b"".join(x or b"" for name, *_, x in rows if name == f"f{i}") for i in range(3))
