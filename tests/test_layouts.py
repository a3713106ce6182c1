"""Ranged tables, filtered indexes with an output a file, fetchers, and orders that no single task makes."""

import gzip
import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from textmill.operators import sampling
from textmill.operators.ingest import DOCX_MIME
from textmill.sources import archive, store


def scan_rows(df):
    """The rows that a query's scan has decoded."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value(), leaf.toString()


def test_ranges_are_pruned_in_the_scan(spark, tmp_path):
    rows = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), "id").toDF("id", "n")
    path = str(tmp_path / "t")
    store.write_ranged(rows, path, "id", files=16, row_group_mb=1)
    got = store.key_range(spark, path, "40", "48")
    read, plan = scan_rows(got)
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,40), LessThan(id,48)]" in plan
    assert got.count() == rows.where("id >= '40' and id < '48'").count() > 0 and read < 200_000 * 0.2
    borders = store.range_borders(spark, path, 4)
    parts = [store.key_range(spark, path, a, b).count() for a, b in borders]
    assert len(parts) == 4 and sum(parts) == 200_000 and max(parts) < 70_000
    store.write_ranged(rows.limit(0), path, "id")
    assert store.range_borders(spark, path, 4) == [(None, None)]


def test_an_output_for_each_index_file(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, n, bad):
        lines = [f'org,x)/ 2025 {json.dumps({"url": f"{name}{k}", "mime": DOCX_MIME, "status": "200" if k >= bad else "404"})}' for k in range(n)] + ["other"]
        with gzip.open(tmp_path / "in" / f"{name}.gz", "wt") as f:
            f.write("\n".join(lines))

    put("a", 5, 2)
    put("b", 7, 0)
    put("none", 3, 3)
    for _ in range(2):  # filtering again replaces
        got = archive.filter_index(spark, str(tmp_path / "in"), str(tmp_path / "out"), "C1").collect()
        assert sorted((r.file[-4:], r.n) for r in got) == [("a.gz", 3), ("b.gz", 7)]
    archive.filter_index(spark, str(tmp_path / "in" / "a.gz"), str(tmp_path / "out"), "C2")
    made = {p.parent.name[-4:]: p for p in (tmp_path / "out" / "crawl_id=C1").rglob("*.txt")}
    assert len(list((tmp_path / "out" / "crawl_id=C1").rglob("*.txt"))) == len(made) == 2
    assert {r.url for r in archive.read_records(spark, str(tmp_path / "out" / "crawl_id=C1")).collect()} == {"a2", "a3", "a4", *(f"b{k}" for k in range(7))}


def test_the_index_is_read_once(spark, tmp_path):
    """What is returned reads the outputs and a listing, never the index's lines again."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("x\n" * 9)
    assert archive.filter_index(spark, str(tmp_path / "in"), str(tmp_path / "out"), "C0").collect() == []
    (tmp_path / "in" / "b").write_text('x {"url": "u", "mime": "%s", "status": "200"}\n' % DOCX_MIME)
    got = archive.filter_index(spark, str(tmp_path / "in"), str(tmp_path / "out"), "C1")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in got.collect()] == [1] and f"{tmp_path}/in" not in "".join(x for x in plan.split("\n") if "FileScan text" in x)


class Ranges(http.server.BaseHTTPRequestHandler):
    body = bytes(range(256)) * 4

    def do_GET(self):
        if self.path == "/busy":
            return self.send_error(503)
        if self.path == "/whole":
            self.send_response(200)
            self.end_headers()
            return self.wfile.write(self.body)
        if self.path != "/w":
            return self.send_error(404)
        a, b = map(int, self.headers["Range"].removeprefix("bytes=").split("-"))
        self.send_response(206)
        self.end_headers()
        self.wfile.write(self.body[a : b + 1])

    def log_message(self, *_):
        pass


def test_fetchers(tmp_path):
    (tmp_path / "w").write_bytes(Ranges.body)
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Ranges)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        at = f"http://127.0.0.1:{server.server_port}"
        for fetch in (archive.fetcher(at), archive.fetcher(f"file://{tmp_path}"), archive.fetcher(str(tmp_path))):
            assert fetch("w", 10, 5) == Ranges.body[10:15]
            with pytest.raises(archive.FetchError, match="404"):
                fetch("none", 0, 1)
        assert archive.fetcher(at)("whole", 10, 5) == Ranges.body[10:15]
        with pytest.raises(archive.FetchError, match="503") as e:
            archive.fetcher(at)("busy", 0, 1)
        assert e.value.status in archive.TRY_AGAIN
    finally:
        server.shutdown()
        server.server_close()
    with pytest.raises(archive.FetchError) as e:
        archive.http_range(at, 2)("w", 0, 1)
    assert e.value.status is None


def test_slices_of_ids_without_exchange_reuse(spark):
    key = "spark.sql.exchange.reuse"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        rows = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("id"))
        got = sampling.id_chunks(rows, 7)
        sizes = {r.worker: (r.n, r.a, r.b) for r in got.groupBy("worker").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).collect()}
    finally:
        spark.conf.set(key, before)
    assert [sizes[k][0] for k in range(7)] == [14286] * 6 + [100_000 - 6 * 14286]
    assert all(sizes[k][2] < sizes[k + 1][1] for k in range(6))


def brute_round_robin(rows, n):
    import hashlib

    md5 = lambda x: hashlib.md5(f"{x}:42".encode()).hexdigest()
    turn, out = {}, set()
    for g in {r[1] for r in rows}:
        own = []
        for d in {r[2] for r in rows if r[1] == g}:
            ids = sorted((r[0] for r in rows if r[1] == g and r[2] == d), key=lambda i: (md5(i), i))
            own += [(t, md5(d), d, i) for t, i in enumerate(ids, 1)]
        for place, (t, _, _, i) in enumerate(sorted(own)[:n], 1):
            out.add((i, g, t, place))
    return out


def test_round_robin_of_hot_groups_and_domains(spark):
    rows = [(i, "hot" if i % 10 else "cold", "one.org" if i % 3 else f"d{i % 400}.org") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, g string, domain string").repartition(7)
    for n in (1, 50, 700, 5000):
        got = {(r.id, r.g, r.turn, r.place) for r in sampling.round_robin(df, ["g"], "domain", F.lit(n)).collect()}
        assert got == brute_round_robin(rows, n)
