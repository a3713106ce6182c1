"""Operators over small frames, sources and sinks, and the stream."""

import gzip
import json
from datetime import datetime

from pyspark.sql import functions as F

from textmill.functions import vectors as V
from textmill.operators import ingest, learning, mutations, sampling, search, stats
from textmill.operators import predicates as P
from textmill.sources import archive, store
from textmill.streaming import ingest as streaming
from tests.test_records import docx, warc


def now():
    return F.lit(datetime(2025, 1, 1)).cast("timestamp")

DOCS = "id string, source_url string, crawl_id string, status string, error_message string"


def test_identity(spark):
    rows = [("u", bytearray(docx()), None, 0), ("v", bytearray(docx()), None, 1), ("w", bytearray(b"bad"), None, 2), ("x", None, "HTTP 404", 3)]
    fetched = spark.createDataFrame(rows, "url string, content binary, error string, position long")
    empty = spark.createDataFrame([], DOCS)
    out = {r.source_url: r for r in ingest.identified(fetched, empty, "C1", now()).collect()}
    assert out["u"].status == "uploaded" and out["u"].is_valid_docx and len(out["u"].id) == 64
    assert out["v"].status == "duplicate" and out["v"].id.startswith("dup-") and out["u"].id in out["v"].error_message
    assert out["w"].status == "failed" and out["w"].is_valid_docx is False and "small" in out["w"].error_message
    assert out["x"].status == "failed" and out["x"].id.startswith("failed-") and out["x"].is_valid_docx is None
    known = spark.createDataFrame([(out["u"].id, "other", "C0", "uploaded", None)], DOCS)
    again = {r.source_url: r.status for r in ingest.identified(fetched, known, "C1", now()).collect()}
    assert again["u"] == "duplicate"
    same = spark.createDataFrame([(out["u"].id, "u", "C0", "uploaded", None)], DOCS)
    assert {r.source_url: r.status for r in ingest.identified(fetched, same, "C1", now()).collect()}["u"] == "uploaded"


def test_seen_urls(spark):
    docs = spark.createDataFrame([("a", "u1", "C1", "uploaded", None), ("b", "u2", "C2", "failed", None)], DOCS)
    records = spark.createDataFrame([("u1",), ("u1",), ("u2",), ("u3",), ("u3",)], "url string")
    urls = lambda df: sorted(r[0] for r in df.select("url").collect())
    assert urls(ingest.unseen(records, docs)) == ["u3"]
    assert urls(ingest.unseen(records, docs, retry_failed=True)) == ["u2", "u3"]
    assert urls(ingest.unseen(records, docs, force=True)) == ["u1", "u2", "u3"]
    assert [r.source_url for r in ingest.cross_crawl_duplicates(records, docs, "C2", now()).collect()] == ["u1"]
    failed = spark.createDataFrame([("u2",)], "source_url string").select(F.concat(F.lit("failed-"), F.sha2("source_url", 256)).alias("id"), F.lit("C2").alias("crawl_id"))
    stored = spark.createDataFrame([("h", "u2")], "id string, source_url string")
    assert ingest.refetched(failed, stored, "C2").count() == 0 and ingest.refetched(failed, stored, "C1").count() == 1


def test_crawl_and_archive(spark, tmp_path):
    body = docx()
    record = gzip.compress(warc(body))
    (tmp_path / "a.warc.gz").write_bytes(b"skip" + record)
    line = lambda **x: "org,x)/ 2025 " + json.dumps(x)
    good = {"url": "https://x.org/a.docx", "mime": ingest.DOCX_MIME, "status": "200", "digest": "d", "length": str(len(record)), "offset": "4", "filename": "a.warc.gz"}
    lines = [line(**good), line(**good | {"status": "404"}), line(**good | {"mime": "text/html"}), "no json " + ingest.DOCX_MIME, "x {bad " + ingest.DOCX_MIME, line(**good | {"url": "https://x.org/gone.docx", "filename": "none"})]
    (tmp_path / "index").mkdir()
    with gzip.open(tmp_path / "index" / "cdx-0.gz", "wt") as f:
        f.write("\n".join(lines))
    counts = archive.filter_index(spark, str(tmp_path / "index"), str(tmp_path / "filtered"), "C1")
    assert [r.n for r in counts.collect()] == [2]
    records = archive.read_records(spark, str(tmp_path / "filtered" / "crawl_id=C1"))
    fetched = archive.fetch_records(records, archive.local_range(str(tmp_path)), rps=1000, partitions=2, tries=1)
    out = {r.url: r for r in fetched.collect()}
    assert bytes(out["https://x.org/a.docx"].content) == body and out["https://x.org/a.docx"].error is None
    assert out["https://x.org/gone.docx"].error == "HTTP 404"
    listed = archive.filtered_crawls(spark, str(tmp_path / "filtered")).where("id = 'crawl_id=C1'").collect()
    assert listed and listed[0].total_size > 0
    (tmp_path / "crawls.json").write_text(json.dumps([{"id": "C3"}, {"id": "C2"}]))
    catalog = archive.crawl_catalog(spark, str(tmp_path / "crawls.json"))
    assert [r.id for r in ingest.newest_crawls(catalog, 1).collect()] == ["C3"]


def test_store(spark, tmp_path):
    s = store.ObjectStore(spark, f"file://{tmp_path}/objects")
    assert s.read("a/b.bin") is None
    assert s.write_if_absent("a/b.bin", b"\x00\xff") and not s.write_if_absent("a/b.bin", b"zz")
    assert s.read("a/b.bin") == b"\x00\xff" and s.exists("a/b.bin")
    assert [(r.key, r.length) for r in s.objects().collect()] == [("objects/a/b.bin", 2)] or [(r.key, r.length) for r in s.objects().collect()] == [("a/b.bin", 2)]
    rows = spark.createDataFrame([("h1", bytearray(b"x")), ("h1", bytearray(b"x"))], "id string, content binary")
    store.write_absent_objects(rows, f"file://{tmp_path}/put")
    assert (tmp_path / "put" / "h1.docx").read_bytes() == b"x"
    table = str(tmp_path / "table")
    store.replace_table(spark.range(3), table)
    store.replace_table(spark.read.parquet(table).where("id > 0"), table)
    assert spark.read.parquet(table).count() == 2
    ids = spark.createDataFrame([("b",), ("a",)], "id string")
    assert store.write_manifest(ids, str(tmp_path / "m")) and not store.write_manifest(ids.limit(0), str(tmp_path / "none"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ["a", "b"]
    labels = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "id string, at int, v string")
    assert [(r.id, r.v) for r in store.last_per_id(labels, "at").collect()] == [("a", "y")]
    taxonomy = {"name": "t", "version": "1", "document_types": [{"id": "x", "label": "X", "description": "d", "examples": ["e"]}], "topics": [{"id": "y", "label": "Y", "description": "d"}]}
    (tmp_path / "t.json").write_text(json.dumps(taxonomy, indent=1))
    assert [(r.dimension, r.id) for r in store.read_taxonomy(spark, str(tmp_path / "t.json")).orderBy("dimension").collect()] == [("topic", "y"), ("type", "x")]


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    row = {"url": "u1", "mime": "m", "status": "200", "digest": "d", "length": "1", "offset": "0", "filename": "f"}
    (source / "1.json").write_text("\n".join(json.dumps(row | {"url": u}) for u in ("u1", "u2", "u1")))
    run = lambda: streaming.run_available(streaming.once_each(streaming.record_stream(spark, str(source), 1)), streaming.table_sink(str(tmp_path / "t"), "url"), str(tmp_path / "c"))
    run()
    (source / "2.json").write_text("\n".join(json.dumps(row | {"url": u}) for u in ("u2", "u3")))
    run()
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["u1", "u2", "u3"]


def test_corrections(spark):
    objects = spark.createDataFrame(
        [("a", bytearray(docx() + b"\r\n\r\n"), None), ("b", bytearray(docx()), None), ("c", bytearray(b"x"), None), ("d", None, "gone")],
        "raw_id string, content binary, error string",
    )
    out = {r.raw_id: r for r in ingest.corrections_of(objects).collect()}
    assert out["a"].status == "corrected" and out["a"].raw_file_size_bytes - out["a"].corrected_file_size_bytes == 4
    assert out["b"].status == "already_clean" and (out["c"].status, out["c"].reason) == ("skipped", "non-zip")
    assert (out["d"].status, out["d"].reason) == ("error", "gone")


def test_mutations(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, v string")
    new = spark.createDataFrame([("a", None), ("c", 3)], "id string, n int")
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert key(mutations.upsert(old, new)) == [("a", None, "x"), ("b", 2, "y"), ("c", 3, None)]
    assert key(mutations.update(old, new)) == [("a", None, "x"), ("b", 2, "y")]
    assert key(mutations.insert_ignore(old, new).select("id")) == [("a",), ("b",), ("c",)]
    assert key(mutations.delete(old, new)) == [("b", 2, "y")]
    late = spark.createDataFrame([("a", 1, "z")], "id string, n int, v string")
    assert key(mutations.latest_per_key(old, late, "id", "n")) == [("a", 1, "z"), ("b", 2, "y")]


def test_sampling(spark):
    rows = [(f"d{i:04d}", f"https://s{i % 7}.org/x", "en" if i % 3 else "de", i % 100 + 1, 1, None) for i in range(900)]
    docs = spark.createDataFrame(rows, "id string, source_url string, language string, word_count int, extracted_at int, extraction_error string")
    counts = stats.sampling_counts(docs, ["en", "de"])
    allocated = sampling.allocation(counts, 91)
    assert sum(r.allocated for r in allocated.collect()) == 91
    sample = sampling.stratified(docs, allocated).collect()
    assert len(sample) == 91 == len({r.id for r in sample})
    for language, n in {r.language: r.allocated for r in allocated.collect()}.items():
        own = [r for r in sample if r.language == language]
        bins = [sum(r.tercile == k for r in own) for k in range(3)]
        assert len(own) == n and max(bins) - min(bins) <= 1
        for k in range(3):
            by_domain = [sum(r.domain == f"s{j}.org" for r in own if r.tercile == k) for j in range(7)]
            assert max(by_domain) - min(by_domain) <= 1
    excluded = sampling.stratified(docs, allocated, docs.where("id < 'd0450'"))
    assert excluded.where("id < 'd0450'").count() == 0
    tiny = spark.createDataFrame([("d", 8)], "language string, word_count int").select("language", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("word_count"), F.lit("x").alias("id"))
    thirds = [r.n for r in sampling.terciles(tiny, "language").groupBy("tercile").agg(F.count("*").alias("n")).orderBy("tercile").collect()]
    assert thirds == [2, 2, 4]


def test_vectors(spark):
    rows = spark.createDataFrame([("one", [3.0, 4.0], 5), ("two", [1.0, 0.0], 3), ("two", [0.0, 1.0], 1)], "id string, vector array<double>, weight int")
    out = {r.id: r.vector for r in V.document_vectors(rows).collect()}
    assert out["one"] == [3.0, 4.0]
    assert abs(sum(x * x for x in out["two"]) - 1) < 1e-9 and abs(out["two"][0] / out["two"][1] - 3) < 1e-9
    text = spark.createDataFrame([([1.5, 2.0],)], "v array<float>").select(V.from_text(V.to_text("v")).alias("v")).first().v
    assert text == [1.5, 2.0]
    vectors = spark.range(60).select(F.col("id").alias("vec_id"), F.array(F.cos("id").cast("float"), F.sin("id").cast("float")).alias("embedding"))
    assert V.nearest(vectors, [1.0, 0.0], 1).first().vec_id == 0
    model, hashed = V.approximate_index(vectors)
    assert hashed.count() == 60


def test_search(spark):
    docs = spark.createDataFrame(
        [("a", "f", "legal", "finance", "en", 5, 0.9), ("b", "", "legal", "general", None, 5, None), ("c", None, "forms", "finance", "de", 5, 0.2), ("d", "g", None, None, "en", 5, 0.99)],
        "id string, original_filename string, document_type string, document_topic string, language string, word_count int, classification_confidence double",
    )
    assert [r.id for r in search.page(docs).collect()] == ["a", "c", "b"]
    assert [r.id for r in search.page(docs, 2, 1).collect()] == ["c"]
    assert [r.id for r in search.page(docs, type="legal", min_confidence="x").collect()] == ["a", "b"]
    facets = {(r.facet, r.value): r.n for r in stats.facets(docs, type="legal").collect()}
    assert facets == {("type", "legal"): 2, ("type", "forms"): 1, ("topic", "finance"): 1, ("topic", "general"): 1, ("lang", "en"): 1, ("lang", "unknown"): 1}
    assert {r.filename for r in search.export_rows(docs, "b/").collect()} == {"f", "unknown.docx"}
    assert stats.with_share(docs.limit(0).select(F.lit(0).alias("n"))).count() == 0
    assert P.confident_labels(spark.createDataFrame([(0.5,), (None,)], "confidence double"), 0.1).count() == 1


def test_learning(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", "")], "id string, prompt string")
    said = learning.label(rows).collect()
    assert len(said) == 2 and all(0 <= r.confidence <= 1 for r in said)
    docs = spark.createDataFrame([("a", "word " * 3000), ("b", " ")], "id string, text string")
    out = learning.embed(docs).collect()
    assert [r.id for r in out] == ["a"] and len(out[0].vector) == 64
    labels = learning.label_map(spark, ("x", "y", "z"))
    weights = {r.label: r.weight for r in learning.class_weights(spark.createDataFrame([("x",), ("x",), ("y",)], "label string"), labels, "label").collect()}
    assert weights == {"x": 3 / 6, "y": 1.0, "z": 1.0}
