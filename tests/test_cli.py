"""The command line, from index files to an export."""

import gzip
import json

from pyspark.sql import functions as F

from tests.test_records import docx, warc
from textmill.__main__ import main
from textmill.operators.ingest import DOCX_MIME
from textmill.plans import jobs
from textmill.sources import store


def test_commands(spark, tmp_path, capsys):
    raw = gzip.compress(warc(docx(b"one")))
    (tmp_path / "w.gz").write_bytes(raw)
    line = {"url": "https://x.org/a.docx", "mime": DOCX_MIME, "status": "200", "digest": "d", "length": str(len(raw)), "offset": "0", "filename": "w.gz"}
    with gzip.open(tmp_path / "cdx.gz", "wt") as f:
        f.write("org,x)/ 2025 " + json.dumps(line) + "\n")
    root = f"{tmp_path}/root"
    run = lambda *a: main([a[0], "--root", root, *a[1:]], spark)
    run("filter-index", "--crawl", "C1", "--index", f"{tmp_path}/cdx.gz")
    run("crawls")
    run("scrape", "--crawl", "C1", "--archive", str(tmp_path), "--rps", "100")
    run("scrape", "--crawl", "1", "--archive", str(tmp_path), "--rps", "100")
    run("extract")
    run("embed")
    run("status")
    run("export", "--output", f"{tmp_path}/export")
    run("manifest", "--output", f"{tmp_path}/manifest")
    rows = spark.read.parquet(f"{root}/documents").collect()
    assert [(r.status, r.word_count, len(r.embedding)) for r in rows] == [("uploaded", 4, 64)]
    assert spark.read.parquet(f"{tmp_path}/export").count() == 0
    assert "embedded" in capsys.readouterr().out


def test_label_and_classify(spark, tmp_path):
    """A sample is drawn and labelled (twice: nothing is labelled again), and the rest classified."""
    root = f"{tmp_path}/root"
    files = [gzip.compress(warc(docx(b"doc %d" % k))) for k in range(6)]
    (tmp_path / "w.gz").write_bytes(b"".join(files))
    with gzip.open(tmp_path / "cdx.gz", "wt") as f:
        for k, raw in enumerate(files):
            line = {"url": f"https://x{k}.org/a.docx", "mime": DOCX_MIME, "status": "200", "digest": "d", "length": str(len(raw)), "offset": str(sum(map(len, files[:k]))), "filename": "w.gz"}
            f.write("org,x)/ 2025 " + json.dumps(line) + "\n")
    run = lambda *a: main([a[0], "--root", root, *a[1:]], spark)
    run("filter-index", "--crawl", "C1", "--index", f"{tmp_path}/cdx.gz")
    run("scrape", "--crawl", "C1", "--archive", str(tmp_path))  # at its default rate
    run("extract")
    run("extract")
    assert spark.read.parquet(f"{root}/texts").count() == 6
    run("sample", "--output", f"{tmp_path}/sample", "--total", "5")
    run("label", "--input", f"{tmp_path}/sample", "--output", f"{tmp_path}/labels")
    run("label", "--input", f"{tmp_path}/sample", "--output", f"{tmp_path}/labels")
    n = spark.read.json(f"{tmp_path}/labels").count()
    assert n == spark.read.json(f"{tmp_path}/sample").count() > 0
    run("classify", "--input", f"{tmp_path}/labels")
    assert spark.read.parquet(f"{root}/documents").where("document_type is not null").count() == 6


def test_catalog_republish_relabel_and_evaluate(spark, tmp_path, capsys):
    """All crawls of a catalog are filtered once; uploads are inspected and corrected; labels are renamed and reported."""
    body = docx(b"one")
    raw = gzip.compress(warc(body + b"\r\n\r\n"))
    (tmp_path / "w.gz").write_bytes(raw)
    for crawl in ("C1", "C2"):
        line = {"url": f"https://x.org/{crawl}.docx", "mime": DOCX_MIME, "status": "200", "digest": "d", "length": str(len(raw)), "offset": "0", "filename": "w.gz"}
        with gzip.open(tmp_path / f"cdx-{crawl}.gz", "wt") as f:
            f.write("org,x)/ 2025 " + json.dumps(line) + "\n")
    (tmp_path / "crawls.json").write_text(json.dumps([{"id": "C2"}, {"id": "C1"}]))
    root = f"{tmp_path}/root"
    run = lambda *a: main([a[0], "--root", root, *a[1:]], spark)
    index = ("--catalog", f"{tmp_path}/crawls.json", "--index", f"{tmp_path}/cdx-{{crawl}}.gz")
    made = lambda: {p.parent.parent.name: p.stat().st_mtime_ns for p in tmp_path.rglob("root/filtered/**/*.txt")}
    run("filter-index", *index, "--latest", "1")
    first = made()
    assert set(first) == {"crawl_id=C2"}
    run("filter-index", *index, "--all")
    assert set(made()) == {"crawl_id=C1", "crawl_id=C2"} and made()["crawl_id=C2"] == first["crawl_id=C2"]
    run("scrape", "--crawl", "C1", "--archive", str(tmp_path), "--rps", "100")
    for _ in range(2):
        run("republish")
    got = spark.read.parquet(f"{root}/corrections").collect()
    assert [(r.status, r.correction_type) for r in got] == [("corrected", "trailing_crlf")]
    assert (tmp_path / "root" / "objects" / f"{got[0].corrected_id}.docx").read_bytes() == body
    run("extract", "--deadline", "20")
    documents = spark.read.parquet(f"{root}/documents").withColumn("document_type", F.lit("legal")).withColumn("classification_model", F.lit("old"))
    store.replace_table(documents, f"{root}/documents")
    model = lambda: {r.classification_model for r in spark.read.parquet(f"{root}/documents").collect()}
    run("relabel", "--from", "old", "--to", "new", "--dry-run")
    assert model() == {"old"}
    run("relabel", "--from", "old", "--to", "new")
    assert model() == {"new"}
    run("evaluate")
    assert "legal" in capsys.readouterr().out


def test_repair_of_a_folder(spark, tmp_path, capsys):
    body, folder = docx(b"one"), tmp_path / "files"
    (folder / "deep er").mkdir(parents=True)
    (folder / "a.docx").write_bytes(body + b"\r\n\r\n")
    (folder / "deep er" / "b.docx").write_bytes(body + b"\r\n\r\n")
    (folder / "clean.docx").write_bytes(body)
    (folder / "other.txt").write_bytes(body + b"\r\n\r\n")
    (tmp_path / "target").write_bytes(body + b"\r\n\r\n")
    (folder / "link.docx").symlink_to(tmp_path / "target")
    told = lambda **x: {r.key.split("/")[-1]: r.status for r in jobs.repair_folder(spark, str(folder), **x).collect()}
    assert told() == {"a.docx": "trimmed", "b.docx": "trimmed", "clean.docx": "already-clean", "link.docx": "skipped-symlink"}
    assert (folder / "a.docx").read_bytes() != body
    main(["repair", "--input", str(folder), "--in-place"], spark)
    assert "trimmed" in capsys.readouterr().out
    assert (folder / "a.docx").read_bytes() == body == (folder / "deep er" / "b.docx").read_bytes() and (tmp_path / "target").read_bytes() != body
    assert (folder / "link.docx").is_symlink() and set(told().values()) == {"already-clean", "skipped-symlink"}
