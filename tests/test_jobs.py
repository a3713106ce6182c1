"""The jobs end to end on a small crawl."""

import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from textmill.operators import learning
from textmill.plans import jobs
from textmill.schemas import CORRECTIONS, DOCUMENTS, TOPICS, TYPES
from textmill.sources import archive
from tests.test_records import docx, warc


def now():
    return F.lit(datetime(2025, 1, 1)).cast("timestamp")


@pytest.fixture(scope="module")
def crawl(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("crawl")
    bodies = {"https://a.org/1.docx": docx(b"one"), "https://b.org/2.docx": docx(b"one"), "https://c.org/3.docx": docx(b"x") + b"\r\n\r\n", "https://d.org/4.docx": b"no document"}
    at, rows = 0, []
    with open(root / "w.gz", "wb") as f:
        for url, body in bodies.items():
            raw = gzip.compress(warc(body))
            f.write(raw)
            rows.append((url, "w.gz", at, len(raw)))
            at += len(raw)
    rows.append(("https://e.org/5.docx", "missing.gz", 0, 9))
    records = spark.createDataFrame(rows, "url string, filename string, range_start long, range_length long")
    documents = spark.createDataFrame([], DOCUMENTS)
    new, objects = jobs.scrape(records, documents, "C1", archive.local_range(str(root)), now(), rps=1000)
    new = jobs.scraped(documents, new, "C1").cache()
    return records, new, objects.cache(), root


def test_scrape(spark, crawl):
    records, documents, objects, root = crawl
    status = {r.source_url: r.status for r in documents.collect()}
    assert sorted(status.values()) == ["duplicate", "failed", "failed", "uploaded", "uploaded"]
    assert status["https://d.org/4.docx"] == "failed" and status["https://e.org/5.docx"] == "failed"
    assert objects.count() == 2
    again, _ = jobs.scrape(records, documents, "C2", archive.local_range(str(root)), now(), rps=1000)
    assert {r.status for r in again.collect()} == {"duplicate"} and again.count() == 5
    same, _ = jobs.scrape(records, documents, "C1", archive.local_range(str(root)), now(), rps=1000)
    assert same.count() == 0


def test_later_stages(spark, crawl):
    _, documents, objects, _ = crawl
    done, texts = jobs.extract(documents, objects, now())
    done = done.cache()
    rows = [r for r in done.collect() if r.status == "uploaded"]
    assert all(r.extracted_at and r.word_count == 4 and r.table_count == 1 and r.language == "unknown" for r in rows)
    assert {r.text for r in texts.collect()} == {"Hello\n\na | b"}
    embedded = jobs.embed(done, texts, now())
    assert sum(r.embedding is not None for r in embedded.collect()) == 2
    gone = jobs.embed(done, texts.limit(0), now())
    assert {r.embedding_model for r in gone.collect() if r.embedded_at} == {"skipped:empty"}
    known = spark.createDataFrame([("a b c", t, i) for i, t in enumerate(TYPES)] + [("z", TYPES[0], 0)], "text string, label string, index int")
    topics = spark.createDataFrame([("a b", t, i) for i, t in enumerate(TOPICS)], "text string, label string, index int")
    train = lambda rows, ids: learning.train_classifier(rows, learning.class_weights(rows, learning.label_map(spark, ids), "label"), "label", 64)
    labelled = jobs.classify(done, texts, train(known, TYPES), train(topics, TOPICS), TYPES, TOPICS)
    out = [r for r in labelled.collect() if r.document_type]
    assert len(out) == 2 and all(r.document_type in TYPES and 0 < r.classification_confidence <= 1 and r.classification_model == "hashing-logistic-v1" for r in out)
    payload = jobs.documents_payload(labelled, 1, 1)
    assert payload["total"] == 2 and payload["pages"] == 2 and len(payload["documents"]) == 1 and payload["facets"]["type"]
    assert jobs.stats_payload(labelled)["total"] == 2
    assert jobs.manifest_text(labelled, "https://x/").count("\n") == 2


def test_republish(spark, crawl):
    _, documents, objects, _ = crawl
    corrections, fixed = jobs.republish(documents, spark.createDataFrame([], CORRECTIONS), objects, now())
    assert sorted(r.status for r in corrections.collect()) == ["already_clean", "corrected"]
    assert fixed.count() == 1
    twice, none = jobs.republish(documents, corrections, objects, now())
    assert none.count() == 0 and twice.count() == 2
