"""Registered queries over what the library stores and runs itself: indexes, record sources, streams, clustered tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from textmill.functions import records as R
from textmill.functions.supervised import with_deadline
from textmill.operators import language_model, learning, mutations
from textmill.operators.neighbours import VectorIndex, recall
from textmill.plans.corpus import documents, oracle
from textmill.plans.queries import _table, query
from textmill.plans.source_queries import _folder
from textmill.sources import store
from textmill.sources.clustered import ClusteredTable
from textmill.sources.record_source import read_archive, stream_archive
from textmill.streaming.ingest import appending_sink, run_available
from textmill.streaming.seen import clustered_sink, once_within, rocksdb_state

# ---- nearest neighbours -----------------------------------------------------------------------------------------


def _index(spark, d):
    vectors = _table(spark, d, "embeddings").select("vec_id", "embedding")
    return VectorIndex.build(vectors, f"{_folder(spark, 'vectors')}/index"), vectors.where("vec_id % 50 = 0")


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
  s AS (SELECT q.vec_id AS query, r.vec_id AS id, list_cosine_similarity(q.x, r.x) AS cosine FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
  SELECT query, row_number() OVER w AS rank, id, round(cosine, 6) AS cosine FROM s WINDOW w AS (PARTITION BY query ORDER BY cosine DESC, id) QUALIFY row_number() OVER w <= 10""")
def vector_index_neighbours(spark, d):
    """The ten nearest rows of every fiftieth one, through the index, until no list can hold a nearer one."""
    index, queries = _index(spark, d)
    return index.search_exact(queries, 10).withColumn("cosine", F.round("cosine", 6)).withColumn("rank", F.col("rank").cast("long"))


@query("SELECT count(*) FILTER (vec_id % 50 = 0) AS queries, count(*) AS indexed, true AS reached FROM embeddings")
def vector_index_recall(spark, d):
    """Whether as many lists as a sample needs hold nine tenths of the true ten nearest rows; every row is indexed."""
    index, queries = _index(spark, d)
    share = recall(index.search(queries, 10, index.probes_for(0.95)), index.search_exact(queries, 10))
    return share.select("queries", F.lit(int(index.sizes.sum())).cast("long").alias("indexed"), (F.col("recall") >= 0.9).alias("reached"))


# ---- archive records --------------------------------------------------------------------------------------------


def _archive(spark, d):
    """Texts as compressed records, some hundred to an archive file, and an index of JSON lines over them."""
    out = _folder(spark, "records")
    rows = documents(spark, d).select("doc_id", "source_url", "text")
    n = F.octet_length("text").cast("string")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/plain\r\nContent-Length: "), n, F.lit("\r\n\r\n"))
    record = R.gzipped(F.concat(head.cast("binary"), F.col("text").cast("binary"), F.lit("\r\n\r\n").cast("binary")))
    status = F.when(F.col("doc_id") % 10 != 0, "200").otherwise("404")
    file = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, rows.count() // 200))).cast("string")
    rows = rows.select(file.alias("id"), "doc_id", F.col("source_url").alias("url"), status.alias("status"), record.alias("content"))
    made = store.write_archives(rows, f"{out}/archive", "doc_id")
    text = [F.col(c).cast("string").alias(c) for c in ("length", "offset")]
    made.select(F.to_json(F.struct("url", F.lit("text/plain").alias("mime"), "status", F.lit("").alias("digest"), *text, "filename"))).write.text(f"{out}/index")
    return f"{out}/index", f"{out}/archive", out


_RECORDS_SQL = oracle("SELECT source_url AS url, octet_length(encode(text)) AS size, sha256(text) AS content_sha256 FROM corpus WHERE doc_id % 10 <> 0")


def _read(rows):
    """The bodies of records; blank index lines, which the text writer leaves, have been skipped."""
    body = R.parse_warc(R.gunzip_or_raw("content"))["content"]
    return rows.where("status = '200' AND error IS NULL").select("url", F.octet_length(body).alias("size"), F.sha2(body, 256).alias("content_sha256"))


@query(_RECORDS_SQL)
def archive_source_records(spark, d):
    """Records through the data source: index files by ranges of bytes, archive files by the records' ranges."""
    index, archive, _ = _archive(spark, d)
    return _read(read_archive(spark, index, archive, 1 << 20))


@query(_RECORDS_SQL)
def archive_source_stream(spark, d):
    """The same records, read by a stream to its end and then by a second run that finds nothing new."""
    index, archive, out = _archive(spark, d)
    for _ in range(2):
        run_available(stream_archive(spark, index, archive, 1 << 20), appending_sink(f"{out}/stream"), f"{out}/checkpoint")
    return _read(spark.read.parquet(f"{out}/stream"))


# ---- supervised processes ---------------------------------------------------------------------------------------


def _measured(body: bytes | None) -> tuple[int, int]:
    """Bytes and words of a text. Some hang, as parsers do, and some end their process."""
    import os
    import time

    number, text = (body or b"").split(b" ", 1)
    if int(number) % 1000 == 3:
        time.sleep(3600)
    if int(number) % 1000 == 7:
        os._exit(9)
    return len(text), len(text.split())


@query("""SELECT doc_id, CASE WHEN doc_id % 1000 NOT IN (3, 7) THEN octet_length(encode(text)) END AS size,
  CASE WHEN doc_id % 1000 NOT IN (3, 7) THEN len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda x: x <> '')) END AS words,
  CASE doc_id % 1000 WHEN 3 THEN 'timed out after 3s' WHEN 7 THEN 'process ended with status 9' END AS error FROM documents""")
def deadline_per_document(spark, d):
    """Texts measured in supervised processes: every thousandth hangs and gets a timeout, another one crashes, the others get their results."""
    body = F.concat_ws(" ", F.col("doc_id").cast("string"), "text").cast("binary")
    rows = _table(spark, d, "documents").select("doc_id", body.alias("body"))
    return with_deadline(rows, _measured, "body", "size long, words long", deadline_s=3)


# ---- clustered tables and bounded state -------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN doc_id % 100 = 0 THEN -1 ELSE n_chars END AS n_chars, CASE WHEN doc_id % 100 = 1 THEN 'x' ELSE lang END AS lang FROM documents WHERE doc_id % 100 <> 2
  UNION ALL SELECT -1 - doc_id, n_chars, 'new' FROM documents WHERE doc_id % 100 = 3""")
def clustered_changes(spark, d):
    """A clustered table after an upsert, an update, a deletion and an insertion, each of a hundredth of the keys."""
    docs = _table(spark, d, "documents").select("doc_id", "n_chars", "lang")
    table = ClusteredTable.create(docs, f"{_folder(spark, 'clustered')}/t", "doc_id", shards=16)
    part = lambda k: docs.where(F.col("doc_id") % 100 == k)
    table.merge(part(0).withColumn("n_chars", F.lit(-1).cast("long")), lambda old, new: mutations.upsert(old, new, "doc_id"))
    table.merge(part(1).withColumn("lang", F.lit("x")), lambda old, new: mutations.update(old, new, "doc_id"))
    table.merge(part(2).select("doc_id"), lambda old, new: mutations.delete(old, new, "doc_id"))
    fresh = part(3).select((-1 - F.col("doc_id")).alias("doc_id"), "n_chars", F.lit("new").alias("lang"))
    table.merge(fresh.union(part(4)), lambda old, new: mutations.insert_ignore(old, new, "doc_id"))
    return table.read()


@query("SELECT DISTINCT event_id, user_id FROM events")
def stream_seen_bounded(spark, d):
    """Events that are delivered twice, in two runs, by a stream that forgets keys after forty days; into a clustered table."""
    out = _folder(spark, "seen")
    events = _table(spark, d, "events").select("event_id", "user_id", "ts")
    cut = events.agg(F.max("ts") - F.expr("INTERVAL 20 DAYS")).first()[0]
    for late in (False, True):
        # The second run brings the later events and all the earlier ones again.
        (events if late else events.where(F.col("ts") < F.lit(cut))).write.mode("append").json(f"{out}/in")
        stream = spark.readStream.schema("event_id long, user_id long, ts timestamp").option("maxFilesPerTrigger", 8).json(f"{out}/in")
        with rocksdb_state(spark):
            run_available(once_within(stream, "event_id", "ts", "40 days"), clustered_sink(f"{out}/table", "event_id", 8), f"{out}/checkpoint")
    return ClusteredTable(spark, f"{out}/table").read().select("event_id", "user_id")


# ---- trained models ---------------------------------------------------------------------------------------------


@query("""SELECT count(*) AS documents, count(*) FILTER (length(text) < 50) AS short, true AS reached FROM documents WHERE lang IS NOT NULL AND doc_id % 5 = 0""")
def trained_language_detection(spark, d):
    """Whether nine tenths of a fifth of the documents get their language from trigrams of the others; short ones are unknown."""
    docs = _table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("language")).where("language IS NOT NULL")
    model = language_model.train(docs.where("id % 5 <> 0"))
    held = docs.where("id % 5 = 0")
    told = model.detect(held).withColumnRenamed("language", "told").join(held, "id")
    right = F.avg(F.when(F.length("text") >= 50, (F.col("told") == F.col("language")).cast("int")))
    short = F.count(F.when((F.length("text") < 50) & (F.col("told") == "unknown"), 1))
    return told.agg(F.count(F.lit(1)).alias("documents"), short.alias("short"), (right >= 0.9).alias("reached"))


@query("SELECT count(*) AS held_out, true AS kept_best FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE quality IS NOT NULL AND text <> '' AND l.doc_id % 5 = 0")
def early_stopping(spark, d):
    """A classifier of quality whose rounds are chosen by macro F1 on a validation part; whether the model that is kept is the best one tried."""
    labels = _table(spark, d, "labels").where("quality IS NOT NULL").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"))
    rows = labels.join(_table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    names = learning.label_map(spark, ("bad", "good"))
    rows = store.written(learning.training_rows(rows, names, "label"))
    train, valid = rows.where("doc_id % 5 <> 0"), rows.where("doc_id % 5 = 0")
    weights = learning.class_weights(train, names, "label")
    model, history = learning.train_early_stopping(train, valid, weights, "label", 1 << 12, rounds=(1, 4, 16))
    told = learning.scores(model.transform(valid), "index").first()["macro_f1"]
    best = max(f1 for _, f1 in history)
    return valid.agg(F.count(F.lit(1)).alias("held_out"), F.lit(abs(told - best) < 1e-9).alias("kept_best"))
