"""Registered queries over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions import vectors as V
from textmill.operators import ingest, learning, mutations, sampling, search, stats
from textmill.operators import predicates as P
from textmill.plans.corpus import corrections, documents, oracle
from textmill.schemas import LANGUAGE_NAMES, TOPIC_LABELS, TOPICS, TYPE_LABELS, TYPES

BASE_URL = "https://corpus.example.org/documents/"
CONFIDENCE = "classification_confidence"

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function as a query, with its SQL."""

    def register(f):
        key = name or f.__name__
        _queries[key] = f
        if sql:
            _sql[key] = sql
        return f

    return register


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _labels_sql(column: str, labels: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {column} {cases} ELSE {column} END"


PCT = "round(100.0 * n / sum(n) OVER (), 1)"

# ---- aggregates -------------------------------------------------------------------------------------------------


@query(oracle("""SELECT count(*) AS total, count(DISTINCT language) AS languages, round(avg(classification_confidence), 2) AS avg_confidence,
  count(document_type) AS classified FROM corpus WHERE status = 'uploaded'"""))
def hero_stats(spark, d):
    return stats.hero(documents(spark, d))


@query(oracle("SELECT document_type AS type, count(*) AS n FROM corpus WHERE document_type IS NOT NULL GROUP BY 1"))
def type_counts(spark, d):
    return stats.counts_by(documents(spark, d), "document_type", "type")


@query(oracle("SELECT document_topic AS topic, count(*) AS n FROM corpus WHERE document_topic IS NOT NULL GROUP BY 1"))
def topic_counts(spark, d):
    return stats.counts_by(documents(spark, d), "document_topic", "topic")


@query(oracle("SELECT status, count(*) AS n FROM corpus GROUP BY 1"))
def status_counts(spark, d):
    return stats.counts_by(documents(spark, d), "status", "status")


@query(oracle("SELECT classification_model AS model, count(*) AS n FROM corpus GROUP BY 1"))
def model_counts(spark, d):
    return stats.counts_by(documents(spark, d), "classification_model", "model", known=False)


@query(oracle("SELECT coalesce(language, 'unknown') AS language, count(*) AS n FROM corpus GROUP BY 1 ORDER BY n DESC, language LIMIT 20"))
def language_rollup_top20(spark, d):
    return stats.languages(documents(spark, d))


@query(oracle("""SELECT language, count(*) AS n FROM corpus WHERE document_type IS NOT NULL AND language IS NOT NULL
  GROUP BY 1 ORDER BY n DESC, language LIMIT 20"""))
def classified_languages_top20(spark, d):
    return stats.counts_by(documents(spark, d).where(P.classified()), "language", "language").limit(20)


@query(oracle(f"SELECT type, n, {PCT} AS percentage FROM (SELECT document_type AS type, count(*) AS n FROM corpus WHERE document_type IS NOT NULL GROUP BY 1)"))
def facet_share_types(spark, d):
    return stats.with_share(type_counts(spark, d))


@query(oracle("""SELECT topic, n, round(100.0 * n / (SELECT count(*) FROM corpus WHERE document_type IS NOT NULL), 1) AS percentage
  FROM (SELECT document_topic AS topic, count(*) AS n FROM corpus WHERE document_topic IS NOT NULL GROUP BY 1)"""))
def topic_share_of_types(spark, d):
    return stats.shares_of(topic_counts(spark, d), type_counts(spark, d))


FACETS = {"type": "legal", "topic": "", "lang": "en", "min_confidence": "0.3"}


@query(oracle("""SELECT * FROM (
  SELECT 'type' AS facet, document_type AS value, count(*) AS n FROM corpus
    WHERE document_type IS NOT NULL AND language = 'en' AND classification_confidence >= 0.3 GROUP BY 2
  UNION ALL SELECT 'topic', document_topic, count(*) FROM corpus
    WHERE document_type = 'legal' AND language = 'en' AND classification_confidence >= 0.3 GROUP BY 2
  UNION ALL (SELECT 'lang', coalesce(language, 'unknown'), count(*) AS n FROM corpus
    WHERE document_type = 'legal' AND classification_confidence >= 0.3 GROUP BY 2 ORDER BY n DESC, 2 LIMIT 20))"""))
def facets_single_pass(spark, d):
    return stats.facets(documents(spark, d), **FACETS)


@query(oracle(f"""SELECT language, n, {PCT} AS percentage, (SELECT count(DISTINCT language) FROM corpus WHERE document_type = 'forms') AS languages
  FROM (SELECT language, count(*) AS n FROM corpus WHERE document_type = 'forms' AND language IS NOT NULL GROUP BY 1 ORDER BY n DESC, language LIMIT 3)"""))
def facet_languages_top_share(spark, d):
    return stats.facet_languages(documents(spark, d), "document_type", "forms", 3)


@query(oracle("SELECT count(*) AS classified, count(DISTINCT language) AS languages FROM corpus WHERE document_type IS NOT NULL"))
def corpus_stats(spark, d):
    return stats.corpus_stats(documents(spark, d))


@query(oracle("SELECT document_topic AS topic, count(*) AS n FROM corpus WHERE document_type = 'legal' AND document_topic IS NOT NULL GROUP BY 1"))
def topics_within_type(spark, d):
    return stats.within(documents(spark, d), "document_type", "legal", "document_topic", "topic")


@query(oracle("SELECT document_type AS type, count(*) AS n FROM corpus WHERE document_topic = 'finance' AND document_type IS NOT NULL GROUP BY 1"))
def types_within_topic(spark, d):
    return stats.within(documents(spark, d), "document_topic", "finance", "document_type", "type")


_BUCKETS = "CASE " + " ".join(f"WHEN classification_confidence >= {b} THEN '{n}'" for b, n in T.HISTOGRAM) + f" ELSE '{T.BELOW}' END"
_PLACES = "CASE range " + " ".join(f"WHEN '{n}' THEN {i}" for i, (_, n) in enumerate(T.HISTOGRAM)) + f" ELSE {len(T.HISTOGRAM)} END"


@query(oracle(f"""SELECT range, n, {PCT} AS percentage, {_PLACES} AS position FROM (SELECT {_BUCKETS} AS range, count(*) AS n FROM corpus
  WHERE document_type IS NOT NULL AND classification_confidence IS NOT NULL GROUP BY 1)"""))
def confidence_histogram(spark, d):
    return stats.histogram(documents(spark, d))


_BAND = "CASE WHEN classification_confidence >= 0.8 THEN 'high' WHEN classification_confidence >= 0.5 THEN 'medium' WHEN classification_confidence < 0.5 THEN 'low' ELSE 'unknown' END"


@query(oracle(f"SELECT {_BAND} AS band, count(*) AS n FROM corpus WHERE document_type IS NOT NULL GROUP BY 1"))
def confidence_bands(spark, d):
    return stats.confidence_bands(documents(spark, d))


_STAGES = """count(*) FILTER (extracted_at IS NOT NULL AND extraction_error IS NULL) AS extracted,
  count(*) FILTER (status = 'uploaded' AND extracted_at IS NULL) AS extract_pending,
  count(*) FILTER (extraction_error IS NOT NULL) AS extract_errors,
  count(*) FILTER (embedded_at IS NOT NULL AND embedding_model NOT LIKE 'skipped:%') AS embedded,
  count(*) FILTER (embedding_model LIKE 'skipped:%') AS embed_skipped,
  count(*) FILTER (extracted_at IS NOT NULL AND extraction_error IS NULL AND embedded_at IS NULL) AS embed_pending,
  count(*) FILTER (classified_at IS NOT NULL) AS clustered,
  count(*) FILTER (embedded_at IS NOT NULL AND classified_at IS NULL) AS cluster_pending,
  count(DISTINCT cluster_id) AS clusters, count(document_type) AS labelled,
  count(*) FILTER (extracted_at IS NOT NULL AND extraction_error IS NULL AND document_type IS NULL) AS label_pending,
  count(*) FILTER (extracted_at IS NOT NULL AND extraction_error IS NULL AND word_count > 0 AND classification_model IS NULL) AS label_selectable"""


@query(oracle(f"SELECT {_STAGES} FROM corpus"))
def stage_stats(spark, d):
    return stats.stage_stats(documents(spark, d))


@query(oracle("""SELECT *, classifiable - classified AS remaining FROM (SELECT
  count(CASE WHEN extracted_at IS NOT NULL AND extraction_error IS NULL AND word_count > 0 THEN 1 END) AS classifiable,
  count(CASE WHEN extracted_at IS NOT NULL AND extraction_error IS NULL AND word_count > 0 AND classification_model IS NOT NULL THEN 1 END) AS classified FROM corpus)"""))
def label_progress(spark, d):
    return stats.label_progress(documents(spark, d))


@query(oracle(f"""SELECT 'status' AS part, status AS name, count(*) AS n FROM corpus GROUP BY 2 UNION ALL SELECT 'status', 'total', count(*) FROM corpus
  UNION ALL SELECT 'stage', name, n FROM (UNPIVOT (SELECT {_STAGES} FROM corpus) ON COLUMNS(*) INTO NAME name VALUE n)"""))
def status_report(spark, d):
    return stats.status_report(documents(spark, d))


@query(oracle("""SELECT language, count(*) AS n FROM corpus WHERE extracted_at IS NOT NULL AND extraction_error IS NULL AND word_count > 0
  AND language IN ('en', 'de', 'es') GROUP BY 1"""))
def sampling_counts(spark, d):
    return stats.sampling_counts(documents(spark, d), ["en", "de", "es"])


@query(oracle("""SELECT language, count(*) AS n, cast(round(avg(word_count)) as int) AS avg_words FROM corpus
  WHERE extracted_at IS NOT NULL AND extraction_error IS NULL AND language IS NOT NULL GROUP BY 1"""))
def language_words(spark, d):
    return stats.language_words(documents(spark, d))


def _label_rows(spark, d):
    rows = documents(spark, d)
    return rows.select(
        "document_type", "document_topic", "language", F.col(CONFIDENCE).alias("confidence"),
        F.when(F.col("doc_id") % 59 == 0, "Failed to parse LLM response").otherwise("ok").alias("reasoning"),
    ).where("document_type IS NOT NULL")


_LABELS = """labels_ AS (SELECT document_type, document_topic, classification_confidence AS confidence,
  CASE WHEN doc_id % 59 = 0 THEN 'Failed to parse LLM response' ELSE 'ok' END AS reasoning FROM corpus WHERE document_type IS NOT NULL)"""


@query(oracle("").rstrip() + f", {_LABELS} " + """SELECT count(*) AS total, round(avg(coalesce(confidence, 0)), 4) AS avg_confidence,
  count(*) FILTER (coalesce(confidence, 0) < 0.5) AS low, count(*) FILTER (coalesce(confidence, 0) >= 0.5 AND coalesce(confidence, 0) < 0.8) AS medium,
  count(*) FILTER (coalesce(confidence, 0) >= 0.8) AS high, count(*) FILTER (coalesce(confidence, 0) < 0.6) AS below_0_6,
  count(*) FILTER (reasoning = 'Failed to parse LLM response') AS parse_failures FROM labels_""")
def evaluate_labels(spark, d):
    return stats.label_quality(_label_rows(spark, d))


@query(oracle("").rstrip() + f", {_LABELS} " + """SELECT document_type, document_topic, count(*) AS n FROM labels_ GROUP BY 1, 2
  ORDER BY n DESC, document_type, document_topic LIMIT 10""")
def evaluate_labels_crosstab_top10(spark, d):
    return stats.combinations(_label_rows(spark, d))


@query(oracle("SELECT document_type AS value, count(*) AS n, round(avg(classification_confidence), 3) AS avg_confidence FROM corpus WHERE document_type IS NOT NULL GROUP BY 1"))
def type_confidence(spark, d):
    return stats.counts_and_confidence(documents(spark, d), "document_type", CONFIDENCE)


@query(oracle(f"""SELECT part, value, n, avg_confidence, round(100.0 * n / (SELECT count(*) FROM corpus WHERE document_type IS NOT NULL), 1) AS percentage FROM (
  SELECT 'type' AS part, document_type AS value, count(*) AS n, round(avg(classification_confidence), 3) AS avg_confidence FROM corpus WHERE document_type IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'topic', document_topic, count(*), round(avg(classification_confidence), 3) FROM corpus WHERE document_type IS NOT NULL GROUP BY 2
  UNION ALL (SELECT 'language', coalesce(language, 'unknown'), count(*) AS n, round(avg(classification_confidence), 3) FROM corpus WHERE document_type IS NOT NULL GROUP BY 2 ORDER BY n DESC, 2 LIMIT 20)
  UNION ALL SELECT 'band', {_BAND}, count(*), round(avg(classification_confidence), 3) FROM corpus WHERE document_type IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'model', coalesce(classification_model, 'unknown'), count(*), round(avg(classification_confidence), 3) FROM corpus WHERE document_type IS NOT NULL GROUP BY 2)"""))
def evaluate_corpus(spark, d):
    return stats.corpus_evaluation(documents(spark, d))


@query(oracle("SELECT count(*) AS clusters, coalesce(max(n), 0) AS largest FROM (SELECT corrected_id, count(*) AS n FROM corrections WHERE corrected_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"))
def dup_clusters(spark, d):
    return stats.duplicate_clusters(corrections(spark, d))


@query(oracle("SELECT status, count(*) AS n FROM corrections GROUP BY 1"))
def outcome_counts(spark, d):
    return stats.counts_by(corrections(spark, d), "status", "status")


@query(oracle("SELECT language, min(word_count) AS low, list_sort(list(word_count))[count(*) // 2 + 1] AS upper_median, max(word_count) AS high FROM corpus GROUP BY 1"))
def upper_median_by_language(spark, d):
    return stats.word_spread(documents(spark, d), "language")


@query(oracle("""SELECT sum(classified)::bigint AS classified, sum(errors)::bigint AS errors, max(elapsed) AS elapsed, sum(classified) / max(elapsed) AS per_second FROM (
  SELECT crawl_id, count(*) FILTER (status = 'uploaded') AS classified, count(*) FILTER (status <> 'uploaded') AS errors, max(word_count) AS elapsed FROM corpus GROUP BY 1)"""))
def worker_throughput(spark, d):
    workers = documents(spark, d).groupBy("crawl_id").agg(
        F.count_if(F.col("status") == "uploaded").alias("classified"),
        F.count_if(F.col("status") != "uploaded").alias("errors"),
        F.max("word_count").alias("elapsed"),
    )
    return stats.throughput(workers)


# ---- pages, queues, filters -------------------------------------------------------------------------------------


@query(oracle(f"""SELECT doc_id, original_filename AS filename, document_type AS type, document_topic AS topic, language, word_count, classification_confidence AS confidence,
  {_labels_sql('document_type', TYPE_LABELS)} AS type_label, {_labels_sql('document_topic', TOPIC_LABELS)} AS topic_label, {_labels_sql('language', LANGUAGE_NAMES)} AS language_name
  FROM corpus WHERE document_type IS NOT NULL AND language = 'en' ORDER BY classification_confidence DESC NULLS LAST, doc_id LIMIT 25 OFFSET 25"""))
def search_page(spark, d):
    rows = search.page(documents(spark, d), page=2, limit=25, order_id="doc_id", lang="en")
    named = rows.select(
        "doc_id", F.col("original_filename").alias("filename"), F.col("document_type").alias("type"), F.col("document_topic").alias("topic"),
        "language", "word_count", F.col(CONFIDENCE).alias("confidence"),
    )
    return search.with_labels(named)


@query(oracle("SELECT count(*) AS total, cast(ceil(count(*) / 25.0) as bigint) AS pages FROM corpus WHERE document_type = 'reports' AND classification_confidence >= 0.5"))
def search_total(spark, d):
    return search.total(documents(spark, d), type="reports", min_confidence="0.5")


@query(oracle("SELECT doc_id, classification_confidence FROM corpus WHERE document_topic = 'healthcare' ORDER BY classification_confidence DESC NULLS LAST, id, doc_id LIMIT 5"))
def facet_samples_top5(spark, d):
    rows = documents(spark, d).where(F.col("document_topic") == "healthcare")
    return rows.orderBy(F.desc_nulls_last(CONFIDENCE), "id", "doc_id").limit(5).select("doc_id", CONFIDENCE)


@query(oracle("""SELECT doc_id, uploaded_day FROM corpus WHERE status = 'uploaded' AND extracted_at IS NULL AND extraction_error IS NULL
  ORDER BY uploaded_day NULLS LAST, doc_id LIMIT 50"""))
def work_queue_fifo(spark, d):
    rows = documents(spark, d).withColumn("id", F.col("doc_id"))
    return search.work_queue(rows, P.extract_selectable(), "uploaded_day", 50).select("doc_id", "uploaded_day")


@query(oracle("SELECT doc_id, extracted_at FROM corpus WHERE extracted_at IS NOT NULL AND extraction_error IS NULL ORDER BY extracted_at DESC, doc_id LIMIT 50"))
def latest_extracted(spark, d):
    rows = documents(spark, d).withColumn("id", F.col("doc_id"))
    return search.latest(rows, P.extracted(), "extracted_at", 50).select("doc_id", "extracted_at")


@query(oracle("SELECT doc_id, status FROM corpus WHERE status IN ('failed', 'duplicate') ORDER BY doc_id LIMIT 100"))
def documents_by_status(spark, d):
    rows = documents(spark, d).withColumn("id", F.col("doc_id"))
    return search.listing(rows, 100, "failed", "duplicate").select("doc_id", "status")


@query(oracle("SELECT doc_id FROM corpus ORDER BY md5(concat(cast(doc_id as varchar), ':42')), doc_id LIMIT 100"))
def random_sample(spark, d):
    return documents(spark, d).orderBy(sampling.random_key("doc_id"), "doc_id").limit(100).select("doc_id")


@query(oracle("""SELECT language, n FROM (SELECT CASE WHEN k <= 2 THEN language ELSE 'other' END AS language, sum(c)::bigint AS n FROM (
  SELECT language, c, row_number() OVER (ORDER BY c DESC, language) AS k FROM (SELECT coalesce(language, 'unknown') AS language, count(*) AS c FROM corpus GROUP BY 1)) GROUP BY 1)"""))
def top_languages_and_rest(spark, d):
    return search.top_and_rest(stats.languages(documents(spark, d), None), "language", 2)


@query(oracle(f"SELECT concat('{BASE_URL}', id, '.docx') AS url FROM corpus WHERE document_type = 'policies' AND language = 'en' ORDER BY id LIMIT 2000000"))
def manifest_urls(spark, d):
    return search.manifest_urls(documents(spark, d), BASE_URL, type="policies", lang="en")


@query(oracle("SELECT id FROM corpus WHERE status = 'uploaded'"))
def manifest_ids(spark, d):
    return search.manifest_ids(documents(spark, d))


@query(oracle(f"""SELECT id, coalesce(nullif(original_filename, ''), 'unknown.docx') AS filename, document_type AS type, document_topic AS topic, language, word_count,
  cast(classification_confidence as float) AS confidence, concat('{BASE_URL}', id, '.docx') AS url FROM corpus WHERE document_type IS NOT NULL"""))
def export_rows(spark, d):
    return search.export_rows(documents(spark, d), BASE_URL)


@query(oracle("SELECT doc_id, id FROM corpus WHERE id >= '4' AND id < '8'"))
def id_range_shard(spark, d):
    return documents(spark, d).where(P.id_range("4", "8")).select("doc_id", "id")


@query(oracle("SELECT doc_id, word_count FROM corpus WHERE extracted_at IS NOT NULL AND extraction_error IS NULL AND word_count > 0 AND classification_model IS NULL"))
def label_work(spark, d):
    return documents(spark, d).where(P.label_selectable()).select("doc_id", "word_count")


@query(oracle("SELECT DISTINCT source_url FROM corpus WHERE crawl_id = 'CRAWL-2025-02'"))
def crawl_urls(spark, d):
    return P.urls(documents(spark, d), crawl_id="CRAWL-2025-02")


@query(oracle("SELECT DISTINCT source_url FROM corpus WHERE status IN ('failed', 'duplicate')"))
def status_urls(spark, d):
    return P.urls(documents(spark, d), "failed", "duplicate")


@query(oracle("SELECT doc_id, source_url FROM corpus WHERE source_url = (SELECT source_url FROM corpus WHERE doc_id = 7) ORDER BY id LIMIT 1"))
def document_by_url(spark, d):
    rows = documents(spark, d)
    url = rows.where("doc_id = 7").select(F.col("source_url").alias("wanted"))
    return rows.join(F.broadcast(url), F.col("source_url") == F.col("wanted")).orderBy("id").limit(1).select("doc_id", "source_url")


# ---- joins ------------------------------------------------------------------------------------------------------


def _by_number(spark, d):
    return documents(spark, d).withColumn("id", F.col("doc_id").cast("string"))


@query(oracle("""SELECT cast(d.doc_id as varchar) AS id FROM corpus d LEFT JOIN corrections c ON c.raw_id = cast(d.doc_id as varchar)
  WHERE d.status = 'uploaded' AND c.raw_id IS NULL"""))
def uncorrected_docs_anti(spark, d):
    return ingest.uncorrected(_by_number(spark, d), corrections(spark, d)).select("id")


@query(oracle("""SELECT cast(d.doc_id as varchar) AS id FROM corpus d LEFT JOIN corrections c ON c.raw_id = cast(d.doc_id as varchar)
  WHERE d.status = 'uploaded' AND (c.raw_id IS NULL OR c.status = 'error')"""))
def retry_error_docs(spark, d):
    return ingest.to_inspect_again(_by_number(spark, d), corrections(spark, d)).select("id")


def _records(spark, d):
    """Index records: every document's URL, and a new URL for each of these."""
    rows = documents(spark, d).select("source_url")
    return rows.select(F.col("source_url").alias("url")).union(rows.select(F.concat("source_url", F.lit("&new")).alias("url")))


_RECORDS = "records AS (SELECT source_url AS url FROM corpus UNION ALL SELECT concat(source_url, '&new') FROM corpus)"


@query(oracle("").rstrip() + f", {_RECORDS} SELECT DISTINCT url FROM records WHERE md5(url) NOT IN (SELECT md5(source_url) FROM corpus)")
def unseen_records(spark, d):
    return ingest.unseen(_records(spark, d), documents(spark, d))


@query(oracle("").rstrip() + f", {_RECORDS} SELECT DISTINCT url FROM records WHERE md5(url) NOT IN (SELECT md5(source_url) FROM corpus WHERE status IN ('uploaded', 'duplicate'))")
def unseen_records_retry_failed(spark, d):
    return ingest.unseen(_records(spark, d), documents(spark, d), retry_failed=True)


@query(oracle("").rstrip() + f""", {_RECORDS} SELECT DISTINCT concat('dup-', sha256(concat(url, 'CRAWL-2025-02'))) AS id, url AS source_url, 'duplicate' AS status, 'cross-crawl duplicate' AS error_message
  FROM records WHERE url IN (SELECT source_url FROM corpus) AND url NOT IN (SELECT source_url FROM corpus WHERE crawl_id = 'CRAWL-2025-02')""")
def cross_crawl_duplicates(spark, d):
    rows = ingest.cross_crawl_duplicates(_records(spark, d), documents(spark, d), "CRAWL-2025-02", F.lit(0))
    return rows.select("id", "source_url", "status", "error_message")


@query(oracle("SELECT doc_id, id, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS holder_rank FROM corpus"))
def content_dedup_first_wins(spark, d):
    return ingest.first_holders(documents(spark, d).select("doc_id", "id"), "id", ["doc_id"])


@query(oracle("SELECT doc_id, concat('dup-', sha256(concat(source_url, crawl_id))) AS dup_id, concat('failed-', sha256(source_url)) AS failed_id, md5(source_url) AS url_key FROM corpus"))
def identity_keys(spark, d):
    return documents(spark, d).select(
        "doc_id", T.duplicate_id("source_url", "crawl_id").alias("dup_id"), T.failed_id("source_url").alias("failed_id"),
        T.url_key("source_url").alias("url_key"),
    )


@query("""SELECT DISTINCT c AS id, p AS position FROM (VALUES ('c3', 0), ('c2', 1), ('c1', 2)) t(c, p)
  WHERE c NOT IN (SELECT concat('c', cast(source[4:] as int) % 2 + 1) FROM documents WHERE source IN ('src1', 'src3'))""")
def missing_crawls(spark, d):
    catalog = spark.createDataFrame([("c3", 0), ("c2", 1), ("c1", 2)], "id string, position int")
    seen = _table(spark, d, "documents").where(F.col("source").isin("src1", "src3"))
    filtered = seen.select(F.concat(F.lit("c"), F.substring("source", 4, 9).cast("int") % 2 + 1).alias("id"))
    return ingest.missing_crawls(catalog, filtered)


@query(oracle("""SELECT d.doc_id, l.quality, left(d.text, 2000) AS text FROM corpus d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text <> ''"""))
def text_attach(spark, d):
    labels = _table(spark, d, "labels").select("doc_id", "quality")
    return learning.with_text(labels, documents(spark, d).select("doc_id", "text"), "doc_id")


@query(oracle("SELECT 'c' || cast(k as varchar) AS id, 'general' AS label FROM (SELECT 0 AS k) UNION ALL SELECT raw_id, status FROM corrections WHERE raw_id <> 'c0'"))
def merge_labels(spark, d):
    old = corrections(spark, d).select(F.col("raw_id").alias("id"), F.col("status").alias("label"))
    return mutations.merge_dictionaries(old, spark.createDataFrame([("c0", "general")], "id string, label string"), "id")


@query(f"SELECT t AS id FROM (SELECT unnest([{', '.join(repr(t) for t in TYPES)}]) AS t) WHERE t NOT IN (SELECT CASE WHEN quality = 1 THEN 'legal' ELSE 'forms' END FROM labels)")
def unused_taxonomy_ids(spark, d):
    ids = learning.label_map(spark, TYPES).select(F.col("label").alias("id"))
    used = _table(spark, d, "labels").select(F.when(F.col("quality") == 1, "legal").otherwise("forms").alias("type"))
    return stats.unused(ids, used, "type")


# ---- sampling ---------------------------------------------------------------------------------------------------

_POOL = "extracted_at IS NOT NULL AND extraction_error IS NULL AND word_count > 0"


@query(oracle(f"""SELECT doc_id, CASE WHEN r < n // 3 THEN 0 WHEN r < 2 * (n // 3) THEN 1 ELSE 2 END AS tercile FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY language ORDER BY word_count, doc_id) - 1 AS r, count(*) OVER (PARTITION BY language) AS n FROM corpus)"""))
def terciles(spark, d):
    return sampling.terciles(documents(spark, d), "language", id_col="doc_id").select("doc_id", "tercile")


@query(oracle("""SELECT doc_id, language FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY turn, md5(concat(domain, ':42')), domain) AS place FROM (
  SELECT doc_id, language, regexp_extract(source_url, '^[a-z]+://([^/?#]+)', 1) AS domain,
    row_number() OVER (PARTITION BY language, regexp_extract(source_url, '^[a-z]+://([^/?#]+)', 1) ORDER BY md5(concat(cast(doc_id as varchar), ':42')), doc_id) AS turn
  FROM corpus)) WHERE place <= 12"""))
def round_robin_sample(spark, d):
    rows = documents(spark, d).withColumn("domain", T.domain("source_url"))
    return sampling.round_robin(rows, ["language"], "domain", F.lit(12), "doc_id").select("doc_id", "language")


@query(oracle(f"""SELECT language, n, CASE WHEN k = 1 THEN greatest(1, a + 500 - sum(a) OVER ()) ELSE a END::bigint AS allocated FROM (
  SELECT *, row_number() OVER (ORDER BY a DESC, n DESC, language) AS k FROM (
    SELECT language, n, greatest(least(50, 500 // count(*) OVER ()), cast(round_even(500.0 * n / sum(n) OVER (), 0) as bigint)) AS a FROM (
      SELECT language, count(*) AS n FROM corpus WHERE {_POOL} AND language IN ('en', 'de', 'fr', 'es') GROUP BY 1)))"""))
def language_allocation(spark, d):
    return sampling.allocation(stats.sampling_counts(documents(spark, d), ["en", "de", "fr", "es"]), 500)


@query(oracle(f"""SELECT doc_id, language, tercile, domain FROM (SELECT *, row_number() OVER (PARTITION BY language, tercile ORDER BY turn, md5(concat(domain, ':42')), domain) AS place FROM (
  SELECT *, CASE WHEN n <= allocated THEN n ELSE allocated // 3 + CASE WHEN tercile < allocated - 3 * (allocated // 3) THEN 1 ELSE 0 END END AS quota,
    row_number() OVER (PARTITION BY language, tercile, domain ORDER BY md5(concat(doc_id, ':42')), doc_id) AS turn FROM (
  SELECT *, CASE WHEN r < n // 3 THEN 0 WHEN r < 2 * (n // 3) THEN 1 ELSE 2 END AS tercile FROM (
  SELECT *, row_number() OVER (PARTITION BY language ORDER BY word_count, doc_id) - 1 AS r, count(*) OVER (PARTITION BY language) AS n, regexp_extract(source_url, '^[a-z]+://([^/?#]+)', 1) AS domain FROM (
  SELECT k.*, a.allocated, row_number() OVER (PARTITION BY k.language ORDER BY md5(concat(k.doc_id, ':42')), k.doc_id) AS drawn FROM corpus k JOIN (
  SELECT language, CASE WHEN k = 1 THEN greatest(1, a + 200 - sum(a) OVER ()) ELSE a END::bigint AS allocated FROM (
  SELECT *, row_number() OVER (ORDER BY a DESC, n DESC, language) AS k FROM (
  SELECT language, n, greatest(least(50, 200 // count(*) OVER ()), cast(round_even(200.0 * n / sum(n) OVER (), 0) as bigint)) AS a FROM (
  SELECT language, count(*) AS n FROM corpus WHERE {_POOL} AND language IN ('en', 'de', 'fr', 'es') GROUP BY 1)))) a ON a.language = k.language WHERE {_POOL})
  WHERE drawn <= least(10 * allocated, 100000)))))  WHERE place <= quota"""))
def stratified_sample(spark, d):
    rows = documents(spark, d).withColumn("id", F.col("doc_id"))
    allocated = sampling.allocation(stats.sampling_counts(rows, ["en", "de", "fr", "es"]), 200)
    return sampling.stratified(rows, allocated).select("doc_id", "language", "tercile", "domain")


@query(oracle("""SELECT doc_id, r <= round(0.15 * n) AS is_validation FROM (SELECT l.doc_id, row_number() OVER (PARTITION BY quality ORDER BY md5(concat(cast(l.doc_id as varchar), ':42')), l.doc_id) AS r,
  count(*) OVER (PARTITION BY quality) AS n FROM labels l)"""))
def stratified_split(spark, d):
    return sampling.split(_table(spark, d, "labels"), "quality", id_col="doc_id").select("doc_id", "is_validation")


@query(oracle("SELECT doc_id, cast(floor((row_number() OVER (ORDER BY doc_id) - 1) / ceil(count(*) OVER () / 7.0)) as int) AS worker FROM labels"))
def id_chunks(spark, d):
    return sampling.id_chunks(_table(spark, d, "labels"), 7, "doc_id")


# ---- learning ---------------------------------------------------------------------------------------------------


@query(oracle(f"""SELECT label, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER () / (count(*) OVER () * greatest(coalesce(n, 0), 1)) AS weight
  FROM (SELECT unnest([{', '.join(repr(t) for t in TYPES)}]) AS label) LEFT JOIN (
    SELECT document_type, count(*) AS n FROM corpus WHERE document_type <> 'creative' GROUP BY 1) ON label = document_type"""))
def class_weights(spark, d):
    rows = documents(spark, d).where("document_type <> 'creative'")
    return learning.class_weights(rows, learning.label_map(spark, TYPES), "document_type")


def _predictions(spark, d):
    texts = _table(spark, d, "documents").select("doc_id", F.col("text").contains("|").alias("bar"), "n_chars")
    rows = _table(spark, d, "labels").join(texts, "doc_id")
    guess = F.when(F.col("bar"), 0).when(F.col("n_chars") < 200, 2).otherwise(1)
    return rows.select(F.col("quality").alias("label"), guess.alias("prediction"))


_CELLS = """p AS (SELECT quality AS l, CASE WHEN contains(text, '|') THEN 0 WHEN n_chars < 200 THEN 2 ELSE 1 END AS p FROM labels JOIN documents USING (doc_id)),
  c AS (SELECT l AS class FROM p UNION SELECT p FROM p),
  r AS (SELECT class, count(*) FILTER (l = class AND p.p = class) AS tp, count(*) FILTER (l <> class AND p.p = class) AS fp, count(*) FILTER (l = class AND p.p <> class) AS fn
        FROM c, p GROUP BY 1)"""


@query(f"""WITH {_CELLS} SELECT class, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, tp + fn AS support FROM r""")
def class_report(spark, d):
    return learning.class_report(_predictions(spark, d))


@query(f"WITH {_CELLS} SELECT sum(tp) / sum(tp + fn) AS accuracy, avg(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)) AS macro_f1 FROM r")
def macro_f1(spark, d):
    return learning.scores(_predictions(spark, d))


@query("SELECT doc_id AS id, 64 AS size, 1.0::double AS norm FROM documents WHERE text <> ''")
def hash_embeddings(spark, d):
    rows = _table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").where("text <> ''")
    vectors = learning.embed(rows)
    return vectors.select("id", F.size("vector").alias("size"), F.round(V.norm("vector"), 6).alias("norm"))


@query(f"""WITH p AS (SELECT cast(doc_id as varchar) AS id, sha256(concat('Classify.', chr(10), chr(10), '## Document', chr(10), '\"\"\"', chr(10), left(text, 2000), chr(10), '\"\"\"', chr(10))) AS h FROM documents),
  b AS (SELECT id, list_transform([1, 3, 5, 7], lambda i: ('0x' || substr(h, i, 2))::int) AS b FROM p)
  SELECT id, [{', '.join(repr(t) for t in TYPES)}][b[1] % {len(TYPES)} + 1] AS document_type, [{', '.join(repr(t) for t in TOPICS)}][b[2] % {len(TOPICS)} + 1] AS document_topic,
    round(b[3] / 255, 3) AS type_confidence, round(b[4] / 255, 3) AS topic_confidence, least(round(b[3] / 255, 3), round(b[4] / 255, 3)) AS confidence,
    'by hash' AS reasoning, 'stub' AS model FROM b""")
def stub_labels(spark, d):
    prompts = _table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("id"), T.prompt("Classify.", T.prefix("text"), F.lit("")).alias("prompt")
    )
    return learning.label(prompts)


@query()
def train_and_classify(spark, d):
    docs = _table(spark, d, "documents").select("doc_id", F.left("text", F.lit(2000)).alias("text"))
    rows = _table(spark, d, "labels").join(docs, "doc_id").withColumn("label", F.when(F.col("quality") == 1, "good").otherwise("bad"))
    labels = learning.label_map(spark, ("bad", "good"))
    known = learning.training_rows(rows, labels, "label")
    parts = sampling.split(known, "label", id_col="doc_id")
    train = parts.where("not is_validation")
    model = learning.train_classifier(train.select("label", "text", "index"), learning.class_weights(train, labels, "label"), "label", 1 << 12)
    return model.transform(parts.where("is_validation")).select("doc_id", F.col("index").cast("double").alias("label"), "prediction")


# ---- scalar functions -------------------------------------------------------------------------------------------


@query("SELECT page_id, coalesce(nullif(url_decode(regexp_extract(url, '^[a-z]+://[^/?#]*(?:/[^?#]*)?/([^/?#]*)', 1)), ''), 'unknown.docx') AS filename FROM pages")
def filename_from_url(spark, d):
    return _table(spark, d, "pages").select("page_id", T.filename_from_url("url").alias("filename"))


@query(oracle("SELECT doc_id, concat('doc ', doc_id, '.docx') AS filename FROM corpus"))
def corpus_filenames(spark, d):
    return documents(spark, d).select("doc_id", T.filename_from_url("source_url").alias("filename"))


@query("SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS domain, count(*) AS n FROM pages GROUP BY 1")
def domain_counts(spark, d):
    return stats.counts_by(_table(spark, d, "pages").select(T.domain("url").alias("domain")), "domain", "domain")


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS words, length(text) AS chars FROM documents")
def word_char_counts(spark, d):
    return _table(spark, d, "documents").select("doc_id", T.word_count("text").alias("words"), T.char_count("text").alias("chars"))


@query(r"SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS n FROM documents")
def trimmed_length(spark, d):
    return _table(spark, d, "documents").select("doc_id", F.length(T.trim_spaces("text")).alias("n"))


@query("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_field_counts(spark, d):
    k = F.get_json_object("props", "$.k")
    return _table(spark, d, "events").groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


_CHUNKS = r"""t AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text FROM documents),
  s AS (SELECT doc_id, text, unnest(list_filter(range(0, greatest(length(text), 1), 5800), lambda i: i = 0 OR i + 200 < length(text))) AS i FROM t),
  c AS (SELECT doc_id, i, regexp_replace(substr(text, i + 1, 6000), '^\s+|\s+$', '', 'g') AS chunk FROM s)"""


@query(f"WITH {_CHUNKS} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS part, length(chunk) AS weight, md5(chunk) AS chunk_md5 FROM c WHERE chunk <> ''")
def text_chunks(spark, d):
    parts = _table(spark, d, "documents").select("doc_id", F.posexplode(T.chunks("text")).alias("part", "chunk"))
    return parts.select("doc_id", "part", F.length("chunk").alias("weight"), F.md5("chunk").alias("chunk_md5"))


@query(f"WITH {_CHUNKS} SELECT doc_id, count(*) AS chunks, sum(length(chunk))::bigint AS weight FROM c WHERE chunk <> '' GROUP BY 1")
def chunk_weights(spark, d):
    parts = _table(spark, d, "documents").select("doc_id", F.explode(T.chunks("text")).alias("chunk"))
    return parts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.length("chunk")).alias("weight"))


@query(oracle("SELECT doc_id, concat(left(id, 8), '...', right(id, 4)) AS short, CASE WHEN doc_id % 2 = 0 THEN 'a-b-v1' ELSE 'unknown-v0' END AS model FROM corpus"))
def short_ids_and_models(spark, d):
    even = F.col("doc_id") % 2 == 0
    return documents(spark, d).select(
        "doc_id", T.short_id("id").alias("short"), T.model_name(F.when(even, "a/b"), F.when(even, "v1").otherwise("")).alias("model")
    )


@query(oracle(f"""SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'general' WHEN doc_id % 4 = 2 THEN '{TYPES[0]}' ELSE 'forms' END AS document_type,
  CASE WHEN doc_id % 4 = 0 THEN 'finance' ELSE 'general' END AS document_topic, CASE WHEN doc_id % 4 = 3 THEN 0.0 ELSE 0.5 END AS confidence FROM corpus"""))
def parsed_answers(spark, d):
    good = 'Sure: {"document_type": {"id": "%s", "confidence": 0.9}, "topic": {"id": "%s", "confidence": 0.5}, "reasoning": "x"} done'
    text = (
        F.when(F.col("doc_id") % 4 == 0, good % ("forms", "finance"))
        .when(F.col("doc_id") % 4 == 1, good % ("forms", "nothing"))
        .when(F.col("doc_id") % 4 == 2, good % ("general", "general"))
        .otherwise("no JSON {")
    )
    rows = documents(spark, d).select("doc_id", T.parse_answer(text).alias("a"))
    return rows.select("doc_id", "a.document_type", "a.document_topic", "a.confidence")


# ---- vectors ----------------------------------------------------------------------------------------------------


@query("""WITH f AS (SELECT label, vec_id % 5 + 1 AS w, unnest(embedding) AS x, unnest(range(0, len(embedding))) AS p FROM embeddings),
  m AS (SELECT label, p, sum(w * x::double) / sum(w) AS m FROM f GROUP BY 1, 2)
  SELECT label, p AS position, round(m / sqrt(sum(m * m) OVER (PARTITION BY label)), 5) AS x FROM m""")
def weighted_mean_vectors(spark, d):
    rows = _table(spark, d, "embeddings").select(F.col("label").alias("id"), F.col("embedding").alias("vector"), (F.col("vec_id") % 5 + 1).alias("weight"))
    means = V.document_vectors(rows)
    return means.select(F.col("id").alias("label"), F.posexplode("vector").alias("position", "x")).withColumn("x", F.round("x", 5))


@query("""WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0) SELECT vec_id,
  round(list_sum(list_transform(range(1, len(e) + 1), lambda i: e[i]::double * embedding[i]::double)) / sqrt(list_sum(list_transform(e, lambda x: x::double * x::double)))
    / sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))), 3) + 0.0 AS cosine FROM embeddings, q""")
def cosine_neighbors(spark, d):
    rows = _table(spark, d, "embeddings")
    q = rows.where("vec_id = 0").select(F.col("embedding").alias("q"))
    return rows.join(F.broadcast(q)).select("vec_id", (F.round(V.cosine("embedding", "q"), 3) + F.lit(0.0)).alias("cosine"))  # one query row


# ---- mutations --------------------------------------------------------------------------------------------------


def _keyed(spark, d):
    return documents(spark, d).select(F.col("doc_id").alias("id"), "crawl_id", "status", "word_count", "classification_model")


@query(oracle("""SELECT coalesce(o.id, c.id) AS id, CASE WHEN c.id IS NOT NULL THEN 'CRAWL-NEW' ELSE o.crawl_id END AS crawl_id,
  CASE WHEN c.id IS NOT NULL THEN c.status ELSE o.status END AS status, o.word_count, o.classification_model
  FROM (SELECT doc_id AS id, crawl_id, status, word_count, classification_model FROM corpus) o
  FULL JOIN (SELECT doc_id + 3 AS id, CASE WHEN toxic = 0 THEN 'uploaded' END AS status FROM labels) c ON o.id = c.id"""))
def upsert_documents(spark, d):
    changes = _table(spark, d, "labels").select(
        (F.col("doc_id") + 3).alias("id"), F.lit("CRAWL-NEW").alias("crawl_id"), F.when(F.col("toxic") == 0, "uploaded").alias("status")
    )
    return mutations.upsert(_keyed(spark, d), changes)


@query(oracle("""SELECT doc_id AS id, status FROM corpus UNION ALL SELECT DISTINCT doc_id * 2, 'new' FROM labels WHERE doc_id * 2 NOT IN (SELECT doc_id FROM corpus)"""))
def insert_ignore(spark, d):
    new = _table(spark, d, "labels").select((F.col("doc_id") * 2).alias("id"), F.lit("new").alias("status"))
    return mutations.insert_ignore(_keyed(spark, d).select("id", "status"), new)


@query(oracle("SELECT doc_id AS id, crawl_id, status FROM corpus WHERE NOT (crawl_id = 'CRAWL-2025-02' AND doc_id IN (SELECT doc_id FROM labels))"))
def delete_by_crawl(spark, d):
    ids = _table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return mutations.delete(_keyed(spark, d).select("id", "crawl_id", "status"), ids, crawl_id="CRAWL-2025-02")


@query(oracle("SELECT doc_id AS id, CASE classification_model WHEN 'base-v1' THEN 'renamed' ELSE classification_model END AS classification_model FROM corpus"))
def rename_model(spark, d):
    return mutations.rename(_keyed(spark, d), "classification_model", {"base-v1": "renamed"}).select("id", "classification_model")


@query(oracle("SELECT classification_model AS old_name, count(*) AS n FROM corpus WHERE classification_model = 'base-v1' GROUP BY 1"))
def rename_dry_run(spark, d):
    return mutations.rename_counts(_keyed(spark, d), "classification_model", {"base-v1": "renamed"})


@query(oracle("""SELECT raw_id, CASE WHEN cast(raw_id as bigint) % 4 = 0 THEN NULL ELSE corrected_id END AS corrected_id,
  CASE WHEN cast(raw_id as bigint) % 4 = 0 THEN 'skipped' ELSE status END AS status FROM corrections"""))
def upsert_corrections(spark, d):
    old = corrections(spark, d).select("raw_id", "corrected_id", "status", F.lit(None).cast("timestamp").alias("inspected_at"), F.lit(None).cast("timestamp").alias("corrected_at"))
    again = old.where("cast(raw_id as bigint) % 4 = 0").select("raw_id", F.lit(None).cast("string").alias("corrected_id"), F.lit("skipped").alias("status"))
    return mutations.upsert_corrections(old, again, F.current_timestamp()).select("raw_id", "corrected_id", "status")


@query(oracle("""SELECT doc_id AS id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'legal' ELSE document_type END AS document_type,
  CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'fixed' ELSE classification_model END AS classification_model FROM corpus"""))
def set_one_label(spark, d):
    old = documents(spark, d).select(F.col("doc_id").alias("id"), "document_type", "document_topic", F.col(CONFIDENCE).cast("float"), "classification_model")
    ids = _table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return mutations.set_one_label(old, ids, "legal", "general", 0.5, "fixed").select("id", "document_type", "classification_model")


@query(oracle("""SELECT doc_id AS id, CASE WHEN l.id IS NULL THEN embedding_model WHEN toxic = 1 THEN 'skipped:toxic' ELSE 'model-b' END AS embedding_model,
  CASE WHEN l.id IS NULL THEN embedded_at ELSE 7 END AS embedded_at FROM corpus LEFT JOIN (SELECT doc_id AS id, toxic FROM labels) l ON l.id = doc_id"""))
def set_embeddings(spark, d):
    old = documents(spark, d).select(F.col("doc_id").alias("id"), "embedding_model", "embedded_at", F.lit(None).cast("array<float>").alias("embedding"))
    labels = _table(spark, d, "labels").select(F.col("doc_id").alias("id"), "toxic")
    done = labels.where("toxic = 0").select("id", F.array(F.lit(1.0)).alias("vector"))
    new = mutations.set_embeddings(old, done, "model-b", F.lit(7))
    skipped = labels.where("toxic = 1").select("id", F.lit("toxic").alias("reason"))
    return mutations.set_skipped(new, skipped, F.lit(7)).select("id", "embedding_model", "embedded_at")


@query(oracle("""SELECT doc_id AS id, CASE WHEN l.id IS NULL THEN cluster_id ELSE toxic END AS cluster_id, CASE WHEN toxic = 1 THEN 'bad' END AS cluster_label
  FROM corpus LEFT JOIN (SELECT doc_id AS id, toxic FROM labels) l ON l.id = doc_id"""))
def set_clusters(spark, d):
    old = documents(spark, d).select(F.col("doc_id").alias("id"), "cluster_id", F.lit(None).cast("string").alias("cluster_label"), "classified_at")
    clusters = _table(spark, d, "labels").select(
        F.col("doc_id").alias("id"), F.col("toxic").alias("cluster_id"), F.when(F.col("toxic") == 1, "bad").otherwise("").alias("cluster_label")
    )
    return mutations.set_clusters(old, clusters, F.lit(1)).select("id", "cluster_id", "cluster_label")


@query(oracle("""SELECT doc_id AS id, CASE WHEN toxic = 0 THEN 1 ELSE word_count END AS word_count, CASE WHEN toxic = 0 THEN NULL WHEN toxic = 1 THEN 'bad zip' ELSE extraction_error END AS extraction_error,
  CASE WHEN toxic = 0 THEN 9 ELSE extracted_at END AS extracted_at FROM corpus LEFT JOIN (SELECT doc_id AS id, toxic FROM labels) l ON l.id = doc_id"""))
def set_extraction(spark, d):
    none = F.lit(None)
    old = documents(spark, d).select(
        F.col("doc_id").alias("id"), "word_count", "char_count", none.cast("int").alias("table_count"), none.cast("int").alias("image_count"),
        "language", none.cast("float").alias("language_confidence"), "extraction_error", "extracted_at",
    )
    done = _table(spark, d, "labels").select(
        F.col("doc_id").alias("id"), F.lit(1).alias("word_count"), F.lit(2).alias("char_count"), F.lit(0).alias("table_count"), F.lit(0).alias("image_count"),
        F.lit("en").alias("language"), F.lit(0.9).alias("language_confidence"), F.when(F.col("toxic") == 1, "bad zip").alias("error"),
    )
    return mutations.set_extraction(old, done, F.lit(9)).select("id", "word_count", "extraction_error", "extracted_at")


# ---- records and sources ----------------------------------------------------------------------------------------


def _index_lines(spark, d):
    """Index lines of all pages: every third has another media type, every fifth another status, every seventh no JSON."""
    k = F.col("page_id")
    mime = F.when(k % 3 == 0, "text/html").otherwise(ingest.DOCX_MIME)
    json = F.to_json(F.struct("url", mime.alias("mime"), F.when(k % 5 == 0, "404").otherwise("200").alias("status"), F.lit("10").alias("length"), k.cast("string").alias("offset")))
    line = F.when(k % 7 == 0, F.concat(F.lit("key "), mime)).otherwise(F.concat(F.lit("org,example)/ 20250101 "), json))
    return _table(spark, d, "pages").select(line.alias("value"))


@query("SELECT url, '200' AS status, '10' AS length, cast(page_id as varchar) AS \"offset\" FROM pages WHERE page_id % 3 <> 0 AND page_id % 5 <> 0 AND page_id % 7 <> 0")
def index_filter(spark, d):
    kept = ingest.index_records(_index_lines(spark, d))
    names = ("url", "status", "length", "offset")
    return kept.select(*[F.get_json_object("value", f"$.{n}").alias(n) for n in names])


@query("""SELECT source AS id, count(*) AS files, sum(n_chars)::bigint AS total_size FROM documents GROUP BY 1""")
def filtered_crawls(spark, d):
    from textmill.sources.archive import crawls_of

    docs = _table(spark, d, "documents")
    objects = docs.select(F.concat("source", F.lit("/part-"), F.col("doc_id").cast("string"), F.lit(".jsonl")).alias("key"), F.col("n_chars").alias("length"))
    return crawls_of(objects)


@query("""SELECT doc_id, 200 AS http_status, 'text/plain' AS content_type, octet_length(encode(text)) AS content_length, sha256(text) AS content_sha256 FROM documents""")
def warc_parse(spark, d):
    from textmill.functions.records import parse_warc

    body = F.col("text").cast("binary")
    n = F.octet_length("text").cast("string")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/plain\r\nContent-Length: "), n, F.lit("\r\n\r\n"))
    record = F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))
    rows = _table(spark, d, "documents").select("doc_id", parse_warc(record).alias("r"))
    return rows.select("doc_id", "r.http_status", "r.content_type", "r.content_length", F.sha2("r.content", 256).alias("content_sha256"))


@query("""SELECT doc_id, doc_id % 3 = 0 AND octet_length(encode(text)) >= 66 AS is_valid FROM documents""")
def docx_validate(spark, d):
    from textmill.functions.records import validate_docx

    head = F.when(F.col("doc_id") % 3 == 0, F.concat(F.unhex(F.lit("504B0304")), F.lit("[Content_Types].xmlword/document").cast("binary")))
    head = F.when(F.col("doc_id") % 3 == 1, F.lit("NOT_A_ZIP_FILE").cast("binary")).otherwise(F.coalesce(head, F.unhex(F.lit("504B0304"))))
    pad = F.concat(head, F.col("text").cast("binary"))
    sized = F.when(F.octet_length("text") >= 66, pad).otherwise(F.substring(pad, 1, 60))
    return _table(spark, d, "documents").select("doc_id", validate_docx(sized).is_valid.alias("is_valid"))


def _small_zip() -> bytes:
    """A whole document file, the same bytes at every call."""
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name in ("[Content_Types].xml", "word/document.xml"):
            z.writestr(zipfile.ZipInfo(name), "<x>" + name * 3 + "</x>")
    return out.getvalue()


@query(f"""SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'already-clean' WHEN 1 THEN 'trimmed'
    WHEN 2 THEN CASE WHEN text = '' THEN 'already-clean' WHEN octet_length(encode(text)) > 65535 THEN 'skipped-no-eocd' ELSE 'skipped-excess-differs' END
    WHEN 3 THEN 'skipped-non-zip' WHEN 4 THEN 'skipped-no-eocd' WHEN 5 THEN 'skipped-testzip-failed' ELSE 'already-clean' END AS status,
  CASE WHEN doc_id % 7 = 1 THEN '{hashlib.sha256(_small_zip()).hexdigest()}' END AS candidate_sha256 FROM documents""")
def zip_tail_repair(spark, d):
    """Files with every outcome: whole, with the known tail, with the text for a tail, no ZIP, cut off, broken, with a comment."""
    from textmill.functions.records import repaired

    whole, tail, k = _small_zip(), b"\r\n\r\n", F.col("doc_id") % 7
    text = F.col("text").cast("binary")
    content = (
        F.when(k == 0, F.lit(whole))
        .when(k == 1, F.lit(whole + tail))
        .when(k == 2, F.concat(F.lit(whole), text))
        .when(k == 3, F.concat(F.lit(b"no ZIP file: "), text, F.lit(tail)))
        .when(k == 4, F.concat(F.lit(whole[:-30]), text))
        .when(k == 5, F.lit(whole.replace(b"<x>", b"<y>", 1) + tail))
        .otherwise(F.lit(whole[:-2] + len(b"a comment").to_bytes(2, "little") + b"a comment"))
    )
    rows = _table(spark, d, "documents").select("doc_id", repaired(content).alias("r"))
    return rows.select("doc_id", "r.status", F.sha2("r.candidate", 256).alias("candidate_sha256"))


@query("SELECT count(DISTINCT url) AS urls, count(DISTINCT url) AS n FROM pages")
def stream_ingest_dedup(spark, d):
    """Pages as a stream, each URL once; run to its end, then read as a table."""
    import uuid

    from textmill.sources.store import shared_folder
    from textmill.streaming.ingest import appending_sink, once_each, run_available

    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    pages = _table(spark, d, "pages").select("url")
    pages.union(pages).write.json(f"{out}/in")
    stream = spark.readStream.schema("url string").option("maxFilesPerTrigger", 4).json(f"{out}/in")
    run_available(once_each(stream), appending_sink(f"{out}/out"), f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/out").agg(F.countDistinct("url").alias("urls"), F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from textmill.plans import engine_queries, source_queries  # noqa: F401  register their own

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from textmill.plans import engine_queries, source_queries  # noqa: F401

    return dict(_sql)

