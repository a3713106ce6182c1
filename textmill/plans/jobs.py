"""The corpus's jobs as batch plans: scrape, extract, embed, classify, repair, serve.

Each takes the current tables and returns the next ones; nothing is written here
but what is fetched or extracted, once (keep), as both results of a job use it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import records as R
from textmill.functions import text as T
from textmill.functions.plain import page_bounds, page_count
from textmill.functions.supervised import with_deadline
from textmill.operators import ingest, learning, mutations, search, stats
from textmill.operators import predicates as P
from textmill.schemas import LANGUAGE_NAMES, TOPIC_LABELS, TYPE_LABELS
from textmill.sources.archive import fetch_records
from textmill.sources.store import without_links, write_absent_objects, written


def scrape(
    records: DataFrame, documents: DataFrame, crawl_id: str, fetch: Callable[[str, int, int], bytes], now: Column,
    force: bool = False, retry_failed: bool = False, rps: float = 5.0, keep: Callable[[DataFrame], DataFrame] = written,
) -> tuple[DataFrame, DataFrame]:
    """(new document rows, objects to store) of a crawl's index records.

    Known URLs are dropped before anything is fetched; those that this crawl hasn't
    tracked yet give one duplicate row each.
    """
    todo = ingest.unseen(records, documents, force, retry_failed)
    fetched = keep(fetch_records(todo, fetch, rps))
    rows = ingest.identified(fetched, documents, crawl_id, now)
    seen = ingest.cross_crawl_duplicates(records, documents, crawl_id, now)
    new = rows if force else rows.unionByName(seen, allowMissingColumns=True)
    stored = rows.where(P.is_status("uploaded")).select("id", F.col("source_url").alias("url"))
    objects = stored.join(fetched.select("url", "content"), "url").select("id", "content")
    return new, objects


def scraped(documents: DataFrame, new: DataFrame, crawl_id: str) -> DataFrame:
    """documents after a crawl: its failed rows of refetched URLs go, new rows are inserted or overwrite."""
    base = ingest.refetched(documents, new, crawl_id)
    return mutations.upsert(base.select(*documents.columns), new.dropDuplicates(["id"]))


def extract(
    documents: DataFrame, objects: DataFrame, now: Column, batch: int = 1_000_000, keep: Callable[[DataFrame], DataFrame] = written,
    parse: Callable = R.docx_parts, deadline_s: float = 30,
) -> tuple[DataFrame, DataFrame]:
    """(documents with measures, texts) of the oldest documents that wait for extraction. objects: (id, content).

    Documents are parsed in supervised processes: one that takes longer than
    deadline_s gets an error and costs the others nothing.
    """
    work = search.work_queue(documents, P.extract_selectable(), "uploaded_at", batch).select("id")
    rows = with_deadline(work.join(objects.select("id", "content"), "id", "left"), parse, "content", R.DOCX_PARTS, deadline_s)
    whole = F.concat_ws("\n\n", F.nullif("text", F.lit("")), F.nullif(T.table_text("tables"), F.lit("")))
    texts = rows.select("id", F.when(F.col("error").isNull(), whole).alias("text"), F.size("tables").alias("tables"), "image_count", "error")
    texts = keep(texts)
    named = texts.withColumn("l", R.language("text"))
    done = named.select(
        "id", T.word_count("text").alias("word_count"), T.char_count("text").alias("char_count"), F.col("tables").alias("table_count"),
        "image_count", F.col("l.language").alias("language"), F.col("l.confidence").alias("language_confidence"), "error",
    )
    return mutations.set_extraction(documents, done, now), texts.where("error IS NULL").select("id", "text")


def embed(documents: DataFrame, texts: DataFrame, now: Column, model: str = "hashing", embedder=learning.hash_embedder, batch: int = 1_000_000) -> DataFrame:
    """documents with vectors of the oldest that wait for one; a text without content is skipped as empty."""
    work = search.work_queue(documents, P.embed_selectable(), "extracted_at", batch).select("id")
    rows = work.join(texts, "id", "left").select("id", F.coalesce("text", F.lit("")).alias("text"))
    empty = T.trim_spaces("text") == ""
    vectors = learning.embed(rows.where(~empty), embedder)
    new = mutations.set_embeddings(documents, vectors, model, now)
    return mutations.set_skipped(new, rows.where(empty).select("id", F.lit("empty").alias("reason")), now)


def classify(documents: DataFrame, texts: DataFrame, by_type, by_topic, types: tuple[str, ...], topics: tuple[str, ...], languages: list[str] | None = None, version: str = "v1") -> DataFrame:
    """documents with labels for all that wait for one and have a text."""
    work = documents.where(P.label_selectable())
    work = work.where(F.col("language").isin(languages)) if languages else work
    rows = learning.with_text(work.select("id"), texts)
    labels = learning.classify(rows, by_type, by_topic, types, topics, version)
    model = f"hashing-logistic-{version}"
    return mutations.set_labels(documents, labels, model)


def republish(documents: DataFrame, corrections: DataFrame, objects: DataFrame, now: Column, retry_errors: bool = False) -> tuple[DataFrame, DataFrame]:
    """(corrections with this run's rows, corrected objects) of all uninspected uploads: one batch, so it ends."""
    pick = ingest.to_inspect_again if retry_errors else ingest.uncorrected
    raw = pick(documents, corrections).select(F.col("id").alias("raw_id"))
    found = raw.join(objects.select(F.col("id").alias("raw_id"), "content"), "raw_id", "left").withColumn("error", F.lit(None).cast("string"))
    inspected = ingest.corrections_of(found)
    new = mutations.upsert_corrections(corrections, inspected.drop("content"), now)
    return new, inspected.where("corrected_id IS NOT NULL").select(F.col("corrected_id").alias("id"), "content")


def repair_folder(spark: SparkSession, root: str, pattern: str = "*.docx", in_place: bool = False, keep: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """(key, status, sha256) of the files below a folder: what is wrong with each one's end, and the hash of the repaired file.

    In place, repaired files replace their old versions, through temporary names; links
    are skipped. A second run finds them clean.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    base = root.rstrip("/").split("://", 1)[-1].split(":", 1)[-1].lstrip("/") + "/"
    named = without_links(files.select("path")).join(files.select("path", "content"), "path")
    repair = R.repaired(F.when(~F.col("is_link"), F.col("content")))
    done = named.select(F.substring_index("path", base, -1).alias("key"), "is_link", repair.alias("r"))
    done = keep(done.select("key", F.when(F.col("is_link"), "skipped-symlink").otherwise(F.col("r.status")).alias("status"), F.col("r.candidate").alias("content")))
    if in_place:
        write_absent_objects(done.where("content IS NOT NULL").select(F.col("key").alias("id"), "content"), root, "", replace=True)
    return done.select("key", "status", F.sha2("content", 256).alias("sha256"))


def stats_payload(documents: DataFrame) -> dict:
    """What a statistics endpoint answers: totals, types, topics and the top languages with their shares."""
    hero = stats.hero(documents).first()
    types = {r.type: r.n for r in stats.counts_by(documents, "document_type", "type").collect()}
    topics = {r.topic: r.n for r in stats.counts_by(documents, "document_topic", "topic").collect()}
    languages = stats.languages(documents.where(P.is_status("uploaded"))).collect()
    whole = sum(types.values())

    def share(n: int, total: int) -> float | None:
        return int(1000 * n / total + 0.5) / 10 if total else None

    return {
        "total": hero.total, "languages": hero.languages, "avg_confidence": hero.avg_confidence, "classified": hero.classified,
        "types": [{"id": k, "label": TYPE_LABELS.get(k, k), "count": n, "percentage": share(n, whole)} for k, n in types.items()],
        "topics": [{"id": k, "label": TOPIC_LABELS.get(k, k), "count": n, "percentage": share(n, whole)} for k, n in topics.items()],
        "top_languages": [{"code": r.language, "name": LANGUAGE_NAMES.get(r.language, r.language), "count": r.n, "percentage": share(r.n, hero.total)} for r in languages],
    }


def documents_payload(documents: DataFrame, page: str | int = 1, limit: str | int = 25, **chosen) -> dict:
    """What a search endpoint answers: one page of rows, the total, and the facets."""
    p, n, _ = page_bounds(page, limit)
    narrow = documents.select("id", "original_filename", "document_type", "document_topic", "language", "word_count", "classification_confidence")
    total = search.total(narrow, n, **chosen).first().total
    rows = search.with_labels(search.page_rows(search.page(narrow, p, n, **chosen))).collect()
    facets: dict[str, list[dict]] = {"type": [], "topic": [], "lang": []}
    for r in stats.facets(narrow, **chosen).orderBy("facet", F.desc("n"), "value").collect():
        facets[r.facet].append({"id": r.value, "count": r.n})
    return {"page": p, "limit": n, "total": total, "pages": page_count(total, n), "documents": [r.asDict() for r in rows], "facets": facets}


def manifest_text(documents: DataFrame, base: str, **chosen) -> str:
    """A manifest's lines in one string; for large ones write search.manifest_urls instead."""
    return "".join(f"{r.url}\n" for r in search.manifest_urls(documents, base, **chosen).toLocalIterator())
