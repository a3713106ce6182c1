"""python -m textmill COMMAND ...: the corpus's jobs over Parquet tables below a root folder.

    filter-index --root R --crawl C --index PATH     write the matching index records of a crawl
    filter-index --root R --catalog FILE --index PATH (--all | --latest N)
                                                     the same for all (or the newest) crawls of a catalog that have none yet;
                                                     {crawl} in the path stands for each one's id
    crawls       --root R                            the crawls that have filtered records
    scrape       --root R --crawl C --archive PATH [--force] [--retry-failed]
    extract      --root R [--batch N] [--deadline SECONDS]
    embed        --root R [--batch N]
    sample       --root R --output PATH [--total N]    a stratified sample to label, as JSON lines
    label        --root R --input SAMPLE --output PATH  label a sample's texts (a stand-in labeller)
    classify     --root R --input LABELS [--lang L]    train on labels (JSON lines), classify the rest
    evaluate     --root R [--lang L] [--input LABELS]  a report of the classified corpus, or of label lines
    relabel      --root R --from MODEL --to MODEL [--dry-run]  rename the model that labels are said to be from
    republish    --root R [--retry-failed]           inspect uploads that haven't been, store corrected files
    repair       --input FOLDER [--in-place]          cut the known tail off the files below a folder
    status       --root R
    export       --root R --output PATH [--base URL]
    manifest     --root R --output PATH [--type T] [--topic T] [--lang L] [--min-confidence X]

The root holds documents/ (the table), objects/ (id.docx), texts/ (id, text) and filtered/crawl_id=C/.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.plain import parse_crawl_spec
from textmill.operators import ingest, learning, mutations, sampling, search, stats
from textmill.operators import predicates as P
from textmill.plans import jobs
from textmill.schemas import CORRECTIONS, DOCUMENTS, TOPICS, TYPES
from textmill.sources import archive, store


def _documents(spark: SparkSession, root: str) -> DataFrame:
    there = store.recover_table(spark, f"{root}/documents")
    return spark.read.schema(DOCUMENTS).parquet(f"{root}/documents") if there else spark.createDataFrame([], DOCUMENTS)


def _objects(spark: SparkSession, root: str) -> DataFrame:
    files = store.ObjectStore(spark, f"{root}/objects").objects(pattern="*.docx")
    return files.select(F.regexp_extract("key", r"([^/]+)\.docx$", 1).alias("id"), "content")


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="textmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=["filter-index", "crawls", "scrape", "extract", "embed", "sample", "label", "classify", "evaluate", "relabel", "republish", "repair", "status", "export", "manifest"])
    parser.add_argument("--root", default="")
    for flag in ("--crawl", "--index", "--archive", "--input", "--output", "--type", "--topic", "--lang", "--min-confidence"):
        parser.add_argument(flag, default="")
    for flag in ("--catalog", "--from", "--to"):
        parser.add_argument(flag, default="", dest=flag.strip("-") + "_")
    for flag in ("--all", "--dry-run", "--in-place"):
        parser.add_argument(flag, action="store_true")
    parser.add_argument("--latest", type=int, default=0)
    parser.add_argument("--deadline", type=float, default=30)
    parser.add_argument("--base", default="https://corpus.example.org/documents/")
    parser.add_argument("--batch", type=int, default=1_000_000)
    parser.add_argument("--total", type=int, default=3500)
    parser.add_argument("--rps", type=float, default=2.0)
    parser.add_argument("--force", action="store_true")
    parser.add_argument("--retry-failed", action="store_true")
    parser.add_argument("--slow", action="store_true")
    a = parser.parse_args(args)
    if not a.root and a.command != "repair":
        parser.error("--root is missing")
    spark = spark or SparkSession.builder.appName(f"textmill {a.command}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    root, now = a.root.rstrip("/"), F.current_timestamp()
    if a.command == "filter-index" and (a.all or a.latest):
        catalog = archive.crawl_catalog(spark, a.catalog_)
        catalog = ingest.newest_crawls(catalog, a.latest) if a.latest else catalog
        there = store.ObjectStore(spark, root).exists("filtered")
        done = archive.filtered_crawls(spark, f"{root}/filtered").select(F.regexp_replace("id", "^crawl_id=", "").alias("id")) if there else catalog.limit(0)
        for crawl in [r.id for r in ingest.missing_crawls(catalog, done).collect()]:  # the catalog's crawls
            archive.filter_index(spark, a.index.replace("{crawl}", crawl), f"{root}/filtered", crawl).show(truncate=False)
    elif a.command == "filter-index":
        archive.filter_index(spark, a.index, f"{root}/filtered", a.crawl).show(truncate=False)
    elif a.command == "crawls":
        archive.filtered_crawls(spark, f"{root}/filtered").show(truncate=False)
    elif a.command == "scrape":
        wanted = parse_crawl_spec(["--crawl", a.crawl])
        crawls = wanted.ids or tuple(r.id.split("=")[-1] for r in archive.filtered_crawls(spark, f"{root}/filtered").limit(wanted.latest or 1).collect())
        for crawl in crawls:
            documents = _documents(spark, root)
            records = archive.read_records(spark, f"{root}/filtered/crawl_id={crawl}")
            new, objects = jobs.scrape(records, documents, crawl, archive.fetcher(a.archive), now, a.force, a.retry_failed, a.rps)
            store.write_absent_objects(objects, f"{root}/objects")
            store.replace_table(jobs.scraped(documents, new, crawl), f"{root}/documents")
    elif a.command == "extract":
        done, texts = jobs.extract(_documents(spark, root), _objects(spark, root), now, a.batch, deadline_s=a.deadline)
        if store.ObjectStore(spark, root).exists("texts"):  # a run that is repeated appends nothing twice
            texts = texts.join(spark.read.parquet(f"{root}/texts").select("id"), "id", "left_anti")
        texts.write.mode("append").parquet(f"{root}/texts")
        store.replace_table(done, f"{root}/documents")
    elif a.command == "embed":
        store.replace_table(jobs.embed(_documents(spark, root), spark.read.parquet(f"{root}/texts"), now, batch=a.batch), f"{root}/documents")
    elif a.command == "sample":
        documents = _documents(spark, root)
        languages = [r.language for r in stats.counts_by(documents.where(P.extracted()), "language", "language").collect()]
        allocated = sampling.allocation(stats.sampling_counts(documents, languages), a.total)
        sample = sampling.stratified(documents, allocated)
        sample.select("id", "language", "word_count", "original_filename", "source_url").write.json(a.output)
    elif a.command == "label":
        sample = store.read_json_lines(spark, a.input)
        done = store.ObjectStore(spark, a.output).exists("")
        todo = sample.join(store.read_json_lines(spark, a.output).select("id"), "id", "left_anti") if done else sample
        rows = todo.select("id", "language", "word_count", "original_filename", "source_url").join(spark.read.parquet(f"{root}/texts"), "id")
        asked = rows.withColumn("prompt", T.prompt("Classify this document by type and topic; answer in JSON.", T.prefix("text"), "original_filename"))
        said = learning.label(asked, learning.patient(learning.stub_labeller, delay_ms=1500 if a.slow else 0))
        store.append_json_lines(rows.drop("text").join(said, "id"), a.output)
    elif a.command == "classify":
        texts = spark.read.parquet(f"{root}/texts")
        labels = learning.with_text(store.read_json_lines(spark, a.input).where(F.col("document_type").isNotNull()), texts)

        def model(ids: tuple[str, ...], column: str):
            known = learning.label_map(spark, ids)
            rows = learning.training_rows(labels, known, column)
            return learning.train_classifier(rows, learning.class_weights(rows, known, column), column)

        languages = [x for x in a.lang.split(",") if x] or None
        documents = _documents(spark, root)
        new = jobs.classify(documents, texts, model(TYPES, "document_type"), model(TOPICS, "document_topic"), TYPES, TOPICS, languages)
        store.replace_table(new, f"{root}/documents")
    elif a.command == "evaluate":
        report = stats.label_quality(store.read_json_lines(spark, a.input)) if a.input else stats.corpus_evaluation(_documents(spark, root), a.lang or None)
        report.show(1000, truncate=False)
    elif a.command == "relabel":
        names = {a.from_: a.to_}
        stats_of = mutations.rename_counts(_documents(spark, root), "classification_model", names)
        stats_of.show(truncate=False)
        if not a.dry_run:
            store.replace_table(mutations.rename(_documents(spark, root), "classification_model", names), f"{root}/documents")
    elif a.command == "republish":
        there = store.recover_table(spark, f"{root}/corrections")
        before = spark.read.schema(CORRECTIONS).parquet(f"{root}/corrections") if there else spark.createDataFrame([], CORRECTIONS)
        new, objects = jobs.republish(_documents(spark, root), before, _objects(spark, root), now, a.retry_failed)
        store.write_absent_objects(objects, f"{root}/objects")
        store.replace_table(new, f"{root}/corrections")
    elif a.command == "repair":
        jobs.repair_folder(spark, a.input, in_place=a.in_place).groupBy("status").count().show(truncate=False)
    elif a.command == "status":
        stats.status_report(_documents(spark, root)).show(100, truncate=False)
    elif a.command == "export":
        store.write_export(search.export_rows(_documents(spark, root), a.base), a.output)
    else:
        chosen = {"type": a.type, "topic": a.topic, "lang": a.lang, "min_confidence": a.min_confidence or None}
        store.write_manifest(search.manifest_urls(_documents(spark, root), a.base, **chosen), a.output)


if __name__ == "__main__":
    main()
